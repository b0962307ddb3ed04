"""Landing, refresh by change, atomic replacement of months, and parsed repeat groups."""

import dataclasses
import glob
import uuid
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.driver import refresh_queries
from fieldtally.driver.raw_forms import LANDED, inputs
from fieldtally.forms import FORMS
from fieldtally.operators import publish as publishing
from fieldtally.operators.changes import changed, digests
from fieldtally.operators.publish import batches, current_version, ensure_namespaces, publish, published_rows
from fieldtally.plans.warehouse import TABLES, Warehouse, parsed_column
from fieldtally.sources import land_form, read_form

DIR = "/root/testdata/sf0.001"
DAY = "campaign_activity_details_date_vaccination_activity"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def place():
    return {"suffix": f"_{uuid.uuid4().hex}"}


# ---------------------------------------------------------------- landing

def test_landed_file_has_bounded_row_groups_and_is_read_by_several_tasks(spark, tmp_path):
    form = LANDED["activity"](spark, "/root/testdata/sf0.01").coalesce(1)
    land_form(form, str(tmp_path / "activity"), row_group_bytes=256 << 10)
    files = glob.glob(str(tmp_path / "activity" / "*.parquet"))
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 4
    read = read_form(spark, FORMS["activity"], str(tmp_path / "activity"))
    sizes = [r["count"] for r in read.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 10_000 and sum(sizes) == 15_000


def test_spread_starts_no_job_and_prunes_below_its_shuffle(spark, tmp_path):
    LANDED["activity"](spark, DIR).coalesce(1).write.parquet(str(tmp_path / "one"))
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "building")
    read = read_form(spark, FORMS["activity"], str(tmp_path / "one"), spread=6)
    used = read.where("_id < '5'").select("_id")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    plan = plan_of(used)
    assert "RoundRobinPartitioning(6)" in plan and "ReadSchema: struct<_id:string>" in plan and "PushedFilters: [IsNotNull(_id)" in plan
    assert read.count() == LANDED["activity"](spark, DIR).count()


# ---------------------------------------------------------------- digests

def frame(spark, *cells):
    return spark.createDataFrame(list(cells), "id long, day string, answer string, remark string")


OLD = [(1, "2024-01-05", "a", None), (2, "2024-02-05", "b", "x"), (3, "2024-03-05", "c", None), (4, "2024-04-05", None, "d"),
       (5, None, "e", None), (6, "2024-06-01", "f", "f"), (6, "2024-06-01", "f", "f")]


def moved(spark, new, old=OLD, **options):
    now, before = (digests(frame(spark, *some), "form", "day", **options).collect() for some in (new, old))
    return changed(now, before)


def test_changed_months(spark):
    assert moved(spark, OLD[::-1]) == {}
    edited = [(1, "2024-01-06", "a", None), *OLD[1:]]  # another day of the month
    assert moved(spark, edited) == {"form": {date(2024, 1, 1)}}
    assert moved(spark, [OLD[0], (2, "2024-07-01", "b", "x"), *OLD[2:]]) == {"form": {date(2024, 2, 1), date(2024, 7, 1)}}
    assert moved(spark, [OLD[0], (2, None, "b", "x"), *OLD[2:]]) == {"form": {date(2024, 2, 1), None}}
    assert moved(spark, [OLD[0], (2, "no date", "b", "x"), *OLD[2:]]) == {"form": {date(2024, 2, 1), None}}
    assert moved(spark, OLD[:2] + OLD[3:]) == {"form": {date(2024, 3, 1)}}
    assert moved(spark, OLD[:-1]) == {"form": {date(2024, 6, 1)}}  # one of two equal rows vanished
    swapped = [*OLD[:3], (4, "2024-04-05", "d", None), *OLD[4:]]  # a value that moved into another column
    assert moved(spark, swapped) == {"form": {date(2024, 4, 1)}}
    assert moved(spark, edited, columns=["id"]) == {"form": {date(2024, 1, 1)}}  # the day always counts
    assert moved(spark, swapped, columns=["id"]) == {}
    assert moved(spark, [], old=[]) == {}
    assert moved(spark, OLD[:1], old=[]) == {"form": None}


def test_changed_sources_without_days(spark):
    old, new = (digests(frame(spark, *some), "areas").collect() for some in (OLD, OLD[:-2]))
    assert changed(old, old) == {} and changed(new, old) == {"areas": None}
    assert changed(digests(frame(spark), "areas").collect(), old) == {"areas": None}


def test_a_digest_is_narrow_and_combines_before_its_shuffle(spark, tmp_path):
    frame(spark, *OLD).write.parquet(str(tmp_path / "form"))
    plan = plan_of(digests(spark.read.parquet(str(tmp_path / "form")), "form", "day", ["id"]))
    assert "ReadSchema: struct<id:bigint,day:string>" in plan and "partial_sum" in plan


# ---------------------------------------------------------------- refresh by change

ACTIVITY_TABLES = ("clean.activity", "clean.activity_vaccine", "clean.target", "staging.sia_actuals", "staging.sia_targets",
                   "staging.sia_vaccine_dose", "staging.aggregated_sia_actuals_target", "staging.sia_records", "public.sia_records")


@pytest.fixture(scope="module")
def steps(spark):
    """A warehouse after a first refresh, one without change, and one after submissions changed."""
    src = inputs(spark, DIR, ("activity", "target"))
    where = place()
    key, day = F.col("_id").cast("bigint"), F.col(DAY)
    old = src.forms["activity"]
    month = F.date_format(day, "yyyy-MM")
    first = old.where((key % 5 != 3) | (month != "1997-03")).withColumn(
        DAY, F.when(key == 7, F.to_date(F.lit("1996-02-02"))).when(key == 11, F.lit(None).cast("date")).otherwise(day)).unionByName(
        old.where(key == 20).withColumns({"_id": F.lit("999999"), DAY: F.to_date(F.lit("1999-09-09"))}))
    days = {r[0]: r[1] for r in old.where(key.isin(7, 11)).select(key, day).collect()}
    before = dataclasses.replace(src, forms={**src.forms, "activity": first})
    done = [Warehouse(before, **where).refresh_changed(spark, ACTIVITY_TABLES),
            Warehouse(before, **where).refresh_changed(spark, ACTIVITY_TABLES)]
    now = Warehouse(src, **where)
    done.append(now.refresh_changed(spark, ACTIVITY_TABLES))
    expected = {None, date(1996, 2, 1), date(1997, 3, 1), date(1999, 9, 1)} | {d.replace(day=1) for d in days.values()}
    return src, where, now, done, expected


def test_only_affected_months_are_rewritten(spark, steps):
    src, _, now, done, expected = steps
    assert set(done[0]) == set(ACTIVITY_TABLES) and set(done[0].values()) == {None}
    assert done[1] == {}
    follow = set(ACTIVITY_TABLES) - {"clean.target", "staging.sia_targets"}
    assert set(done[2]) == follow and all(m == expected for m in done[2].values())
    shown = batches(spark, now.catalog_name("staging.sia_actuals"))
    assert {m for m, b in shown.items() if b == 2} <= expected and list(shown.values()).count(1) > 40
    lazy = Warehouse(src)
    for name in ACTIVITY_TABLES:
        assert rows(spark.table(now.catalog_name(name))) == rows(lazy[name].select(spark.table(now.catalog_name(name)).columns)), name


def test_a_changed_dimension_or_target_rewrites_what_reads_it(spark, steps):
    src, where, _, _, _ = steps
    areas = {**src.dims.areas, 1: src.dims.areas[1].withColumn("label", F.concat("label", F.lit("!")))}
    renamed = dataclasses.replace(src, dims=dataclasses.replace(src.dims, areas=areas))
    done = Warehouse(renamed, **where).refresh_changed(spark, ACTIVITY_TABLES)
    assert set(done) == {n for n in ACTIVITY_TABLES if not n.startswith("clean.")} and set(done.values()) == {None}
    target = src.forms["target"].withColumn("_id", F.concat("_id", F.lit("x")))
    changed_target = dataclasses.replace(renamed, forms={**src.forms, "target": target})
    done = Warehouse(changed_target, **where).refresh_changed(spark, ACTIVITY_TABLES)
    assert set(done) == {"clean.target", "staging.sia_targets", "staging.aggregated_sia_actuals_target"}
    assert done["staging.aggregated_sia_actuals_target"] is None and done["clean.target"]
    later = dataclasses.replace(changed_target, as_of="2001-04-20")
    done = Warehouse(later, **where).refresh_changed(spark, ACTIVITY_TABLES)
    assert done == {"staging.aggregated_sia_actuals_target": {date(2001, 4, 1)}}
    got = spark.table(Warehouse(later, **where).catalog_name("staging.aggregated_sia_actuals_target"))
    assert rows(got) == rows(Warehouse(later)["staging.aggregated_sia_actuals_target"].select(got.columns))


def test_refresh_queries_rewrite_some_months(spark):
    _, done = refresh_queries.refreshed(spark, DIR, refresh_queries.COUNTS)
    assert 1 < len(done["staging.sia_actuals"]) < 30 and None in done["clean.activity"]


# ---------------------------------------------------------------- months by batch

def dated(spark, *cells):
    return spark.createDataFrame(list(cells), "id long, day string").withColumn("day", F.to_date("day"))


def test_readers_see_old_or_new_months_whatever_fails(spark, monkeypatch):
    ensure_namespaces(spark)
    old = [(1, "2024-01-05"), (2, "2024-02-05"), (3, None)]
    publish(dated(spark, *old), "staging.steps", "table", "day")
    new = dated(spark, (2, "2024-03-09"), (4, None))
    months = {date(2024, 2, 1), date(2024, 3, 1), None}
    seen = []
    show = publishing._show

    def watched(*args):
        seen.append(rows(spark.table("staging.steps"), "id"))  # the new rows are written, the view is not changed
        if len(seen) == 1:
            raise RuntimeError("lost")
        return show(*args)

    monkeypatch.setattr(publishing, "_show", watched)
    with pytest.raises(RuntimeError):
        publish(new, "staging.steps", "table", "day", months=months)
    assert rows(spark.table("staging.steps"), "id") == [(1,), (2,), (3,)]
    got = publish(new, "staging.steps", "table", "day", months=months)
    assert seen == [[(1,), (2,), (3,)]] * 2
    assert rows(got) == [(1, "2024-01-05"), (2, "2024-03-09"), (4, None)]
    # what the failed write left is gone
    assert len(spark.sql(f"show partitions {current_version(spark, 'staging.steps')}").collect()) == 3


def test_rows_of_other_months_and_emptied_months(spark):
    publish(dated(spark, (1, "2024-01-05"), (2, "2024-02-05"), (3, None)), "staging.emptied", "table", "day")
    got = publish(dated(spark, (1, "2024-01-06"), (9, "2024-05-05")), "staging.emptied", "table", "day",
                  months={date(2024, 2, 1), None})
    assert rows(got) == [(1, "2024-01-05")]
    got = publish(dated(spark), "staging.emptied", "table", "day", months={date(2024, 1, 1)})
    assert rows(got) == [] and batches(spark, "staging.emptied") == {}
    got = publish(dated(spark, (1, "2024-01-06")), "staging.emptied", "table", "day", months={date(2024, 1, 1)})
    assert rows(got) == [(1, "2024-01-06")]


def test_earlier_batches_are_kept_for_running_readers(spark):
    publish(dated(spark, (1, "2024-01-05")), "staging.retained", "table", "day")
    reader = spark.table("staging.retained")
    publish(dated(spark, (2, "2024-01-05")), "staging.retained", "table", "day", months={date(2024, 1, 1)}, retain=1)
    assert rows(reader, "id") == [(1,)] and rows(spark.table("staging.retained"), "id") == [(2,)]
    publish(dated(spark, (3, "2024-01-05")), "staging.retained", "table", "day", months={date(2024, 1, 1)}, retain=1)
    partitions = spark.sql(f"show partitions {current_version(spark, 'staging.retained')}").collect()
    assert sorted(p.partition[-1] for p in partitions) == ["2", "3"]


def test_hidden_columns_are_written_and_not_shown(spark):
    frame = dated(spark, (1, "2024-01-05"), (2, None)).withColumn("extra", F.col("id") + 1)
    got = publish(frame, "staging.hiding", "table", "day", hidden=["extra"])
    assert got.columns == ["id", "day"]
    assert rows(published_rows(spark, "staging.hiding", "day"), "extra") == [(2,), (3,)]
    assert rows(published_rows(spark, "staging.hiding", "day", months={None}), "extra") == [(3,)]


# ---------------------------------------------------------------- parsed repeat groups

@pytest.fixture(scope="module")
def written(spark):
    """All tables, written."""
    src = inputs(spark, DIR)
    warehouse = Warehouse(src, **place())
    warehouse.refresh(spark, mode="table")
    return src, warehouse


def test_written_tables_equal_lazy_ones(spark, written):
    src, warehouse = written
    lazy = Warehouse(src)
    for table in TABLES:
        got = spark.table(warehouse.catalog_name(table.name))
        assert got.columns == lazy[table.name].columns
        assert rows(got) == rows(lazy[table.name]), table.name


def test_repeat_groups_are_parsed_once_and_read_in_part(spark, written):
    src, warehouse = written
    by_name = {t.name: t for t in TABLES}
    for name, form, column, wanted, unwanted in (
            ("staging.rca", "rapid_coverage", "vaccination", "not_vaccinated_males", "reason_1:"),
            ("staging.rca_not_vaccinated_reasons", "rapid_coverage", "vaccination", "reason_1:", "present_males"),
            ("staging.sia_actuals", "activity", "vaccine", "vaccinated_males", "reason"),
            ("staging.sia_targets", "target", "target_children", "no_children", "age_group_name"),
            ("staging.social_mobilization_indicators", "social", "refusals", "refusals_addressed", "vaccine_name"),
            ("staging.monitored_facilities_overall_proportion", "monitoring", "vaccination_team_info", "part3_indicator1:", "remarks"),
            ("clean.activity_vaccine", "activity", "vaccine", "vaccinated_males", "no such field")):
        table = by_name[name]
        frame = table.build(warehouse._reader(spark, table, "table", None, None), src)
        plan = plan_of(frame)
        assert "from_json" not in plan, name
        read = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        schema = next(line for line in read.splitlines() if line.startswith("ReadSchema") and parsed_column(column) in line)
        nested = schema.split(f"{parsed_column(column)}:array<struct<")[1].split(">>")[0] + ":"
        assert wanted in nested and unwanted not in nested, (name, nested)
        assert f",{column}:string" not in schema


def test_malformed_groups_raise_or_read_as_null_when_the_form_is_written(spark):
    src = inputs(spark, DIR, ("social",))
    spec = src.specs["social"]
    bad = src.forms["social"].limit(2).withColumn(spec.repeat.column, F.lit("[{"))
    strict = Warehouse(dataclasses.replace(src, forms={"social": bad}), **place())
    with pytest.raises(Exception):
        strict.refresh(spark, ["clean.social"], mode="table")
    lenient = Warehouse(dataclasses.replace(strict.inputs, specs={**src.specs, "social": spec.lenient()}), **place())
    frames = lenient.refresh(spark, ["clean.social", "staging.social_mobilization_indicators"], mode="table")
    assert frames["staging.social_mobilization_indicators"].count() == 18


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "shuffle_" in f}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    layer = f"clean_{tmp_path.name}".replace("-", "_")
    ensure_namespaces(spark, [layer], str(tmp_path))
    rows = spark.range(200).selectExpr("id", "date_add(date'2024-01-05', cast(id % 90 as int)) as day", "id % 3 as n")
    before = shuffle_files(spark)
    publish(rows, f"{layer}.t", "table", "day")
    publish(rows, f"{layer}.t", "table", "day", months={date(2024, 2, 1)})
    assert shuffle_files(spark) <= before


def test_rows_expanded_behind_the_shuffle(spark, tmp_path):
    layer = f"clean_{tmp_path.name}".replace("-", "_")
    ensure_namespaces(spark, [layer], str(tmp_path))
    rows = spark.range(90).selectExpr("id", "date_add(date'2024-01-05', cast(id as int)) as day", "cast(id % 3 as int) as n")

    def expand(df, keep):
        return df.select("id", "day", F.explode(F.sequence(F.lit(0), "n")).alias("k"), *keep)

    want = sorted(map(tuple, expand(rows, ()).collect()))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for months in (None, {date(2024, 2, 1)}):
        got = publish(rows, f"{layer}.t", "table", "day", months=months, expand=expand)
        assert got.columns == ["id", "day", "k"] and sorted(map(tuple, got.collect())) == want
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size
