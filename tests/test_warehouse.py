"""The warehouse as a whole, as session views and as written tables."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.driver.raw_forms import inputs
from fieldtally.operators.publish import current_version, ensure_namespaces, publish, recent_rows
from fieldtally.plans.warehouse import TABLES, Warehouse

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lazy(spark):
    return Warehouse(inputs(spark, DIR))


def test_forty_nine_tables():
    layers = [t.name.split(".")[0] for t in TABLES]
    assert len(layers) == 49 and len({t.name for t in TABLES}) == 49
    assert {layer: layers.count(layer) for layer in set(layers)} == {"clean": 14, "staging": 20, "public": 15}


def test_refresh_as_tables_equals_lazy_frames(spark, lazy):
    names = ("clean.activity", "clean.target", "staging.sia_actuals", "staging.sia_targets", "staging.sia_vaccine_dose",
             "staging.aggregated_sia_actuals_target", "public.aggregated_sia_actuals_target", "staging.sia_records",
             "public.sia_records")
    written = Warehouse(inputs(spark, DIR))
    for _ in range(2):  # a second refresh replaces the first
        written = Warehouse(inputs(spark, DIR))
        frames = written.refresh(spark, names, mode="table")
    assert list(frames) == [t.name for t in TABLES if t.name in names]
    for name in names[2:]:
        assert spark.table(name).count() == lazy[name].count()
        assert rows(frames[name]) == rows(lazy[name])
    months = [r.partition for r in spark.sql(f"show partitions {current_version(spark, 'staging.sia_actuals')}").collect()]
    assert any(m.startswith("date_vaccination_activity_month=19") for m in months)
    assert spark.catalog.getTable("public.aggregated_sia_actuals_target").tableType == "VIEW"


def test_refresh_of_recent_months(spark, lazy):
    """Only partitions from the given month on are rewritten; the outcome is that of a full refresh."""
    names = ("clean.activity", "staging.sia_actuals", "staging.sia_records")
    Warehouse(inputs(spark, DIR)).refresh(spark, names, mode="table")
    full = rows(spark.table("staging.sia_actuals"))

    def files():
        return {r.f for r in spark.table(current_version(spark, "staging.sia_actuals")).selectExpr("_metadata.file_path as f").distinct().collect()}

    before = files()
    frames = Warehouse(inputs(spark, DIR)).refresh(spark, names, mode="table", since="2000-05-17")
    after = files()
    def month(file):
        return file.split("month=")[1][:7]

    kept = {f for f in before if month(f) < "2000-05"}
    assert kept and kept <= after and len(after - before) > 0
    assert all(month(f) >= "2000-05" for f in after - before)
    assert rows(spark.table("staging.sia_actuals")) == full
    assert rows(frames["staging.sia_records"]) == rows(lazy["staging.sia_records"])


def test_month_filter_prunes_partitions(spark):
    plan = spark.table(current_version(spark, "staging.sia_actuals")).where(
        "date_vaccination_activity_month = date'1998-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_vaccination_activity_month" in plan


def test_publish_view(spark, lazy):
    frames = lazy.refresh(spark, ("staging.ready_facilities", "public.ready_facilities"))
    assert rows(spark.table("public__ready_facilities")) == rows(frames["staging.ready_facilities"])


def test_namespaces_are_idempotent(spark):
    ensure_namespaces(spark, ["clean", "staging"])
    ensure_namespaces(spark, ["clean", "staging"])
    assert {"clean", "staging"} <= {d.name for d in spark.catalog.listDatabases()}
    with pytest.raises(ValueError):
        publish(spark.range(1), "staging.x", mode="index")


def dated(spark, *rows_, order=("id", "day", "answer", "remark")):
    frame = spark.createDataFrame([(i, d, a, r) for i, d, a, r in rows_], "id long, day string, answer string, remark string")
    return frame.withColumn("day", frame.day.cast("date")).select(*order)


def test_refresh_moves_drops_and_keeps_rows(spark):
    """A row that changed its month, a deleted row, rows without a day, and an emptied month."""
    ensure_namespaces(spark)
    old = dated(spark, (1, "2024-03-05", "a", "x"), (2, "2024-01-07", "b", "x"), (3, "2024-05-01", "c", "x"), (4, None, "d", "x"),
                (5, "2024-06-30", "e", "x"))
    publish(old, "staging.moving", "table", "day")
    new = dated(spark, (1, "2024-04-05", "a", "x"), (2, "2024-01-07", "changed before since", "x"), (6, None, "f", "x"))
    got = publish(new, "staging.moving", "table", "day", since="2024-03-20")
    assert rows(got) == sorted([(1, "2024-04-05", "a", "x"), (2, "2024-01-07", "b", "x"), (6, None, "f", "x")], key=repr)
    months = {r.partition.split("=")[1].split("/")[0] for r in spark.sql(f"show partitions {current_version(spark, 'staging.moving')}").collect()}
    assert {m for m in months if m[:2] == "20"} == {"2024-01-01", "2024-04-01"}
    got = publish(dated(spark, (1, "2024-04-05", "a", "x")), "staging.moving", "table", "day", since="2024-03-20")
    assert rows(got) == [(1, "2024-04-05", "a", "x"), (2, "2024-01-07", "b", "x")]
    got = publish(dated(spark), "staging.moving", "table", "day", since="2024-03-20")
    assert rows(got) == [(2, "2024-01-07", "b", "x")]


def test_refresh_matches_columns_by_name(spark):
    publish(dated(spark, (1, "2024-03-05", "a", "x")), "staging.ordered", "table", "day")
    turned = dated(spark, (2, "2024-04-05", "answer", "remark"), order=("remark", "answer", "day", "id"))
    got = publish(turned, "staging.ordered", "table", "day", since="2024-04-01")
    assert rows(got, "id", "answer", "remark") == [(1, "a", "x"), (2, "answer", "remark")]
    wider = turned.withColumn("extra", turned.id)
    assert rows(publish(wider, "staging.ordered", "table", "day", since="2024-04-01"), "id", "extra") == [(2, 2)]


def test_readers_keep_the_old_table_until_the_new_one_is_written(spark):
    publish(dated(spark, (1, "2024-03-05", "a", "x")), "staging.steady", "table")
    with pytest.raises(Exception):
        publish(dated(spark, (2, None, "no number", "x")).selectExpr("cast(answer as bigint) as id"), "staging.steady", "table")
    assert rows(spark.table("staging.steady"), "id") == [(1,)]
    assert rows(publish(dated(spark, (2, None, "b", "x")), "staging.steady", "table"), "id") == [(2,)]


def test_recent_rows_prune_partitions(spark):
    publish(dated(spark, (1, "2024-03-05", "a", "x"), (2, "2024-05-05", "a", "x"), (3, None, "a", "x")), "staging.pruned", "table", "day")
    recent = recent_rows(spark, "staging.pruned", "day", "2024-05-09")
    assert rows(recent, "id") == [(2,), (3,)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day_month", plan)  # beside the batches that the view shows


def test_incremental_refresh_equals_a_full_one(spark):
    names = [t.name for t in TABLES if t.name.split(".")[1] in (
        "activity", "target", "sia_actuals", "sia_targets", "sia_vaccine_dose", "aggregated_sia_actuals_target",
        "sia_actuals_target", "deferred_refused_reasons", "sia_records")]
    full = Warehouse(inputs(spark, DIR)).refresh(spark, names, mode="table")
    want = {n: rows(full[n]) for n in names if n.startswith("staging")}
    recent = Warehouse(inputs(spark, DIR)).refresh(spark, names, mode="table", since="2000-05-17")
    for n in want:
        assert rows(recent[n]) == want[n], n
    assert spark.catalog.getTable("public.sia_records").tableType == "VIEW"
    assert rows(spark.newSession().table("public.sia_records")) == rows(recent["staging.sia_records"].selectExpr(
        *[f"cast({c} as date) as {c}" if c in ("submitted_at", "modified_at") else c for c in recent["public.sia_records"].columns]))


def test_customised_forms_reach_every_table(spark):
    """One question fewer, another category count, and malformed numbers read as NULL, through the warehouse."""
    src = inputs(spark, DIR)
    spec = src.specs["readiness"]
    fewer = replace(spec, questions=spec.questions[:-1])
    custom = Warehouse(replace(src, specs={**src.specs, "readiness": fewer, "rapid_coverage": src.specs["rapid_coverage"].lenient()},
                               readiness_categories=4))
    plain = Warehouse(src)
    assert custom["staging.hc_assessment"].count() == plain["staging.hc_assessment"].count() // len(spec.questions) * len(fewer.questions)
    assert rows(custom["staging.ready_facilities"], "category_value") != rows(plain["staging.ready_facilities"], "category_value")


def test_one_cast_rule_for_text_counts(spark):
    src = inputs(spark, DIR)
    spec = src.specs["rapid_coverage"]
    path = spec.repeat.path
    bad = src.forms["rapid_coverage"].limit(1).withColumn(spec.repeat.column, F.lit(
        f'[{{"{path}/age_group_label": "a", "{path}/not_vaccinated_males": "5.0", "{path}/not_vaccinated_females": "2",'
        f' "{path}/unvaccinated/reason_1": "2.6"}}]'))
    strict = Warehouse(replace(src, forms={**src.forms, "rapid_coverage": bad}))
    for name in ("staging.rca", "staging.rca_actuals", "staging.rca_not_vaccinated_reasons"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            strict[name].collect()
    lenient = Warehouse(replace(strict.inputs, specs={**src.specs, "rapid_coverage": spec.lenient()}))
    assert rows(lenient["staging.rca"], "total_not_vaccinated") == [(2,)]
    cells = rows(lenient["staging.rca_actuals"].where("rca_category = 'Not vaccinated'"), "indicator_value")
    assert sorted(cells, key=str) == [(2,), (None,)]
    assert rows(lenient["staging.rca_not_vaccinated_reasons"]) == []
