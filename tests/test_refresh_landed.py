"""The refresh queries make each form once: what digests and tables read is landed, with the same rows. Making and parsing
it is cheap."""

import dataclasses
import datetime
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from fieldtally.driver import raw_forms as raw
from fieldtally.driver.refresh_queries import COUNTS, DAILY, refreshed
from fieldtally.operators.publish import ensure_namespaces, publish, published_rows
from fieldtally.plans import warehouse as warehouse_module
from fieldtally.plans.warehouse import Warehouse
from tests.conftest import rows


def tables(spark, path, orders):
    made = {
        "region": [(1, "r1")], "nation": [(i, f"n{i}", 1) for i in range(1, 4)],
        "supplier": [(i, f"s{i}", 1, 0.5) for i in range(1, 9)], "part": [(i, f"p{i}", "b", "t", 1, 0.5) for i in range(1, 9)],
        "customer": [(i, f"c{i}", 1, 0.5, "BUILDING") for i in range(1, 9)], "orders": orders,
    }
    for name, listed in made.items():
        spark.createDataFrame(listed, raw.SCHEMAS[name]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


ORDERS = [(i, i % 9, "O", 1.5, datetime.datetime(1996, 7, 1) + datetime.timedelta(days=i % 300), "1-URGENT") for i in range(400)]
# a key that repeats, one without a day, one without a key
ODD = [ORDERS[7], (1_000, None, None, None, None, None), (None, 3, "O", 1.5, datetime.datetime(1997, 3, 4), "2-HIGH")]


@pytest.mark.parametrize(("names", "table"), [(COUNTS, "staging.sia_actuals"), (DAILY, "staging.aggregated_sia_actuals_target")])
def test_forms_are_made_once(spark, tmp_path, names, table):
    path = tables(spark, tmp_path / "in", ORDERS + ODD)
    warehouse, months = refreshed(spark, path, names)
    plain = raw.inputs(spark, path, tuple(warehouse.inputs.forms))
    for name, form in warehouse.inputs.forms.items():
        files = form.inputFiles()
        assert files and all(f"/landed-{name}-" in f for f in files)
        assert form.schema.simpleString() == plain.forms[name].schema.simpleString()
        assert rows(form) == rows(plain.forms[name])
    assert datetime.date(1996, 8, 1) in months["clean.activity"]
    assert rows(warehouse.frames[table]) == rows(Warehouse(plain)[table])


def test_no_orders(spark, tmp_path):
    path = tables(spark, tmp_path / "in", [])
    warehouse, _ = refreshed(spark, path, COUNTS)
    assert warehouse.frames["staging.sia_actuals"].collect() == []


# ---------------------------------------------------------------- what a form costs

#: Larger methods are not compiled by the JVM.
COMPILED = 8000


@pytest.mark.parametrize("name", sorted(raw.LANDED))
def test_forms_are_made_by_compiled_methods(spark, tmp_path, name):
    path = tables(spark, tmp_path / "in", ORDERS)
    spark.createDataFrame([], raw.SCHEMAS["events"]).write.parquet(f"{path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = raw.LANDED[name](spark, path)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < COMPILED


def test_groups_hold_the_rows_of_their_length(spark, tmp_path):
    path = tables(spark, tmp_path / "in", [(key, 5, "O", 1.5, None, "1-URGENT") for key in (40, 4, 5, 6, 7)])
    made = raw.activity(spark, path).select("_id", "immunization_coverage_vaccine").collect()
    groups = {int(key): group and json.loads(group) for key, group in made}
    path = "immunization_coverage/vaccine"
    assert groups.pop(40) is None
    assert {k: [e[f"{path}/pos"] for e in g] for k, g in groups.items()} == {4: [], 5: ["1"], 6: ["1", "2"], 7: ["1", "2", "3"]}
    # counts are numbers and texts in turn, left out where they are NULL
    assert groups[7][2][f"{path}/coverage/vaccinated_females"] == (7 * 4 + 2 * 11 + 1) % 23
    assert f"{path}/coverage/vaccinated_males" in groups[6][0] and f"{path}/coverage/vaccinated_males" not in groups[7][0]


def test_groups_are_parsed_behind_the_shuffle(spark, tmp_path, monkeypatch):
    path = tables(spark, tmp_path / "in", ORDERS)
    shuffled, publish = {}, warehouse_module.publish

    def watched(df, name, *args, **options):
        shuffled[name.split(".")[1]] = df.columns, list(options.get("late") or {})
        return publish(df, name, *args, **options)

    monkeypatch.setattr(warehouse_module, "publish", watched)
    src = raw.inputs(spark, path, ("activity",))
    first = Warehouse(src, suffix=f"_{uuid.uuid4().hex}")
    first.refresh_changed(spark, COUNTS)
    columns, late = shuffled["activity"]
    assert late == ["vaccine_rows"] and "vaccine_rows" not in columns and "vaccine" in columns
    fewer = dataclasses.replace(src, forms={"activity": src.forms["activity"].where("_id > '2'")})
    months = Warehouse(fewer, suffix=first.suffix).refresh_changed(spark, COUNTS)
    assert len(months["clean.activity"]) > 1
    stored = published_rows(spark, first.catalog_name("clean.activity"), "date_vaccination_activity")
    found = stored.select("id", F.size("vaccine_rows").alias("n")).where("n >= 0").collect()
    assert {int(r.id): r.n for r in found} == {i: i % 4 for i in range(400) if str(i) > "2" and i % 40}
    assert "vaccine_rows" not in spark.table(first.catalog_name("clean.activity")).columns


def test_a_large_month_is_written_by_several_tasks(spark):
    ensure_namespaces(spark)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    spark.conf.set(size, "64k")
    try:
        month = spark.range(40_000, numPartitions=8).select("id", F.lit("1997-03-04").cast("date").alias("day"), F.uuid().alias("text"))
        got = publish(month, "staging.one_month", "table", "day", hidden=["twice"], late={"twice": F.col("id") * 2})
    finally:
        spark.conf.set(size, before) if before else spark.conf.unset(size)
    assert got.columns == ["id", "day", "text"] and got.count() == 40_000 and len(got.inputFiles()) > 4
    assert published_rows(spark, "staging.one_month", "day").where("twice <> 2 * id or twice is null").count() == 0
