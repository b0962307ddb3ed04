"""Skew handling must not change results, whatever side is hot and however many rows a key has."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.operators.join import broadcast_limit, estimated_bytes, fits_broadcast, sized_join
from fieldtally.operators.lookup import admin_lookup, lookup
from fieldtally.operators.relate import attach_children, attach_parent, campaign_window_join, latest_per_key


@pytest.fixture(scope="module")
def facts(spark):
    """Key 7 holds a third of the rows, another tenth has no key; rows come in exact copies too."""
    return spark.range(3000).selectExpr(
        "id div 2 as id", "case when id % 3 = 0 then 7 when id % 10 = 1 then null else id % 40 end as k", "id % 5 as v")


@pytest.fixture(scope="module")
def dim(spark):
    """Keys 0..29, key 7 twice."""
    return spark.range(31).selectExpr("case when id = 30 then 7 else id end as d", "concat('label ', id) as label")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", ["left", "right", None])
@pytest.mark.parametrize("hot_rows", [1, 50, 10_000_000])
def test_split_join_equals_plain_join(facts, dim, how, hot, hot_rows):
    plain = facts.join(dim, F.col("k") == F.col("d"), how)
    split = sized_join(facts, dim, [("k", "d")], how, hot=hot, hot_rows=hot_rows, limit=-1)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 50])
def test_hot_right_side(facts, dim, how, hot_rows):
    """Parents joined to a skewed child table: childless parents appear once."""
    plain = dim.join(facts, F.col("k") == F.col("d"), how)
    split = sized_join(dim, facts, [("d", "k")], how, hot="right", hot_rows=hot_rows, limit=-1)
    assert rows(split) == rows(plain)


def test_extra_condition(facts, dim):
    condition = (F.col("k") == F.col("d")) & (F.col("v") > 2)
    plain = facts.join(dim, condition, "left")
    split = sized_join(facts, dim, [("k", "d")], extra=F.col("v") > 2, hot_rows=20, limit=-1)
    assert rows(split) == rows(plain)
    with pytest.raises(ValueError):
        sized_join(dim, facts, [("d", "k")], extra=F.col("v") > 2, hot="right", limit=-1)


def test_text_keys_without_value_are_spread(spark):
    left = spark.range(200).selectExpr("id", "case when id % 2 = 0 then null else concat('p', id % 7) end as place")
    right = spark.createDataFrame([("p1", 1), ("p3", 3), (None, 9)], "name string, n int")
    plain = left.join(right, F.col("place") == F.col("name"), "left")
    shuffled = sized_join(left, right, [("place", "name")], hot=None, limit=-1)
    assert rows(shuffled) == rows(plain)


def test_broadcast_only_below_the_limit(spark, facts, dim):
    assert fits_broadcast(dim) and not fits_broadcast(dim, limit=10) and not fits_broadcast(dim, limit=-1)
    assert estimated_bytes(dim) > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2MB")
    try:
        assert broadcast_limit(spark) == 2 << 20
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not fits_broadcast(dim)
        plan = sized_join(facts, dim, [("k", "d")])._jdf.queryExecution().optimizedPlan().toString()
        assert "_s_salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = sized_join(facts, dim, [("k", "d")])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and "_s_salt" not in plan


def test_operators_through_the_split_join(spark):
    options = {"limit": -1, "hot_rows": 5}
    orders = spark.range(60).selectExpr("id as order_id", "id % 4 as place", "id % 6 as day")
    lines = spark.range(100).selectExpr("case when id < 40 then 3 else id end as order_key", "id as line")
    assert rows(attach_parent(lines, orders, ("order_key", "order_id"), ["place"], **options)) == rows(
        attach_parent(lines, orders, ("order_key", "order_id"), ["place"]))
    assert rows(attach_children(orders, lines, ("order_id", "order_key"), ["line"], **options)) == rows(
        attach_children(orders, lines, ("order_id", "order_key"), ["line"]))
    assert rows(latest_per_key(orders, "place", "day", **options)) == rows(latest_per_key(orders, "place", "day"))
    goals = spark.createDataFrame([(0, 1, 3, 10), (0, 2, 5, 20), (1, 0, 0, 30)], "p long, s long, e long, goal long")
    assert rows(campaign_window_join(orders, goals, [("place", "p")], "day", "s", "e", **options)) == rows(
        campaign_window_join(orders, goals, [("place", "p")], "day", "s", "e"))


def test_lookup_compares_codes_as_text(spark):
    facts = spark.createDataFrame([(1, "1"), (2, "x"), (3, None)], "id long, code string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "name int, label string")
    assert rows(lookup(facts, dim, {"code": "name"}, {"label": "out"}), "id", "out") == [(1, "one"), (2, None), (3, None)]
    numbers = facts.select("id")
    assert rows(lookup(numbers, dim, {"id": "name"}, {"label": "out"})) == [(1, "one"), (2, "two"), (3, None)]


def test_area_lookup_with_a_large_dimension(spark):
    facts = spark.range(300).selectExpr("id", "cast(if(id % 3 = 0, 1, id % 50) as string) as admin1")
    areas = {1: spark.range(40).selectExpr("cast(id as int) as name", "concat('area ', id) as label")}
    small = admin_lookup(facts, areas, levels=1)
    large = admin_lookup(facts, areas, levels=1, limit=-1, hot_rows=10, spread_by=["id"])
    assert rows(small) == rows(large)
    assert small.count() == 300
    numbers = facts.withColumn("admin1", F.col("admin1").cast("int"))
    assert rows(admin_lookup(numbers, areas, levels=1, limit=-1, hot_rows=10)) == rows(small)
