"""Relations between fact tables: parents and repeat rows, latest visits, calendar, campaign windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.join import sized_join


def attach_parent(child: DataFrame, parent: DataFrame, key: tuple[str, str], cols: Sequence[str], **options) -> DataFrame:
    """Left join of child rows to their submission; ``key`` is (child column, parent column)."""
    side = parent.select(F.col(key[1]).alias("_parent_key"), *cols)
    return sized_join(child, side, [(key[0], "_parent_key")], "left", hot="left", **options).drop("_parent_key")


def attach_children(parent: DataFrame, child: DataFrame, key: tuple[str, str], cols: Sequence[str], **options) -> DataFrame:
    """Left join of submissions to their repeat rows; childless submissions stay. ``key`` is (parent, child)."""
    side = child.select(F.col(key[1]).alias("_child_key"), *cols)
    return sized_join(parent, side, [(key[0], "_child_key")], "left", hot="right", **options).drop("_child_key")


def join_back(df: DataFrame, agg: DataFrame, key: tuple[str, str], **options) -> DataFrame:
    """Left join of detail rows to an aggregate, keys compared as text; ``key`` is (detail, aggregate)."""
    side = agg.withColumnRenamed(key[1], "_agg_key").withColumn("_agg_key", F.col("_agg_key").cast("string"))
    keyed = df.withColumn("_detail_key", F.col(key[0]).cast("string"))
    return sized_join(keyed, side, [("_detail_key", "_agg_key")], "left", **options).drop("_detail_key", "_agg_key")


def latest_values(df: DataFrame, key: str, order: str) -> DataFrame:
    """Largest ``order`` per key; combines before the shuffle. NULL keys and orders take no part."""
    known = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    return known.groupBy(F.col(key).alias("_latest_key")).agg(F.max(order).alias("_latest_value"))


def latest_per_key(df: DataFrame, key: str, order: str, **options) -> DataFrame:
    """The rows that hold their key's latest value; ties are all kept."""
    pairs = [(key, "_latest_key"), (order, "_latest_value")]
    joined = sized_join(df, latest_values(df, key, order), pairs, "inner", **options)
    return joined.drop("_latest_key", "_latest_value")


def attach_latest(df: DataFrame, key: str, order: str, out: str, **options) -> DataFrame:
    """All rows; ``out`` repeats ``order`` on the latest rows of each key and is NULL elsewhere."""
    pairs = [(key, "_latest_key"), (order, "_latest_value")]
    joined = sized_join(df, latest_values(df, key, order), pairs, "left", **options)
    return joined.drop("_latest_key").withColumnRenamed("_latest_value", out)


def cutoff(df: DataFrame, column: str, as_of: date | str | Column | None = None) -> DataFrame:
    """Rows up to and including the as-of day; today unless given."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(str(as_of)).cast("date")
    return df.where(F.col(column) <= as_of)


def on_spine(spine: DataFrame, facts: DataFrame, day: str, out: str = "date") -> DataFrame:
    """Facts on calendar days; days without facts and facts off the calendar drop out."""
    days = spine.select(F.col("date").cast("date").alias(out))
    return sized_join(facts, days, [(day, out)], "inner")


def campaign_window_join(facts: DataFrame, targets: DataFrame, keys: Sequence[tuple[str, str]], day: str,
                         start: str, end: str, **options) -> DataFrame:
    """Left join of facts to campaigns with equal keys whose window, both ends included, holds the day.

    Overlapping campaigns repeat the fact. The keys are hashed; the window is checked on the matches.
    """
    inside = F.col(day).between(F.col(start), F.col(end))
    return sized_join(facts, targets, keys, "left", extra=inside, **options)
