"""Joins that hold when a side outgrows memory or one key holds a large share of the rows.

``sized_join`` broadcasts the smaller side only when the optimizer's size estimate is below the
session's broadcast threshold. Otherwise it shuffles, and keys that hold more rows than one task
should take are split: each of their rows goes to one of n sub-keys and the matching rows of the
other side are copied to all n. Results are those of the plain join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that a single task may hold; a key with more is split.
HOT_ROWS = 4_000_000
# Sub-keys over which rows with a NULL key, which match nothing, are spread.
NULL_SPREAD = 1024

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; negative when broadcasting is off."""
    return bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def bytes_of(text: str) -> int:
    """A setting such as ``64MB`` as a number."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)(?:i?b)?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose it."""
    execution = getattr(df, "_jdf", None)
    if execution is None:
        return None
    return int(str(execution.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    if limit < 0:
        return False
    size = estimated_bytes(df)
    return size is not None and size <= limit


def _hot_keys(df: DataFrame, keys: Sequence[str], names: Sequence[str], factor: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of sub-keys each needs.

    At most rows / hot_rows keys qualify, which bounds the result; counts combine before the shuffle.
    """
    counts = (
        df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return counts.where(F.col("_rows") > hot_rows).select(
        *names, F.ceil(F.col("_rows") / hot_rows).cast("int").alias(factor)
    )


def _equal(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in pairs])


def _hashable(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def sized_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left",
               extra: Column | None = None, hot: str | None = "left", spread_by: Sequence[str] | None = None,
               counted: DataFrame | None = None, hot_rows: int = HOT_ROWS, limit: int | None = None,
               size_of: Sequence[DataFrame] | None = None) -> DataFrame:
    """Left or inner join on ``on`` = [(left column, right column)]; column names must not overlap.

    ``hot`` names the side whose keys may be skewed, None where the rows were already combined per
    group, so that a key holds few. ``spread_by`` columns tell the rows of one key apart (default: all
    columns). ``counted`` is a cheaper frame to count the skewed side's keys on. ``size_of`` lists the
    tables that must fit for ``right`` to be broadcast, where ``right`` joins several.
    """
    condition = _equal(on) if extra is None else _equal(on) & extra
    if all(fits_broadcast(side, limit) for side in (size_of or [right])):
        return left.join(F.broadcast(right), condition, how)
    if hot is None:
        return _shuffled(left, right, on, how, extra)
    if hot == "right" and how == "left" and extra is not None:
        raise ValueError("a left join with an extra condition needs hot='left'")

    skewed, other = (left, right) if hot == "left" else (right, left)
    skewed_keys = [a if hot == "left" else b for a, b in on]
    other_keys = [b if hot == "left" else a for a, b in on]
    source = skewed if counted is None else counted

    s_names = [f"_hs{i}" for i in range(len(on))]
    o_names = [f"_ho{i}" for i in range(len(on))]
    s_hot = F.broadcast(_hot_keys(source, skewed_keys, s_names, "_s_factor", hot_rows))
    o_hot = F.broadcast(_hot_keys(source, skewed_keys, o_names, "_o_factor", hot_rows))

    spread = F.xxhash64(*[F.col(f"`{c}`") for c in (spread_by or _hashable(skewed))])
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in skewed_keys])
    split = skewed.join(s_hot, _equal(list(zip(skewed_keys, s_names))), "left").withColumn(
        "_s_salt",
        F.when(no_key, F.pmod(spread, F.lit(NULL_SPREAD)))
        .when(F.col("_s_factor").isNotNull(), F.pmod(spread, F.col("_s_factor")))
        .otherwise(0)
        .cast("int"),
    )
    copies = other.join(o_hot, _equal(list(zip(other_keys, o_names))), "left").withColumn(
        "_o_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_o_factor"), F.lit(1)) - 1))
    )

    salted = condition & (F.col("_s_salt") == F.col("_o_salt"))
    if hot == "left":
        joined = split.join(copies, salted, how)
    else:
        joined = copies.join(split.withColumn("_matched", F.lit(True)), salted, how)
        if how == "left":
            # A copied left row finds its matches spread over the sub-keys; the empty ones are no result.
            joined = joined.where(F.col("_o_factor").isNull() | F.col("_matched").isNotNull())
    return joined.select(*[F.col(f"`{c}`") for c in left.columns + right.columns])


def _shuffled(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str,
              extra: Column | None) -> DataFrame:
    """Plain join left to the optimizer, which at run time broadcasts a side that turns out small and splits
    large partitions. Left rows with a NULL text key, which match nothing, are spread over the tasks."""
    kinds = dict(left.dtypes)
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(left)]), F.lit(NULL_SPREAD)))
    keys = [F.coalesce(F.col(a), spread) if kinds[a] == "string" else F.col(a) for a, _ in on]
    condition = reduce(lambda a, b: a & b, [key == F.col(b) for key, (_, b) in zip(keys, on)])
    return left.join(right, condition if extra is None else condition & extra, how)
