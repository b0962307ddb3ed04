"""Which months of a form changed since the last refresh, from digests of its rows by month.

A digest is the number of a month's rows and two sums over hashes of them, so it does not depend on the order of
rows and combines before the shuffle: one narrow pass, one row a month. A submission that was edited, moved to
another day, lost its day or vanished changes the digest of the months it was and is in; no earlier rows are
kept for that. Sources without a day have one digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

STATE = "source string, month date, dated boolean, rows bigint, digest decimal(38,0), check decimal(38,0)"


def digests(df: DataFrame, source: str, day: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One row a month of ``day``: number of rows and digests over ``columns``, all of them by default.

    Columns that change whenever a row does, such as its id and the connector's time stamp, do as well as all
    and make the pass narrow; ``day`` always counts. Text that is no date counts as no day.
    """
    used = list(dict.fromkeys([*(columns or df.columns), *([day] if day else [])]))
    month = F.trunc(F.col(f"`{day}`").try_cast("date"), "month") if day else F.lit(None).cast("date")
    # the place of each column counts too: equal hashes skip NULLs
    cells = [c for name in used for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    first = F.xxhash64(*cells).cast("decimal(20,0)")
    second = F.xxhash64(F.lit(1), *reversed(cells)).cast("decimal(20,0)")
    rows = df.select(month.alias("month"), first.alias("first"), second.alias("second"))
    keys = ["month"] if day else []
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("first").alias("digest"), F.sum("second").alias("check"))
    return found.select(F.lit(source).alias("source"), *([F.col("month")] if day else [F.lit(None).cast("date").alias("month")]),
                        F.lit(day is not None).alias("dated"), "rows",
                        *[F.coalesce(c, F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("digest", "check")])


def changed(now: Sequence[Row], before: Sequence[Row]) -> dict[str, set[date | None] | None]:
    """Sources whose digests differ: the months that did (None for rows without a day), or None for a source
    without days, one that is new or one that is gone."""
    def by_key(rows: Sequence[Row]) -> dict:
        return {(r["source"], r["dated"], r["month"]): (r["rows"], r["digest"], r["check"]) for r in rows}

    old, new = by_key(before), by_key(now)
    known = {source for source, _, _ in old} & {source for source, _, _ in new}
    out: dict[str, set[date | None] | None] = {}
    for key in sorted(old.keys() | new.keys(), key=str):
        source, dated, month = key
        if old.get(key) == new.get(key):
            continue
        if not dated or source not in known:
            out[source] = None
        elif out.get(source, ()) is not None:
            out.setdefault(source, set()).add(month)
    return out


def read_state(spark: SparkSession, table: str) -> list[Row]:
    """The digests of the last refresh, one row a source and month; none before the first refresh."""
    return spark.table(table).collect() if spark.catalog.tableExists(table) else []
