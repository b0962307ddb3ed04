"""Namespaces, views and tables that reporting tools read."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.join import bytes_of

LAYERS = ("clean", "staging", "public")
#: The view's property that lists the batch of every month it shows.
_BATCHES = "shown_batches"
#: Deletes a query's shuffle files when it ends; otherwise they stay until the driver's garbage collector meets them.
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def ensure_namespaces(spark: SparkSession, names: Sequence[str] = LAYERS, location: str | None = None) -> None:
    """Create the namespaces that are not there, their tables below ``location`` where one is given."""
    for name in names:
        place = f" LOCATION '{location}/{name}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def bi_projection(df: DataFrame, columns: Sequence[str], date_columns: Sequence[str] = ()) -> DataFrame:
    """The listed columns, timestamps among ``date_columns`` cut to dates."""
    return df.select(
        *[F.col(c).cast("date").alias(c) if c in date_columns else F.col(c) for c in columns]
    )


def month_column(month_of: str) -> str:
    return f"{month_of}_month"


def batch_column(month_of: str) -> str:
    return f"{month_of}_batch"


def versions(name: str) -> tuple[str, str]:
    """The two tables that take turns behind the view ``layer.name``."""
    return f"{name}__a", f"{name}__b"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that the view ``layer.name`` reads now."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    return next((v for v in versions(name) if v.split(".")[-1] in text), None)


def in_months(df: DataFrame, month: Column, months: Collection[date | None]) -> DataFrame:
    """Rows of the given months; None stands for rows without one."""
    known = [F.lit(m) for m in sorted(m for m in months if m is not None)]
    wanted = month.isin(*known) if known else F.lit(False)
    return df.where(wanted | month.isNull() if None in months else wanted)


def from_month(df: DataFrame, day: Column, since: str) -> DataFrame:
    """Rows whose day, or month, is not before the month of ``since``, and rows without one."""
    return df.where((day >= F.trunc(F.lit(since).cast("date"), "month")) | day.isNull())


@contextmanager
def bounded_shuffles(spark: SparkSession, expands: bool = False) -> Iterator[None]:
    """Each write inside leaves no shuffle files behind: of the tables written one after the other only one's are there.

    Where rows are expanded behind the shuffle, a task is given an eighth of the bytes.
    """
    settings = {_DELETE_SHUFFLES: "true"}
    if expands:
        settings[_TASK_BYTES] = str(max(1, bytes_of(spark.conf.get(_TASK_BYTES)) // 8))
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def publish(df: DataFrame, name: str, mode: str = "view", month_of: str | None = None, since: str | None = None,
            format: str = "parquet", months: Collection[date | None] | None = None, retain: int = 0,
            hidden: Sequence[str] = (), late: Mapping[str, Column] | None = None,
            expand: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """Expose ``layer.name`` as a replaceable session view or as written rows, and return what readers see.

    In table mode readers use the catalog view ``layer.name``, and every change reaches them by one replacement of
    that view: they find the old rows or the new ones, never a mix, and a failed write leaves the old ones. A full
    write goes to the one of two tables behind the view that is not read.

    Rows with ``month_of`` are partitioned by the month of that day and by the batch that wrote them; the view
    names the batch of every month. With ``months`` (None among them stands for rows without a day), or with
    ``since`` for every month from that day's on and rows without a day, only those are replaced: their new rows are
    appended as a new batch beside the old one, which the view then leaves out. ``df`` may hold rows of other
    months; the filter on them reaches the scan of what it reads. A month without new rows is left out too. Which
    months a batch holds is read from the list of partitions, so ``df`` is evaluated once. Replaced partitions
    are dropped, but for the last ``retain`` batches, which readers that began before may still be reading.

    Columns are matched by name; a table with other columns is written in full. ``hidden`` columns are written but
    not shown by the view. The rebalance hint sizes the files: large months are split over several tasks, small
    ones share one. ``late`` are hidden columns that are made from the others behind that shuffle, which then does
    not carry them. ``expand`` makes the table's rows from those of ``df``, with the columns that it is told to keep, also
    behind that shuffle, which carries one row where the table has many; it must not change ``month_of``.
    """
    late, expands, expand = late or {}, expand is not None, expand or (lambda rows, keep: rows)
    spark = df.sparkSession
    whole = expand(df, ())
    shown = [c for c in whole.columns if c not in hidden and c not in late]
    if mode == "view":
        view = name.replace(".", "__")
        whole.select(*shown).createOrReplaceTempView(view)
        return spark.table(view)
    if mode != "table":
        raise ValueError(f"unknown mode {mode!r}")
    now = current_version(spark, name)
    if month_of is None:
        target = versions(name)[now == versions(name)[0]]
        with bounded_shuffles(spark, expands):
            _writer(whole.withColumns(late), format).mode("overwrite").saveAsTable(target)
        return publish_alias(spark, name, target, shown)
    month, batch = month_column(month_of), batch_column(month_of)
    dated = df.withColumn(month, F.trunc(F.col(month_of).try_cast("date"), "month"))
    partial = since is not None or months is not None
    if partial and now is not None and set(spark.table(now).columns) == {*whole.columns, month, *late, batch}:
        recent = in_months(dated, F.col(month), months) if months is not None else from_month(dated, F.col(month), since)
        written = _partitions(spark, now, month, batch)
        new = max((b for _, b in written), default=0) + 1
        full = expand(recent.withColumn(batch, F.lit(new)).hint("rebalance", F.col(month)), (month, batch)).withColumns(late)
        with bounded_shuffles(spark, expands):
            full.select(*spark.table(now).columns).write.mode("append").insertInto(now)
        spark.catalog.refreshTable(now)
        added = {m: new for m, b in _partitions(spark, now, month, batch) if b == new}
        first = None if since is None else date.fromisoformat(since[:10]).replace(day=1)
        before = batches(spark, name)
        kept = {m: b for m, b in before.items()
                if (m not in months if months is not None else m is not None and m < first)}
        _show(spark, name, now, shown, month, batch, kept | added)
        for m, b in written:
            if kept.get(m) != b and b <= new - 1 - retain:
                spark.sql(f"ALTER TABLE {now} DROP IF EXISTS PARTITION ({month} = {_literal(m)}, {batch} = {b})")
        spark.catalog.refreshTable(now)
        return spark.table(name)
    target = versions(name)[now == versions(name)[0]]
    full = expand(dated.withColumn(batch, F.lit(1)).hint("rebalance", F.col(month)), (month, batch)).withColumns(late)
    with bounded_shuffles(spark, expands):
        _writer(full, format).mode("overwrite").partitionBy(month, batch).saveAsTable(target)
    return _show(spark, name, target, shown, month, batch, {m: b for m, b in _partitions(spark, target, month, batch)})


def _writer(df: DataFrame, format: str) -> DataFrameWriter:
    """Parquet is written in zstandard: two batches of a month lie side by side until readers see the new one."""
    writer = df.write.format(format)
    return writer.option("compression", "zstd") if format == "parquet" else writer


def _literal(month: date | None) -> str:
    return "null" if month is None else f"date'{month}'"


def _partitions(spark: SparkSession, table: str, month: str, batch: str) -> list[tuple[date | None, int]]:
    """Month and batch of every partition, from the catalog: no rows are read. Months are few, a dozen a year."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in row.partition.split("/"))
        missing = values[month] in ("null", "__HIVE_DEFAULT_PARTITION__")
        found.append((None if missing else date.fromisoformat(values[month]), int(values[batch])))
    return found


def batches(spark: SparkSession, name: str) -> dict[date | None, int]:
    """The batch that the view ``layer.name`` shows of each month."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == _BATCHES).collect()
    listed = json.loads(rows[0]["value"]) if rows else []
    return {None if m is None else date.fromisoformat(m): b for m, b in listed}


def _in_batches(shown: dict[date | None, int], month: str, batch: str) -> str:
    """A filter on the partitions that are shown."""
    terms = []
    for b in sorted(set(shown.values())):
        months = sorted(m for m, x in shown.items() if x == b and m is not None)
        which = [f"`{month}` IN ({', '.join(map(_literal, months))})"] if months else []
        which += [f"`{month}` IS NULL"] if shown.get(None) == b else []
        terms.append(f"(`{batch}` = {b} AND ({' OR '.join(which)}))")
    return " OR ".join(terms) or "false"


def _show(spark: SparkSession, name: str, table: str, columns: Sequence[str], month: str, batch: str,
          shown: dict[date | None, int]) -> DataFrame:
    """Point the view at the given batches: the one step by which readers get a partial or full write."""
    listed = ", ".join(f"`{c}`" for c in columns)
    value = json.dumps([[None if m is None else str(m), b] for m, b in shown.items()])
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_BATCHES}' = '{value}') AS "
              f"SELECT {listed} FROM {table} WHERE {_in_batches(shown, month, batch)}")
    return spark.table(name)


def published_rows(spark: SparkSession, name: str, month_of: str | None = None, since: str | None = None,
                   months: Collection[date | None] | None = None) -> DataFrame:
    """Published rows with their hidden columns, of all months or of those that ``since`` or ``months`` name, by a
    filter on the partitions."""
    table = spark.table(current_version(spark, name))
    if month_of is None:
        return table
    month, batch = month_column(month_of), batch_column(month_of)
    rows = table
    if months is not None:
        rows = in_months(rows, F.col(month), months)
    elif since is not None:
        rows = from_month(rows, F.col(month), since)
    return rows.where(_in_batches(batches(spark, name), month, batch)).drop(month, batch)


def recent_rows(spark: SparkSession, name: str, month_of: str, since: str) -> DataFrame:
    """Published rows of the months from ``since`` on and without a day, by a filter on the partitions."""
    return published_rows(spark, name, month_of, since).select(*spark.table(name).columns)


def publish_projection(spark: SparkSession, name: str, source: str, columns: Sequence[str],
                       date_columns: Sequence[str] = ()) -> DataFrame:
    """``bi_projection`` of a written table as a catalog view: nothing is copied."""
    listed = ", ".join(f"CAST(`{c}` AS date) AS `{c}`" if c in date_columns else f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {source}")
    return spark.table(name)


def publish_alias(spark: SparkSession, name: str, source: str, columns: Sequence[str]) -> DataFrame:
    """Expose a written table under a second name without copying it."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {source}")
    return spark.table(name)
