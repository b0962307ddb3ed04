"""Readers for landed forms, choice labels, uploaded dimensions, and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.forms import FormSpec

# Columns of the uploaded dimension files.
DIM_SCHEMAS = {
    "admin": "name string, label string",
    "province_iso2_codes": "admin2_id string, province_label string, iso2_code string",
    "indicators": "form_name string, indicator_name string, indicator_label string, category string",
    "question_counts": "indicators_category string, no_of_questions int",
    "choices": "field string, value string, label string",
    "date_spine": "date date",
}


def read_form(spark: SparkSession, spec: FormSpec, path: str | None = None, table: str | None = None,
              format: str = "parquet", spread: int | None = None) -> DataFrame:
    """A landed form, from a catalog table or from files; files are read with the form's own schema.

    A file is read in as many tasks as it has row groups, however many cores there are. Forms that ``land_form``
    writes have enough of them. For others, such as one file that a connector wrote in one row group, ``spread``
    deals the rows over that many partitions: a lazy shuffle of the columns that a table uses, below which columns
    and filters still reach the scan.
    """
    if table is not None:
        rows = spark.table(table).select(*[F.col(f"`{c}`") for c in spec.landed_columns()])
    else:
        rows = spark.read.schema(spec.landed_schema()).format(format).load(path)
    return rows if spread is None else rows.repartition(spread)


def land_form(form: DataFrame, path: str | None = None, table: str | None = None, mode: str = "error",
              row_group_bytes: int = 4 << 20) -> None:
    """Write a landed form as Parquet in row groups of bounded size, so that also a form of one file is read by
    many tasks. ``row_group_bytes`` is about the size in memory; forms of very many files do well with 128 MB."""
    writer = form.write.mode(mode).format("parquet").option("compression", "zstd").option("parquet.block.size", row_group_bytes)
    writer.saveAsTable(table) if table is not None else writer.save(path)


def read_dim(spark: SparkSession, name: str, path: str, format: str = "csv") -> DataFrame:
    """An uploaded dimension; ``admin1`` .. ``admin5`` share one layout."""
    kind = "admin" if name.startswith("admin") else name
    reader = spark.read.schema(DIM_SCHEMAS[kind])
    if format == "csv":
        return reader.csv(path, header=True, enforceSchema=False)
    return reader.format(format).load(path)


def rename_choices(choices: DataFrame) -> DataFrame:
    """Choice table (field, value, label) under its reporting names."""
    return choices.select(F.col("field").alias("question"), F.col("value").alias("code"), F.col("label"))


def read_choice_labels(spark: SparkSession, table: str) -> DataFrame:
    return rename_choices(spark.table(table))


def date_spine(spark: SparkSession, start: date | str = "2022-12-01", end: date | str | None = None) -> DataFrame:
    """One row per day from start to end, both included; the end defaults to today."""
    last = F.current_date() if end is None else F.lit(str(end)).cast("date")
    return spark.range(1).select(F.explode(F.sequence(F.lit(str(start)).cast("date"), last)).alias("date"))


def spine_between(facts: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last day on which ``facts`` has a row."""
    ends = facts.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("date"))
