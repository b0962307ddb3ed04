"""Queries on written forms and tables: landing and reading a form, CSV dimensions, refresh by change.

What they write goes to the folder that all executors share, under a name of its own.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.driver import mart_queries as marts
from fieldtally.driver import raw_forms as raw
from fieldtally.driver.registry import query
from fieldtally.forms import ACTIVITY, FORMS
from fieldtally.plans.warehouse import Inputs, Warehouse
from fieldtally.session import shared_folder
from fieldtally.sources import land_form, read_choice_labels, read_dim, read_form

#: The tables that the two refresh queries keep.
COUNTS = ("clean.activity", "staging.sia_actuals")
DAILY = ("clean.activity", "clean.target", "staging.sia_targets", "staging.sia_vaccine_dose",
         "staging.aggregated_sia_actuals_target")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def landed_inputs(spark: SparkSession, sf_dir: str, forms: tuple[str, ...], spread: bool = True, **how: int) -> Inputs:
    """Inputs whose forms were landed as files and are read from them, their rows dealt over the cores by a shuffle
    unless ``spread`` is off. ``how`` goes to ``land_form``."""
    src = raw.inputs(spark, sf_dir, forms)
    read = {}
    for name in forms:
        path = _folder(spark, f"landed-{name}")
        land_form(src.forms[name], path, **how)
        read[name] = read_form(spark, FORMS[name], path, spread=spark.sparkContext.defaultParallelism if spread else None)
    return dataclasses.replace(src, forms=read)


@query("landed_form", marts.SIA_RECORDS)
def landed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Warehouse(landed_inputs(spark, sf_dir, ("activity",)))["staging.sia_records"]


@query("landed_repeat", marts.RCA_ACTUALS)
def landed_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Warehouse(landed_inputs(spark, sf_dir, ("rapid_coverage",)))["staging.rca_actuals"]


@query("csv_dimension", """select cast(p_partkey as varchar) as name, p_name as label from part""")
def csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "admin4")
    areas = raw.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("label"))
    areas.write.option("header", True).csv(path)
    return read_dim(spark, "admin4", path)


@query("landed_choices", """select distinct 'vaccine_administered' as question, o_orderpriority as code,
                                   concat('vaccine ', o_orderpriority) as label from orders""")
def landed_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"landing_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}/{database}.db'")
    listed = raw.table(spark, sf_dir, "orders").select(
        F.lit("vaccine_administered").alias("field"), F.col("o_orderpriority").alias("value"),
        F.concat(F.lit("vaccine "), "o_orderpriority").alias("label")).distinct()
    listed.write.saveAsTable(f"{database}.activity_choices")
    return read_choice_labels(spark, f"{database}.activity_choices")


def earlier(form: DataFrame) -> DataFrame:
    """The activity form as it was before: some submissions on other days, one month without any, some not
    there yet, some with a day that they lost since, some that are gone now, other counts in one month."""
    key, day = F.col("_id").cast("bigint"), F.col("campaign_activity_details_date_vaccination_activity")
    in_ = F.date_format(day, "yyyy-MM")
    moved = (F.when(key % 1009 == 1, F.date_add(day, 40)).when(in_ == "1997-03", F.to_date(F.lit("1997-04-09")))
             .when(key % 997 == 2, F.lit(None).cast("date")).otherwise(day))
    used = F.when(in_ == "1996-08", F.lit(1)).otherwise(F.col("vaccine_logistics_vials_used"))
    gone = form.where(key % 1013 == 5).withColumns({"_id": (key + 100_000_000).cast("string"),
                                                    "_airbyte_raw_id": F.concat(F.lit("gone"), F.col("_id"))})
    return (form.where(key % 991 != 3).withColumns({day_column(): moved, "vaccine_logistics_vials_used": used})
            .unionByName(gone).select(*ACTIVITY.landed_columns()))


def day_column() -> str:
    return "campaign_activity_details_date_vaccination_activity"


def refreshed(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> tuple[Warehouse, dict]:
    """A warehouse that was built on the earlier form and then refreshed by change, and the months that took.

    Each refresh reads a form twice, for its digests and for the tables. Forms are landed first, as a connector does,
    so that those passes read the columns of a file and none of them makes the form anew.
    """
    src = landed_inputs(spark, sf_dir, tuple(n.split(".")[1] for n in names if n.startswith("clean.")), spread=False,
                        row_group_bytes=32 << 20)
    before = dataclasses.replace(src, forms={**src.forms, "activity": earlier(src.forms["activity"])})
    place = {"suffix": f"_{uuid.uuid4().hex}", "location": shared_folder(spark)}
    Warehouse(before, **place).refresh_changed(spark, names)
    now = Warehouse(src, **place)
    return now, now.refresh_changed(spark, names)


@query("refresh_changed", marts.SIA_ACTUALS)
def refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, _ = refreshed(spark, sf_dir, COUNTS)
    return warehouse.frames["staging.sia_actuals"]


@query("refresh_changed_daily", marts.AGGREGATED)
def refresh_changed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, _ = refreshed(spark, sf_dir, DAILY)
    return warehouse.frames["staging.aggregated_sia_actuals_target"]


for _form, _name in (("readiness", "readiness_labels"), ("rapid_coverage", "rca_labels"), ("activity", "sia_labels")):
    # labels that the form lists and the number of submissions that chose each
    def _labels(spark: SparkSession, sf_dir: str, name: str = _name) -> DataFrame:
        labels = Warehouse(raw.inputs(spark, sf_dir, ()))[f"clean.{name}"]
        chosen = raw.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("code")).agg(
            F.count(F.lit(1)).alias("chosen"))
        return labels.join(chosen, "code", "left").select("question", "code", "label", "chosen")

    query(f"clean_{_name}", f"""
        select question, code, label, (select case when count(*) > 0 then count(*) end from orders where o_orderpriority = code) as chosen
        from {marts.CHOICES}""")(_labels)
