"""Rapid coverage tables: children by status, submissions, information sources, reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import RAPID_COVERAGE, FormSpec
from fieldtally.forms.rapid_coverage import CHILDREN_COUNTS, INFORMATION_SOURCES, NOT_VACCINATED, REASONS
from fieldtally.functions import fixed_width, typed
from fieldtally.operators.lookup import admin_lookup, choice_lookup
from fieldtally.operators.publish import bi_projection
from fieldtally.operators.repeat import explode_group, group_total, is_parsed
from fieldtally.operators.reshape import drop_unanswered, unpivot_crosstab, unpivot_pairs
from fieldtally.plans.dims import PLACES, Dimensions

SUBMISSION = ("submission_id", "rca_date", *PLACES[:4], "latitude", "longitude", "admin5", "vaccine_administered")


def _submissions(form: DataFrame, dims: Dimensions, labels: DataFrame, *more: str, as_text: bool = False) -> DataFrame:
    """One labelled row per submission, with ``more`` form columns beside the common ones."""
    base = form.select(
        F.col("id").cast("string" if as_text else "bigint").alias("submission_id"),
        F.col("rca_date").cast("string" if as_text else "date").alias("rca_date"),
        *PLACES,
        F.col("admin4_lat").cast("float").alias("latitude"),
        F.col("admin4_long").cast("float").alias("longitude"),
        F.col("vaccine_administered").alias("vaccine_code"),
        *more,
    )
    named = admin_lookup(base, dims.areas, iso=dims.iso, spread_by=["submission_id"])
    named = choice_lookup(named, labels, "vaccine_administered", "vaccine_code", "vaccine_administered")
    return named.withColumn("iso2_code", fixed_width("iso2_code", 50))


def children(form: DataFrame, dims: Dimensions, labels: DataFrame, spec: FormSpec = RAPID_COVERAGE) -> DataFrame:
    """Submission × age group × status × sex: number of children."""
    rows = explode_group(
        _submissions(form, dims, labels, "vaccination"), spec.repeat, [*SUBMISSION, "iso2_code"],
        only=("age_group_label", *[c for _, _, c in CHILDREN_COUNTS]), column="vaccination",
    )
    rows = rows.withColumns({c: typed(c, "bigint", spec.repeat.on_error) for _, _, c in CHILDREN_COUNTS})
    long = unpivot_crosstab(
        rows, [*SUBMISSION, "age_group_label", "iso2_code"], CHILDREN_COUNTS,
        ("rca_category", "indicator_category", "indicator_value"),
    )
    return long.select(*SUBMISSION, "age_group_label", "rca_category", "indicator_category", "indicator_value", "iso2_code")


def submissions(form: DataFrame, dims: Dimensions, labels: DataFrame, spec: FormSpec = RAPID_COVERAGE) -> DataFrame:
    """Submission: doors visited, mop-up, who conducted it and children not vaccinated.

    The total is taken over the submission's own repeat group, without grouping or joining back.
    """
    missed = [c for status, _, c in CHILDREN_COUNTS if status == NOT_VACCINATED]
    more = ("doors_visited", "rca_mop_up", "conducted_by", "vaccination", "submitted_at", "modified_at", "enumerator")
    named = _submissions(form, dims, labels, *more).withColumnRenamed("conducted_by", "conductor_code")
    named = choice_lookup(named, labels, "conducted_by", "conductor_code", "conducted_by")
    return named.select(
        *SUBMISSION, F.col("doors_visited").cast("bigint").alias("doors_visited"), "rca_mop_up", "conducted_by",
        group_total(spec.repeat, missed, "vaccination", is_parsed(form, "vaccination")).alias("total_not_vaccinated"), "iso2_code", "submitted_at", "modified_at", "enumerator",
    )


def information_sources(form: DataFrame, dims: Dimensions, labels: DataFrame) -> DataFrame:
    """Submission × information source: number of doors, answered only."""
    named = _submissions(form, dims, labels, *[c for _, c in INFORMATION_SOURCES])
    return drop_unanswered(
        unpivot_pairs(named, SUBMISSION, INFORMATION_SOURCES, "sources_info", "no_doors", cast="bigint"), "no_doors"
    )


def not_vaccinated_reasons(form: DataFrame, dims: Dimensions, labels: DataFrame,
                           spec: FormSpec = RAPID_COVERAGE) -> DataFrame:
    """Submission × age group × reason: number of children, answered only; id and date stay text."""
    named = _submissions(form, dims, labels, "vaccination", as_text=True)
    rows = explode_group(named, spec.repeat, SUBMISSION, only=[c for _, c in REASONS], column="vaccination")
    cells = rows.withColumns({c: typed(c, "bigint", spec.repeat.on_error) for _, c in REASONS})
    return drop_unanswered(unpivot_pairs(cells, SUBMISSION, REASONS, "reasons", "reasons_value"), "reasons_value")


PUBLIC_COLUMNS = (
    *SUBMISSION, "doors_visited", "rca_mop_up", "conducted_by", "total_not_vaccinated", "iso2_code",
    "submitted_at", "modified_at", "enumerator",
)


def public_submissions(staged: DataFrame) -> DataFrame:
    return bi_projection(staged, PUBLIC_COLUMNS, ("submitted_at", "modified_at"))
