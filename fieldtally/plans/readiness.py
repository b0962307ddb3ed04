"""Readiness tables: long question table and facility scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import READINESS, FormSpec
from fieldtally.forms.readiness import CATEGORIES, DICTIONARY_NAME
from fieldtally.functions import count_where, is_yes
from fieldtally.operators.aggregate import readiness_score, with_proportion
from fieldtally.operators.lookup import admin_lookup, indicator_lookup
from fieldtally.operators.publish import bi_projection
from fieldtally.operators.relate import attach_latest, latest_per_key
from fieldtally.operators.reshape import unpivot_pairs, unpivot_questions
from fieldtally.plans.dims import PLACES, Dimensions

ASSESSMENT_COLUMNS = (
    "id", "assessment_date", "vaccine_label", "admin1", "admin2", "admin3", "admin4", "latitude", "longitude",
    "admin5", "indicators_value", "indicators_remarks", "indicators_label", "indicators_category",
    "no_of_questions", "submitted_at", "modified_at", "enumerator",
)
FACILITY = (*PLACES, "latitude", "longitude")


def _visits(form: DataFrame, *columns: str) -> DataFrame:
    """Facility columns of a submission and the listed others."""
    return form.select(
        F.col("id").cast("bigint").alias("id"), *PLACES,
        F.col("admin4_lat").cast("float").alias("latitude"),
        F.col("admin4_long").cast("float").alias("longitude"),
        *columns,
    )


def question_answers(form: DataFrame, dims: Dimensions, spec: FormSpec = READINESS) -> DataFrame:
    """Submission × question: answer, remark, label and category."""
    answers = unpivot_questions(form.select(F.col("id").cast("bigint").alias("id"), *_question_columns(spec)),
                                ["id"], spec.questions)
    return indicator_lookup(answers, dims.indicators, DICTIONARY_NAME).drop("indicator_name")


def assessment(form: DataFrame, dims: Dimensions, spec: FormSpec = READINESS) -> DataFrame:
    """Submission × question with areas, coordinates and category sizes.

    ``assessment_date`` is set only on a facility's latest submissions. Submission-level work (latest
    marker, area labels) is done before the unpivot, on one row per submission.
    """
    visits = _visits(form, "assessment_date", "submitted_at", "modified_at", "enumerator", *_question_columns(spec))
    visits = attach_latest(visits, "admin5", "assessment_date", "latest_assessment", spread_by=["id"])
    visits = admin_lookup(visits, dims.areas, spread_by=["id"])
    keys = ["id", "latest_assessment", *FACILITY, "submitted_at", "modified_at", "enumerator"]
    long = unpivot_questions(visits, keys, spec.questions)
    long = indicator_lookup(long, dims.indicators, DICTIONARY_NAME, dims.readiness_questions)
    return long.withColumns(
        {
            "assessment_date": F.col("latest_assessment"),
            "vaccine_label": F.lit(None).cast("string"),
            "indicators_label": F.trim("indicators_label"),
        }
    ).select(*ASSESSMENT_COLUMNS)


def ready_facilities(form: DataFrame, dims: Dimensions, spec: FormSpec = READINESS, categories: int = CATEGORIES,
                     latest_only: bool = False) -> DataFrame:
    """Facility: readiness value and flag, share of complete categories and its band.

    A facility is its area labels and coordinates, over all its submissions unless ``latest_only``.
    Yes answers are counted per question on the wide form, so only one row per facility code is
    unpivoted, labelled and grouped by category.
    """
    visits = latest_per_key(form, "admin5", "assessment_date", spread_by=["id"]) if latest_only else form
    yes = _visits(visits, *[q.value for q in spec.questions]).groupBy(*FACILITY).agg(
        *[count_where("id", is_yes(q.value)).alias(q.name) for q in spec.questions]
    )
    named = admin_lookup(yes, dims.areas, hot=None)
    counts = unpivot_pairs(named, FACILITY, [(q.name, q.name) for q in spec.questions], "indicator_name", "yes_count")
    counts = indicator_lookup(counts, dims.indicators, DICTIONARY_NAME, dims.readiness_questions)
    per_category = counts.groupBy(*FACILITY, "indicators_category", "no_of_questions").agg(
        F.sum("yes_count").alias("yes_count")
    )
    return readiness_score(with_proportion(per_category), FACILITY, categories)


def public_assessment(staged: DataFrame) -> DataFrame:
    return bi_projection(staged, ASSESSMENT_COLUMNS, ("submitted_at", "modified_at"))


def _question_columns(spec: FormSpec) -> list[str]:
    return list(dict.fromkeys(c for q in spec.questions for c in (q.value, q.remark)))
