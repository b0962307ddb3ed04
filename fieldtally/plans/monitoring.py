"""Monitoring tool tables: long question table, visit scores, vaccinated children."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import MONITORING, FormSpec, Question
from fieldtally.forms.monitoring import CATEGORIES, DICTIONARY_NAME, TEAM_QUESTIONS
from fieldtally.operators.aggregate import category_proportion, monitoring_score
from fieldtally.operators.lookup import admin_lookup, indicator_lookup, require_label
from fieldtally.operators.publish import bi_projection
from fieldtally.operators.repeat import explode_group, is_parsed, parse_repeat, repeat_field, short_name
from fieldtally.operators.reshape import drop_unanswered, unpivot_questions
from fieldtally.plans.dims import PLACES, Dimensions

DAY = "date_vaccination_activity"
VISIT = ("id", DAY, *PLACES[:4], "latitude", "longitude", "admin5", "vaccine_label")
TEAMS = "vaccination_team_info"
ANSWER = ("indicators_value", "indicators_remarks", "indicators_label", "indicators_category")


def _visit_answers(visits: DataFrame, keys: tuple[str, ...], spec: FormSpec, remarks: bool = True) -> DataFrame:
    return unpivot_questions(visits, keys, spec.questions, remarks)


def _team_answers(visits: DataFrame, keys: tuple[str, ...], spec: FormSpec, remarks: bool = True) -> DataFrame:
    used = [q.name for q in TEAM_QUESTIONS] + ([q.remark for q in TEAM_QUESTIONS] if remarks else [])
    teams = explode_group(visits, spec.repeat, keys, only=used, column=TEAMS)
    return unpivot_questions(teams, keys, TEAM_QUESTIONS, remarks)


def visit_questions(form: DataFrame, dims: Dimensions, spec: FormSpec = MONITORING) -> DataFrame:
    """Submission × microplan and vaccine-management question."""
    keyed = form.select(F.col("id").cast("bigint").alias("id"), *_question_columns(spec))
    answers = _visit_answers(keyed, ("id",), spec)
    return indicator_lookup(answers, dims.indicators, DICTIONARY_NAME).select("id", *ANSWER)


def team_questions(form: DataFrame, dims: Dimensions, spec: FormSpec = MONITORING) -> DataFrame:
    """Submission × team × vaccination-site question."""
    keyed = form.select(F.col("id").cast("bigint").alias("parent_id"), TEAMS)
    answers = _team_answers(keyed, ("parent_id",), spec)
    return indicator_lookup(answers, dims.indicators, DICTIONARY_NAME).select("parent_id", *ANSWER)


def _question_columns(spec: FormSpec, remarks: bool = True) -> list[str]:
    return [q.value for q in spec.questions] + ([q.remark for q in spec.questions] if remarks else [])


def _visits(form: DataFrame, dims: Dimensions, *columns: str) -> DataFrame:
    """Labelled submissions whose facility is known, with the listed columns."""
    visits = form.select(
        F.col("id").cast("bigint").alias("id"), DAY, *PLACES,
        F.col("admin4_lat").cast("float").alias("latitude"),
        F.col("admin4_long").cast("float").alias("longitude"),
        "vaccine_label", *columns,
    )
    return require_label(admin_lookup(visits, dims.areas, spread_by=["id"]), "admin5")


def _all_answers(form: DataFrame, dims: Dimensions, remarks: bool, spec: FormSpec) -> DataFrame:
    """Submission-level and team-level answers as one table, with labels and category sizes.

    All answers of a submission, its own and those of all its teams, are laid out as one array and
    expanded at once: the form is read and its areas are labelled once.
    """
    visits = _visits(form, dims, *_question_columns(spec, remarks), TEAMS)
    full = {short_name(f): f for f in spec.repeat.fields}
    teams = parse_repeat(TEAMS, spec.repeat.path, [
        full[c] for q in TEAM_QUESTIONS for c in ((q.value, q.remark) if remarks else (q.value,))], spec.repeat.on_error,
        is_parsed(form, TEAMS))

    def cells(questions: Sequence[Question], value: Callable[[str], Column]) -> Column:
        return F.array(*[F.struct(
            F.lit(q.name).alias("indicator_name"), value(q.value).alias("indicators_value"),
            *([value(q.remark).alias("indicators_remarks")] if remarks else [])) for q in questions])

    asked = F.transform(teams, lambda t: cells(
        TEAM_QUESTIONS, lambda c: repeat_field(t, spec.repeat.path, full[c], spec.repeat.fields[full[c]], spec.repeat.on_error)))
    own = cells(spec.questions, F.col)
    answers = visits.select(*VISIT, F.inline(F.coalesce(F.concat(own, F.flatten(asked)), own)))
    return indicator_lookup(answers, dims.indicators, DICTIONARY_NAME, dims.monitoring_questions)


def monitoring_tool(form: DataFrame, dims: Dimensions, spec: FormSpec = MONITORING) -> DataFrame:
    """Submission × (57 questions + 18 per team) with areas, labels and category sizes."""
    return _all_answers(form, dims, True, spec).select(
        *VISIT, *ANSWER, F.col("no_of_questions").cast("int").alias("no_of_questions")
    )


def facility_scores(form: DataFrame, dims: Dimensions, categories: int = CATEGORIES, spec: FormSpec = MONITORING) -> DataFrame:
    """Submission: percent of complete categories and its band.

    The answers of all teams of a visit count against one category size.
    """
    answered = drop_unanswered(_all_answers(form, dims, False, spec), "indicators_value")
    scored = monitoring_score(category_proportion(answered, VISIT), VISIT, categories)
    return scored.withColumnRenamed("vaccine_label", "vaccine_administered").select(
        "id", DAY, *PLACES, "latitude", "longitude", "vaccine_administered", "overall_facility_proportion",
        "overall_proportion_category",
    )


CHILDREN_COLUMNS = (
    "id", *PLACES[:4], "latitude", "longitude", "admin5", DAY, "vaccine_administered",
    "total_vaccinated_as_time_visit", "hc_target", "iso2_code", "submitted_at", "modified_at", "enumerator",
)


def vaccinated_children(form: DataFrame, dims: Dimensions) -> DataFrame:
    """Submission: children vaccinated at the time of the visit and the facility's target."""
    base = form.select(
        F.col("id").cast("bigint").alias("id"), *PLACES,
        F.col("admin4_lat").cast("float").alias("latitude"),
        F.col("admin4_long").cast("float").alias("longitude"),
        DAY,
        F.col("vaccine_label").alias("vaccine_administered"),
        F.col("total_vaccinated_as_time_visit").cast("bigint").alias("total_vaccinated_as_time_visit"),
        F.col("hc_target").cast("bigint").alias("hc_target"),
        "submitted_at", "modified_at", "enumerator",
    )
    return admin_lookup(base, dims.areas, iso=dims.iso, spread_by=["id"]).select(*CHILDREN_COLUMNS)


def public_vaccinated_children(staged: DataFrame) -> DataFrame:
    return bi_projection(staged, CHILDREN_COLUMNS, ("submitted_at", "modified_at"))
