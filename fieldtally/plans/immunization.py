"""Immunization activity tables: counts, targets, doses, target against actual, reasons, records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import ACTIVITY, TARGET, FormSpec
from fieldtally.forms.activity import (
    COVERAGE_COUNTS,
    DEFERRED,
    DEFERRED_VACCINATED,
    REACHED,
    REASON_COUNTS,
    REFUSED,
    REFUSED_VACCINATED,
    STATUS_FIELDS,
    VACCINATED,
)
from fieldtally.functions import days_between, sum_of_cells
from fieldtally.operators.lookup import admin_lookup, areas_fit, iso_lookup
from fieldtally.operators.publish import bi_projection
from fieldtally.operators.relate import campaign_window_join, cutoff, on_spine
from fieldtally.operators.join import sized_join
from fieldtally.operators.repeat import explode_group, narrow_group
from fieldtally.operators.reshape import drop_unanswered, unpivot_crosstab
from fieldtally.plans.dims import PLACES, Dimensions

DAY = "date_vaccination_activity"
_ACTUALS_FIELDS = ("age_group_label", *[c for _, _, c in COVERAGE_COUNTS])


def _submissions(form: DataFrame, *more: str) -> DataFrame:
    return form.select(
        F.col("id").cast("bigint").alias("submission_id"), DAY, *PLACES,
        F.col("admin4_lat").cast("float").alias("latitude"),
        F.col("admin4_long").cast("float").alias("longitude"),
        F.col("vaccine_label").alias("vaccine_administered"),
        *more,
    )


def named_submissions(form: DataFrame, dims: Dimensions, spec: FormSpec = ACTIVITY) -> DataFrame:
    """Submissions with area labels and only the fields of the repeat group that ``actuals`` expands."""
    narrow = narrow_group(_submissions(form, "vaccine"), spec.repeat, _ACTUALS_FIELDS, column="vaccine")
    return admin_lookup(narrow, dims.areas, spread_by=["submission_id"])


def expanded_actuals(named: DataFrame, spec: FormSpec = ACTIVITY, keep: Sequence[str] = ()) -> DataFrame:
    """``actuals`` from ``named_submissions``, with the columns ``keep`` of these behind the others."""
    keys = ["submission_id", DAY, *PLACES[:4], "latitude", "longitude", "admin5", "vaccine_administered", *keep]
    rows = explode_group(named, spec.repeat, keys, only=_ACTUALS_FIELDS, column="vaccine")
    long = unpivot_crosstab(rows, [*keys, "age_group_label"], COVERAGE_COUNTS,
                            ("coverage_category", "indicator_category", "indicator_value"))
    return long.select(*[c for c in long.columns if c not in keep], *keep)


def actuals(form: DataFrame, dims: Dimensions, spec: FormSpec = ACTIVITY) -> DataFrame:
    """Submission × age group × status × sex: number of children."""
    return expanded_actuals(named_submissions(form, dims, spec), spec)


def unreached_reasons(form: DataFrame, dims: Dimensions, spec: FormSpec = ACTIVITY) -> DataFrame:
    """Submission × age group × deferral or refusal reason: number of children, answered only."""
    named = admin_lookup(_submissions(form, "vaccine"), dims.areas, spread_by=["submission_id"])
    keys = ["submission_id", DAY, *PLACES, "vaccine_administered"]
    rows = explode_group(named, spec.repeat, keys,
                         only=("age_group_label", *[c for _, _, c in REASON_COUNTS]), column="vaccine")
    long = unpivot_crosstab(rows, [*keys, "age_group_label"], REASON_COUNTS,
                            ("reason_category", "coverage_category", "reasons_value"))
    return drop_unanswered(long, "reasons_value").select(
        *keys, "age_group_label", "reason_category", "reasons_value", "coverage_category"
    )


def targets(form: DataFrame, dims: Dimensions, spec: FormSpec = TARGET) -> DataFrame:
    """Campaign × age group: target; campaigns without age groups stay."""
    base = form.select(
        *PLACES,
        F.col("campaign_start_date").cast("date").alias("campaign_start_date"),
        F.col("campaign_end_date").cast("date").alias("campaign_end_date"),
        F.col("vaccine_label").alias("vaccine_administered"),
        "target_children",
    )
    named = admin_lookup(base, dims.areas).withColumn(
        "campaign_days", days_between("campaign_end_date", "campaign_start_date")
    )
    keys = [*PLACES, "campaign_start_date", "campaign_end_date", "campaign_days", "vaccine_administered"]
    rows = explode_group(named, spec.repeat, keys, only=("no_children", "age_group_label"),
                         column="target_children", outer=True)
    return rows.select(*keys, F.col("no_children").alias("campaign_target"), "age_group_label")


def _by_area(base: DataFrame, dims: Dimensions, keys: Sequence[str], combine: Mapping[str, Column],
             expand: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Submissions with area codes, expanded and combined per area label and the other ``keys``.

    ``combine`` maps a column to its sum or maximum. Small area tables are joined to the submissions in
    place and one shuffle groups the rows. When one is too large to broadcast, rows are first combined
    per code, so that only groups are shuffled to the labels.
    """
    aggregates = [c.alias(name) for name, c in combine.items()]
    if areas_fit(dims.areas):
        return expand(admin_lookup(base, dims.areas)).groupBy(*keys).agg(*aggregates)
    coded = expand(base).groupBy(*keys).agg(*aggregates)
    return admin_lookup(coded, dims.areas, hot=None).groupBy(*keys).agg(*aggregates)


def doses(form: DataFrame, dims: Dimensions) -> DataFrame:
    """Day × facility × vaccine: vials used and discarded, doses, vial size."""
    keys = [DAY, *PLACES, "vaccine_administered"]
    base = form.select(
        DAY, *PLACES, F.col("vaccine_label").alias("vaccine_administered"), "vial_dosage",
        F.col("vials_used").cast("bigint").alias("vials_used"),
        (F.col("vial_dosage").cast("bigint") * F.col("vials_used")).alias("vaccine_dose"),
        F.col("vials_discarded").cast("bigint").alias("vials_discarded"),
    )
    measures = {c: F.sum(c) for c in ("vials_used", "vaccine_dose", "vials_discarded")}
    found = _by_area(base, dims, keys, {"vial_dosage": F.max("vial_dosage"), **measures})
    return found.withColumn("vial_dosage", F.col("vial_dosage").cast("string"))


def _status_totals(form: DataFrame, dims: Dimensions, spine: DataFrame, as_of: date | str | None,
                   totals: Mapping[str, Sequence[str]], by: Sequence[str], spec: FormSpec) -> DataFrame:
    """Children per calendar day up to the as-of day, facility, vaccine and ``by``.

    ``totals`` maps output to the statuses it adds up. Counts are added across the columns of a row, so
    nothing is unpivoted.
    """
    place_keys = ["date", *PLACES, "latitude", "longitude", "vaccine_administered"]
    fields = [c for statuses in totals.values() for s in statuses for c in STATUS_FIELDS[s]]
    cells = [
        sum_of_cells(*[F.col(c).cast("bigint") for s in statuses for c in STATUS_FIELDS[s]]).alias(out)
        for out, statuses in totals.items()
    ]

    def age_groups(days: DataFrame) -> DataFrame:
        rows = explode_group(days, spec.repeat, place_keys, only=(*by, *fields), column="vaccine")
        return rows.select(*place_keys, *by, *cells)

    days = on_spine(cutoff(spine, "date", as_of), _submissions(form, "vaccine"), DAY)
    return _by_area(days, dims, [*place_keys, *by], {out: F.sum(out) for out in totals}, age_groups)


def target_totals(staged_targets: DataFrame) -> DataFrame:
    """Campaign target of a facility and vaccine over all age groups."""
    keys = ["admin5", "vaccine_administered", "campaign_start_date", "campaign_end_date"]
    return staged_targets.groupBy(*keys).agg(F.sum("campaign_target").alias("campaign_target"))


def daily_against_target(form: DataFrame, staged_targets: DataFrame, staged_doses: DataFrame, dims: Dimensions,
                         spine: DataFrame, as_of: date | str | None = None, spec: FormSpec = ACTIVITY) -> DataFrame:
    """Day × facility × vaccine: children reached, campaign target, vials and doses."""
    facts = _status_totals(form, dims, spine, as_of, {"total_vaccinated": REACHED}, (), spec)
    goals = _prefixed(target_totals(staged_targets), "_t_", "campaign_target")
    facts = campaign_window_join(
        facts, goals, [("vaccine_administered", "_t_vaccine_administered"), ("admin5", "_t_admin5")],
        "date", "_t_campaign_start_date", "_t_campaign_end_date", hot=None,
    )
    vials = _prefixed(
        staged_doses.select(DAY, "admin5", "vaccine_administered", "vials_used", "vials_discarded", "vaccine_dose", "vial_dosage"),
        "_d_", "vials_used", "vials_discarded", "vaccine_dose", "vial_dosage",
    )
    facts = sized_join(
        facts, vials,
        [("date", f"_d_{DAY}"), ("vaccine_administered", "_d_vaccine_administered"), ("admin5", "_d_admin5")],
        hot=None,
    )
    return facts.select(
        "date", *PLACES, "vaccine_administered", "total_vaccinated", "campaign_target", "vials_used",
        "vials_discarded", "vaccine_dose", "vial_dosage", "latitude", "longitude",
    )


def daily_by_age_group(form: DataFrame, staged_targets: DataFrame, dims: Dimensions, spine: DataFrame,
                       as_of: date | str | None = None, spec: FormSpec = ACTIVITY) -> DataFrame:
    """Day × facility × vaccine × age group: five measures, campaign target, province ISO code."""
    totals = {
        "total_vaccinated": (VACCINATED,),
        "total_deferred": (DEFERRED,),
        "total_refused": (REFUSED,),
        "total_vaccinated_previously_deferred": (DEFERRED_VACCINATED,),
        "total_vaccinated_previously_refused": (REFUSED_VACCINATED,),
    }
    facts = _status_totals(form, dims, spine, as_of, totals, ("age_group_label",), spec)
    goals = _prefixed(
        staged_targets.select("admin5", "vaccine_administered", "age_group_label", "campaign_start_date",
                              "campaign_end_date", "campaign_target"),
        "_t_", "campaign_target",
    )
    facts = campaign_window_join(
        facts, goals,
        [(k, f"_t_{k}") for k in ("vaccine_administered", "age_group_label", "admin5")],
        "date", "_t_campaign_start_date", "_t_campaign_end_date", hot=None,
    )
    facts = iso_lookup(facts, dims.iso, "admin2", on="province_label", hot=None)
    return facts.select(
        "date", *PLACES, "vaccine_administered", "total_vaccinated", "campaign_target", "age_group_label",
        "latitude", "longitude", "iso2_code", *[m for m in totals if m != "total_vaccinated"],
    )


def records(form: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per submission."""
    base = _submissions(form, "submitted_at", "modified_at", "enumerator").drop("latitude", "longitude")
    return admin_lookup(base, dims.areas, spread_by=["submission_id"]).select(*RECORD_COLUMNS)


RECORD_COLUMNS = (
    "submission_id", DAY, *PLACES, "vaccine_administered", "submitted_at", "modified_at", "enumerator",
)


def public_records(staged: DataFrame) -> DataFrame:
    return bi_projection(staged, RECORD_COLUMNS, ("submitted_at", "modified_at"))


def _prefixed(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
