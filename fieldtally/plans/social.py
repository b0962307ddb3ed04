"""Social mobilization table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import SOCIAL, FormSpec
from fieldtally.forms.social import MOBILIZATION, REFUSALS_ADDRESSED, RUMOURS
from fieldtally.functions import fixed_width, resolve_other, typed
from fieldtally.operators.lookup import admin_lookup
from fieldtally.operators.publish import bi_projection
from fieldtally.operators.repeat import is_parsed, parse_repeat, repeat_field
from fieldtally.plans.dims import Dimensions

COLUMNS = (
    "id", "assessment_date", "admin1", "admin2", "admin3", "admin4", "conducted_by", "indicators_category",
    "indicators_value", "vaccine_administered", "iso2_code", "submitted_at", "modified_at", "enumerator",
)


def indicators(form: DataFrame, dims: Dimensions, fanout: bool = True, spec: FormSpec = SOCIAL) -> DataFrame:
    """Submission × indicator (rumours, mobilization activities, one per refusal row).

    Each indicator row appears once per refusal row of its submission, beside that row's vaccine, and
    once with a NULL vaccine where there is none; a submission with n refusal rows has
    (9 + n) × max(n, 1) rows. ``fanout=False`` keeps one row per indicator and no vaccine. Both
    expansions happen inside the submission, whose repeat group the form bounds.
    """
    repeat = spec.repeat
    base = form.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("assessment_date").cast("date").alias("assessment_date"),
        *[f"admin{i}" for i in range(1, spec.levels + 1)],
        resolve_other("conducted_by", "conducted_by_other").alias("conducted_by"),
        "submitted_at", "modified_at", "enumerator",
        *[c for _, c in RUMOURS + MOBILIZATION],
        parse_repeat("refusals", repeat.path, ("vaccine_label", "refusals_addressed"), repeat.on_error,
                     is_parsed(form, "refusals")).alias("_refusals"),
    )
    named = admin_lookup(base, dims.areas, spec.levels, iso=dims.iso, spread_by=["id"])

    def cell(label: str, value: Column) -> Column:
        return F.struct(F.lit(label).alias("indicators_category"), typed(value, "bigint", repeat.on_error).alias("indicators_value"))

    counted = F.array(*[cell(label, F.col(c)) for label, c in RUMOURS + MOBILIZATION])
    addressed = F.transform(
        "_refusals", lambda r: cell(REFUSALS_ADDRESSED, repeat_field(r, repeat.path, "refusals_addressed"))
    )
    keys = [c for c in named.columns if c not in {v for _, v in RUMOURS + MOBILIZATION}]
    cells = F.when(F.col("_refusals").isNull(), counted).otherwise(F.concat(counted, addressed))
    rows = named.select(*keys, F.inline(cells))
    if fanout:
        rows = rows.withColumn("_refusal", F.explode_outer("_refusals"))
        vaccine = repeat_field(F.col("_refusal"), repeat.path, "vaccine_label")
    else:
        vaccine = F.lit(None).cast("string")
    return rows.withColumns(
        {"vaccine_administered": vaccine, "iso2_code": fixed_width("iso2_code", 50)}
    ).select(*COLUMNS)


def public_indicators(staged: DataFrame) -> DataFrame:
    return bi_projection(staged, COLUMNS, ("submitted_at", "modified_at"))
