"""Dimension lookups. All keep unmatched rows with NULL labels and compare codes as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.join import fits_broadcast, sized_join


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
           size_of: Sequence[DataFrame] | None = None, **join_options) -> DataFrame:
    """Left join to a dimension: ``on`` maps fact to dimension columns, ``take`` dimension to output columns."""
    kinds = dict(df.dtypes)
    prefix = "_" + next(iter(take.values()))
    side_keys = [f"{prefix}_code{i}" for i in range(len(on))]
    fact_keys = [fact if kinds[fact] == "string" else f"{prefix}_text{i}" for i, fact in enumerate(on)]
    for fact, text in zip(on, fact_keys):
        if text != fact:
            df = df.withColumn(text, F.col(fact).cast("string"))
            join_options.pop("counted", None)
    side = dim.select(
        *[F.col(key).cast("string").alias(tmp) for tmp, key in zip(side_keys, on.values())],
        *[F.col(c).alias(out) for c, out in take.items()],
    )
    joined = sized_join(df, side, list(zip(fact_keys, side_keys)), "left", size_of=size_of or [dim], **join_options)
    return joined.drop(*side_keys, *[text for text in fact_keys if text not in on])


def admin_lookup(df: DataFrame, areas: Mapping[int, DataFrame], levels: int | Sequence[int] = 5,
                 iso: DataFrame | None = None, keep_codes: bool = False, **join_options) -> DataFrame:
    """Area labels for code columns ``admin1`` .. ``adminN``, replacing the codes.

    With ``iso`` the province's ISO code comes along with the second level: it hangs on the resolved
    area, so it is joined to that small dimension once instead of to every fact row. ``keep_codes``
    retains the code columns as ``adminN_code``.
    """
    wanted = range(1, levels + 1) if isinstance(levels, int) else levels
    base = out = df.withColumnsRenamed({f"admin{level}": f"admin{level}_code" for level in wanted})
    for level in wanted:
        dim = areas[level]
        take = {"label": f"admin{level}"}
        parts = [dim]
        if level == 2 and iso is not None:
            dim = lookup(dim, iso, {"name": "admin2_id"}, {"iso2_code": "iso2_code"})
            take["iso2_code"] = "iso2_code"
            parts.append(iso)
        out = lookup(out, dim, {f"admin{level}_code": "name"}, take, counted=base, size_of=parts, **join_options)
    return out if keep_codes else out.drop(*[f"admin{level}_code" for level in wanted])


def areas_fit(areas: Mapping[int, DataFrame], levels: int = 5) -> bool:
    """Whether every area table is small enough to be broadcast."""
    return all(fits_broadcast(areas[level]) for level in range(1, levels + 1))


def choice_lookup(df: DataFrame, labels: DataFrame, question: str, code_col: str, out: str) -> DataFrame:
    """Label of the chosen option of one question."""
    return lookup(df, labels.where(F.col("question") == question), {code_col: "code"}, {"label": out})


def indicator_lookup(df: DataFrame, indicators: DataFrame, form: str, counts: DataFrame | None = None,
                     name_col: str = "indicator_name") -> DataFrame:
    """Label and category of a question from one form's entries in the indicator dictionary.

    With ``counts`` the category's number of questions comes along: it hangs on the dictionary's
    category, so the two small tables are joined first and the facts are probed once.
    """
    entries = indicators.where(F.col("form_name") == form).select("indicator_name", "indicator_label", "category")
    take = {"indicator_label": "indicators_label", "category": "indicators_category"}
    parts = [indicators]
    if counts is not None:
        entries = question_count_lookup(entries, counts, "category")
        take["no_of_questions"] = "no_of_questions"
        parts.append(counts)
    return lookup(df, entries, {name_col: "indicator_name"}, take, size_of=parts)


def question_count_lookup(df: DataFrame, counts: DataFrame, category_col: str = "indicators_category") -> DataFrame:
    """Number of questions of a row's category."""
    return lookup(df, counts, {category_col: "indicators_category"}, {"no_of_questions": "no_of_questions"})


def iso_lookup(df: DataFrame, iso: DataFrame, key_col: str, on: str = "admin2_id", out: str = "iso2_code",
               **join_options) -> DataFrame:
    """Province ISO code by area code (``on='admin2_id'``) or by label (``on='province_label'``)."""
    return lookup(df, iso, {key_col: on}, {"iso2_code": out}, **join_options)


def require_label(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose lookup resolved."""
    return df.where(F.col(column).isNotNull())


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``dim`` unchanged, or raise if a key occurs twice and would multiply facts."""
    doubled = dim.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if doubled:
        raise ValueError(f"duplicate dimension keys: {[tuple(r[k] for k in keys) for r in doubled]}")
    return dim
