"""Grouped totals and readiness or monitoring scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions import complete_share, count_where, half_even_percent, is_yes, score_band, sum_where


def sums(df: DataFrame, keys: Sequence[str], values: Mapping[str, str | Column]) -> DataFrame:
    """Grouped sums: ``values`` maps output name to column."""
    return df.groupBy(*keys).agg(*[F.sum(v).alias(out) for out, v in values.items()])


def pivot_sums(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, Sequence[str]], category: str,
               value: str) -> DataFrame:
    """One filtered sum per output column, side by side: ``outputs`` maps name to the categories it adds up."""
    return df.groupBy(*keys).agg(
        *[sum_where(value, F.col(category).isin(*cats)).alias(out) for out, cats in outputs.items()]
    )


def category_proportion(df: DataFrame, keys: Sequence[str], answer: str = "indicators_value",
                        category: str = "indicators_category", questions: str = "no_of_questions",
                        counted: str = "id") -> DataFrame:
    """Yes answers, and their share of the category's questions, per group and category."""
    counts = df.groupBy(*keys, category, questions).agg(count_where(counted, is_yes(answer)).alias("yes_count"))
    return with_proportion(counts, questions)


def with_proportion(counts: DataFrame, questions: str = "no_of_questions") -> DataFrame:
    return counts.withColumn(
        "yes_category_proportion", F.col("yes_count").cast("double") / F.col(questions).cast("double")
    )


def readiness_score(proportions: DataFrame, keys: Sequence[str], categories: int = 8,
                    proportion: str = "yes_category_proportion", yes: str = "yes_count",
                    questions: str = "no_of_questions") -> DataFrame:
    """Sum of proportions, ready flag, share of complete categories and its band per group.

    Proportions are added as fractions over the product of the group's category sizes, so neither the
    value nor the flag depends on the order of addition. A group has one row a category.
    """
    fraction = F.when(F.col(proportion).isNotNull(), F.struct(
        F.col(yes).cast("decimal(38,0)").alias("yes"), F.col(questions).cast("decimal(38,0)").alias("size")))
    whole = F.lit(1).cast("decimal(38,0)")

    def common(sizes: Column) -> Column:
        return F.aggregate(sizes, whole, lambda product, size: (product * size).cast("decimal(38,0)"))

    scored = proportions.groupBy(*keys).agg(
        F.collect_list(fraction).alias("_parts"),
        half_even_percent(complete_share(proportion, categories)).alias("category_value"),
    ).withColumn("_whole", common(F.array_distinct(F.col("_parts.size"))))
    scored = scored.withColumn("_total", F.when(F.size("_parts") > 0, F.aggregate(
        "_parts", F.lit(0).cast("decimal(38,0)"),
        lambda total, part: (total + part["yes"] * F.floor(F.col("_whole") / part["size"])).cast("decimal(38,0)"))))
    return scored.select(
        *keys,
        (F.col("_total").cast("double") / F.col("_whole").cast("double")).alias("readiness_value"),
        F.when(F.col("_total") == F.col("_whole") * categories, "Yes").otherwise("No").alias("facility_ready"),
        "category_value",
        score_band("category_value").alias("category_label"),
    )


def monitoring_score(proportions: DataFrame, keys: Sequence[str], categories: int = 3,
                     proportion: str = "yes_category_proportion") -> DataFrame:
    """Unrounded percent of complete categories and its band per group."""
    scored = proportions.groupBy(*keys).agg(
        complete_share(proportion, categories).alias("overall_facility_proportion")
    )
    return scored.withColumn("overall_proportion_category", score_band("overall_facility_proportion"))
