import itertools
from fractions import Fraction

from pyspark.sql import functions as F

from conftest import rows
from fieldtally.functions import (
    count_where, days_between, fixed_width, half_even_percent, option_tokens, resolve_other, score_band,
    sum_of_cells, sum_where, typed, whole_number,
)
from fieldtally.operators.aggregate import category_proportion, monitoring_score, readiness_score
import pytest


def test_half_even_percent(spark):
    frame = spark.range(9).select("id", half_even_percent(F.col("id") / 8 * 100).alias("p"))
    assert [p for _, p in rows(frame)] == [0, 12, 25, 38, 50, 62, 75, 88, 100]


def test_score_band_leaves_gaps(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0, 49.9, 50.0, 99.0, 99.5, 100.0, 100.5, -1.0, None)], "p double")
    found = {r.p: r.b for r in frame.select("p", score_band("p").alias("b")).collect()}
    assert found == {0.0: "<50%", 49.9: "<50%", 50.0: "50-99%", 99.0: "50-99%", 99.5: None, 100.0: "100%",
                     100.5: None, -1.0: None, None: None}


def test_filtered_sum_is_null_and_filtered_count_zero(spark):
    frame = spark.createDataFrame([("a", 1)], "c string, v long").agg(
        sum_where("v", F.col("c") == "b").alias("s"), count_where("v", F.col("c") == "b").alias("n"))
    assert rows(frame) == [(None, 0)]


def test_sum_of_cells(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a long, b long")
    assert rows(frame, sum_of_cells("a", "b")) == [(1,), (5,), (None,)]


def test_whole_number(spark):
    frame = spark.createDataFrame([("5",), ("5.0",), ("2.5",), (None,)], "t string")
    assert rows(frame, whole_number("t")) == [(3,), (5,), (5,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("many",)], "t string").select(whole_number("t")).collect()


def test_option_tokens(spark):
    frame = spark.createDataFrame([('["mr" "opv"]',), ("mr",), ("",), ("[]",), (None,)], "t string")
    assert rows(frame, F.concat_ws("|", option_tokens("t"))) == [("",), ("",), ("",), ("mr",), ("mr|opv",)]
    assert frame.select(F.explode(option_tokens("t"))).count() == 3


def test_text_helpers(spark):
    frame = spark.createDataFrame([("others", "a b"), ("x", "c"), (None, "d")], "a string, o string")
    assert rows(frame, resolve_other("a", "o")) == [("a b",), ("x",), (None,)]
    assert rows(spark.sql("select repeat('é', 60) as t"), F.length(fixed_width("t", 50))) == [(50,)]


def test_end_day_is_not_counted(spark):
    frame = spark.sql("select date'2024-01-01' as s, date'2024-01-05' as e")
    assert rows(frame, days_between("e", "s")) == [(4,)]
    assert frame.select(days_between("e", "s").alias("d")).schema["d"].dataType.simpleString() == "int"


def test_scores_of_repeated_and_partial_categories(spark):
    answers = spark.createDataFrame(
        [(1, "c1", 2, "Yes"), (1, "c1", 2, "Yes"), (1, "c2", 1, "Yes"), (1, "c2", 1, "Yes"), (1, "c3", 1, "yes"),
         (2, "c1", 2, "Yes"), (2, None, None, "Yes")],
        "id long, indicators_category string, no_of_questions int, indicators_value string")
    shares = category_proportion(answers, ["id"])
    assert rows(shares, "id", "indicators_category", "yes_category_proportion") == [
        (1, "c1", 1.0), (1, "c2", 2.0), (1, "c3", 0.0), (2, "c1", 0.5), (2, None, None)]
    ready = rows(readiness_score(shares, ["id"], categories=3),
                 "id", F.col("readiness_value").cast("double"), "facility_ready", "category_value", "category_label")
    # The doubled category lifts the sum to 3 and the flag to Yes, yet only one category is complete.
    assert ready == [(1, 3.0, "Yes", 33, "<50%"), (2, 0.5, "No", 0, "<50%")]
    seen = rows(monitoring_score(shares, ["id"]), "id", F.round("overall_facility_proportion", 3), "overall_proportion_category")
    assert seen == [(1, 33.333, "<50%"), (2, 0.0, "<50%")]


def test_category_without_questions_raises(spark):
    answers = spark.createDataFrame([(1, "c", 0, "Yes")],
                                    "id long, indicators_category string, no_of_questions int, indicators_value string")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        category_proportion(answers, ["id"]).collect()


def test_readiness_is_exact_in_any_order(spark):
    """Categories of 3, 7, 9 and 11 questions whose shares are above and below one and add up to exactly 4."""
    sizes = {"a": (3, 4), "b": (7, 5), "c": (9, 11), "d": (21, 15), "e": (9, 4)}  # 4/3 + 5/7 + 11/9 + 15/21 + 4/9
    total = sum(Fraction(yes, size) for size, yes in sizes.values())
    sizes["f"] = ((4 - total) * total.denominator).denominator * total.denominator, int((4 - total) * total.denominator)
    assert sum(Fraction(yes, size) for size, yes in sizes.values()) == 4
    for order in itertools.islice(itertools.permutations(sizes), 0, 720, 90):
        rows_ = [(1, c, sizes[c][0], sizes[c][1], sizes[c][1] / sizes[c][0]) for c in order] + [(1, None, None, 1, None)]
        frame = spark.createDataFrame(
            rows_, "id long, indicators_category string, no_of_questions int, yes_count long, yes_category_proportion double")
        assert rows(readiness_score(frame.coalesce(1), ["id"], categories=4), "readiness_value", "facility_ready") == [(4.0, "Yes")]
    third = frame.where("indicators_category = 'a'")
    assert rows(readiness_score(third, ["id"]), "readiness_value", "facility_ready") == [(4 / 3, "No")]
    none = frame.where("indicators_category is null")
    assert rows(readiness_score(none, ["id"]), "readiness_value", "facility_ready") == [(None, "No")]


def test_lenient_numbers(spark):
    frame = spark.createDataFrame([("5",), ("5.0",), ("many",)], "t string")
    assert rows(frame, typed("t", "bigint", "null")) == [(5,), (None,), (None,)]
    assert rows(frame, whole_number("t", "null")) == [(5,), (5,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.select(typed("t", "bigint")).collect()
