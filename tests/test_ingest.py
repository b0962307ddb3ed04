"""Sources, clean forms and repeat groups."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.forms import ACTIVITY, FORMS, MONITORING, READINESS, SOCIAL, Question
from fieldtally.operators.ingest import apply_types, clean_form, clean_name, strip_group_prefix
from fieldtally.operators.repeat import explode_group, explode_repeat, explode_select_multiple
from fieldtally.operators.reshape import unpivot_crosstab, unpivot_pairs, unpivot_questions
from fieldtally.sources import date_spine, read_choice_labels, read_dim, read_form, spine_between
from landed import form, group


def test_forms_have_all_columns():
    sizes = {name: len(spec.clean_columns()) for name, spec in FORMS.items()}
    # The activity form keeps its raw id, which its repeat rows are matched on.
    assert sizes == {"readiness": 117, "rapid_coverage": 68, "activity": 52, "target": 48, "social": 56, "monitoring": 169}
    repeats = {name: len(spec.repeat.fields) for name, spec in FORMS.items() if spec.repeat}
    assert repeats == {"rapid_coverage": 30, "activity": 49, "target": 4, "social": 4, "monitoring": 42}
    for spec in FORMS.values():
        clean = [c for _, c, _ in spec.clean_columns()]
        assert len(clean) == len(set(clean))
        assert set(spec.types) <= set(clean)
        assert set(spec.landed_types) <= set(spec.landed_columns())
    assert len(READINESS.questions) == 34 and len(MONITORING.questions) == 57


def test_clean_name():
    groups = ["part1", "part2", "rca", "part2_extra"]
    assert clean_name("part2_part2_indicator14_remarks", groups) == "part2_indicator14_remarks"
    assert clean_name("part2_extra_x", groups) == "x"
    assert clean_name("_id", groups) == "id"
    assert clean_name("device_id", groups) == "device_id"
    assert clean_name("rca_mop_up", groups, {"rca_mop_up": "rca_mop_up"}) == "rca_mop_up"


@pytest.mark.parametrize("spec", [s for s in FORMS.values()], ids=lambda s: s.name)
def test_prefix_rule_agrees_with_spec(spark, spec):
    """Stripping by rule gives the names the spec declares, extra copies aside."""
    empty = form(spark, spec, [{}])
    stripped = strip_group_prefix(empty, spec.groups)
    assert stripped.columns == [c for landed, c, _ in spec.clean_columns() if c not in spec.copies]


def test_customised_form(spark):
    """A country adds a question to a group and unpivots it; no operator changes."""
    groups = {**READINESS.groups, "microplan": READINESS.groups["microplan"] + ("microplan_extra", "microplan_extra_note")}
    spec = dataclasses.replace(READINESS, groups=groups, questions=(
        *READINESS.questions, Question("microplan_extra", "microplan_extra", "microplan_extra_note")))
    clean = clean_form(form(spark, spec, [{"_id": "1", "microplan_microplan_extra": "Yes"}]), spec)
    long = unpivot_questions(clean, ["id"], spec.questions)
    assert long.count() == 35
    assert rows(long.where("indicators_value = 'Yes'"), "id", "indicator_name") == [("1", "microplan_extra")]


def test_malformed_text(spark):
    frame = spark.createDataFrame([("5", "x"), (" 7 ", "y")], "n string, t string")
    assert rows(apply_types(frame, {"n": "bigint"})) == [(5, "x"), (7, "y")]
    for text in ("", "5.0", "many"):
        bad = spark.createDataFrame([(text, "x")], "n string, t string")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            apply_types(bad, {"n": "bigint"}).collect()
        assert rows(apply_types(bad, {"n": "bigint"}, on_error="null")) == [(None, "x")]


def test_only_used_columns_are_read(spark, tmp_path):
    form(spark, MONITORING, [{"_id": "1"}]).write.parquet(str(tmp_path / "m"))
    clean = clean_form(read_form(spark, MONITORING, str(tmp_path / "m")), MONITORING)
    plan = clean.where("id = '1'").select("id", "hc_target")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<immunization_coverage_hc_target:string,_id:string>" in plan
    assert "EqualTo(_id,1)" in plan


def test_repeat_rows(spark):
    landed = form(spark, SOCIAL, [
        {"_id": "1", "soc_mob_indicators_refusals": group(SOCIAL, {"pos": 1, "vaccine_label": "mr"}, {"pos": 2, "vaccine_label": None})},
        {"_id": "2", "soc_mob_indicators_refusals": "[]"}, {"_id": "3"},
        {"_id": "4", "soc_mob_indicators_refusals": group(SOCIAL, {"pos": "1"})},
    ])
    found = explode_group(landed, SOCIAL.repeat, ["_id"], only=("pos", "vaccine_label"))
    assert rows(found) == [("1", "1", "mr"), ("1", "2", None), ("4", "1", None)]
    outer = explode_group(landed, SOCIAL.repeat, ["_id"], only=("pos",), outer=True)
    assert rows(outer) == [("1", "1"), ("1", "2"), ("2", None), ("3", None), ("4", "1")]
    broken = spark.createDataFrame([("1", "[{oops")], "_id string, j string")
    assert rows(explode_repeat(broken, "j", "a/b", {"c": "string"}, ["_id"], on_error="null")) in ([], [("1", None)])


def test_in_place_explode_equals_join_on_raw_id(spark):
    landed = form(spark, ACTIVITY, [
        {"_id": str(i), "_airbyte_raw_id": f"r{i}", "immunization_coverage_vaccine":
         group(ACTIVITY, *[{"pos": str(p), "coverage/vaccinated_males": i * p} for p in range(i % 3)])} for i in range(9)])
    in_place = explode_group(landed, ACTIVITY.repeat, ["_id"], only=("pos", "vaccinated_males"))
    child = explode_group(landed, ACTIVITY.repeat, ["_airbyte_raw_id"], only=("pos", "vaccinated_males"))
    joined = child.join(landed.select("_id", "_airbyte_raw_id"), "_airbyte_raw_id", "left")
    assert rows(in_place, "_id", "pos", "vaccinated_males") == rows(joined, "_id", "pos", "vaccinated_males")


def test_unpivot_keeps_totals(spark):
    wide = spark.range(50).selectExpr("id", "id % 7 as a", "if(id % 3 = 0, null, id) as b")
    long = unpivot_pairs(wide, ["id"], [("it's a", "a"), ("b", "b")], "name", "value", cast="bigint")
    assert long.count() == 100
    assert {r.name: r.total for r in long.groupBy("name").agg(F.sum("value").alias("total")).collect()} == {
        "it's a": wide.agg(F.sum("a")).first()[0], "b": wide.agg(F.sum("b")).first()[0]}
    cells = unpivot_crosstab(wide, ["id"], [("x", "y", "a"), ("x", "z", "b")], ("p", "q", "n"))
    assert cells.columns == ["id", "p", "q", "n"] and cells.count() == 100


def test_select_multiple(spark):
    frame = spark.createDataFrame([(1, '["mr" "opv"]'), (2, ""), (3, None), (4, "mr")], "id long, v string")
    assert rows(explode_select_multiple(frame, "v", ["id"])) == [(1, "mr"), (1, "opv"), (4, "mr")]


def test_calendar(spark):
    spine = date_spine(spark, "2022-12-01", "2025-08-25")
    assert spine.count() == 999
    facts = spark.sql("select explode(array(date'2024-01-01', date'2024-01-03', null)) as d")
    assert rows(spine_between(facts, "d")) == [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]
    assert date_spine(spark, "2022-12-01").where("date > current_date()").count() == 0


def test_uploaded_dimensions(spark, tmp_path):
    path = tmp_path / "admin2.csv"
    path.write_text("name,label\n11,Hill\n21,\"Shore, East\"\n")
    assert rows(read_dim(spark, "admin2", str(path))) == [("11", "Hill"), ("21", "Shore, East")]
    (tmp_path / "counts.csv").write_text("indicators_category,no_of_questions\nmicroplan,9\n")
    assert rows(read_dim(spark, "question_counts", str(tmp_path / "counts.csv"))) == [("microplan", 9)]


def test_landed_json_and_choices(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"_id": "1", "soc_mob_indicators_hhs_visited": "4"}\n{"_id": "2", "extra": 1}\n')
    found = clean_form(read_form(spark, SOCIAL, str(tmp_path / "f.json"), format="json"), SOCIAL)
    assert rows(found, "id", "hhs_visited") == [("1", "4"), ("2", None)]
    spark.createDataFrame([("q", "a", "A")], "field string, value string, label string").createOrReplaceTempView("choices")
    assert read_choice_labels(spark, "choices").columns == ["question", "code", "label"]


def test_building_a_frame_starts_no_job(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) as `_id`").write.parquet(str(tmp_path / "form"))
    spark.range(10).selectExpr("cast(id % 3 as string) as `_id`").groupBy("_id").count().createOrReplaceTempView("grouped")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    frame = clean_form(read_form(spark, SOCIAL, str(tmp_path / "form")), SOCIAL)
    spark.table("grouped").select("_id")
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert frame.count() == 100
