"""Readiness, rapid coverage, social mobilization and monitoring on hand-written submissions."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.forms import MONITORING, RAPID_COVERAGE, READINESS, SOCIAL
from fieldtally.forms.monitoring import DICTIONARY_NAME as MONITORING_NAME
from fieldtally.forms.monitoring import TEAM_QUESTIONS
from fieldtally.forms.readiness import DICTIONARY_NAME as READINESS_NAME
from fieldtally.operators.ingest import clean_form
from fieldtally.plans import monitoring, rapid_coverage, readiness, social
from landed import NORTH, SOUTH, STAMP, day, dimensions, form, group, places, table

# ---------------------------------------------------------------- readiness

SIZES = {"microplan": 9, "logistics": 7, "social_mob": 3, "imm_safety": 2, "supervision": 5, "reporting": 3,
         "vacc_mngt": 3, "hr": 1}
GROUPS = dict(zip(SIZES, READINESS.groups))


def assessed(number, place, when, categories, **more):
    """A submission that answers all questions of the listed categories with yes."""
    answers = {f"{GROUPS[c]}_{c}_indicator{i}": "Yes" for c in categories for i in range(1, SIZES[c] + 1)}
    return {"_id": str(number), "_submission_time": STAMP, "assessment_details_assessment_date": when,
            **places("geographical_location", *place), **answers, **more}


@pytest.fixture(scope="module")
def readiness_dims(spark):
    entries = [(READINESS_NAME, f"{c}_indicator{i}", f" {c} {i} ", c) for c, n in SIZES.items() for i in range(1, n + 1)]
    return dimensions(
        spark, indicators=entries + [("other", "hr_indicator1", "wrong", "wrong")],
        readiness_questions=list(SIZES.items()),
        admin5=[(n, f"place {n}") for n in range(1, 20)])


def place(code):
    return (1, 11, 111, 1111, code)


def test_readiness_scores(spark, readiness_dims):
    names = list(SIZES)
    landed = [assessed(n, place(n), "2024-01-01", names[:n]) for n in (1, 3, 5, 7, 8)]
    # Facility 9: two complete assessments, so every proportion is 2.
    landed += [assessed(90, place(9), "2024-01-01", names), assessed(91, place(9), "2024-01-05", names)]
    # Facility 10: nothing answered; facility 11: 'yes' in another spelling.
    landed += [assessed(100, place(10), "2024-01-01", []),
               assessed(110, place(11), "2024-01-01", [], human_resource_hr_indicator1="yes")]
    clean = clean_form(form(spark, READINESS, landed), READINESS)
    scores = readiness.ready_facilities(clean, readiness_dims)
    assert rows(scores, "admin5", F.col("readiness_value").cast("double"), "facility_ready", "category_value",
                "category_label") == [
        ("place 1", 1.0, "No", 12, "<50%"), ("place 10", 0.0, "No", 0, "<50%"), ("place 11", 0.0, "No", 0, "<50%"),
        ("place 3", 3.0, "No", 38, "<50%"), ("place 5", 5.0, "No", 62, "50-99%"), ("place 7", 7.0, "No", 88, "50-99%"),
        ("place 8", 8.0, "Yes", 100, "100%"), ("place 9", 16.0, "No", 0, "<50%")]
    latest = readiness.ready_facilities(clean, readiness_dims, latest_only=True)
    assert rows(latest.where("admin5 = 'place 9'"), "facility_ready", "category_value") == [("Yes", 100)]


def test_latest_assessment_marks(spark, readiness_dims):
    landed = [
        assessed(1, place(1), "2024-01-01", []), assessed(2, place(1), "2024-02-01", []),
        assessed(3, place(1), "2024-02-01", []),  # a tie: both are latest
        assessed(4, place(None), "2024-03-01", []),  # no facility
        assessed(5, place(2), None, []),  # no date
    ]
    long = readiness.assessment(clean_form(form(spark, READINESS, landed), READINESS), readiness_dims)
    assert rows(long.select("id", "assessment_date").distinct()) == [
        (1, None), (2, "2024-02-01"), (3, "2024-02-01"), (4, None), (5, None)]
    assert long.count() == 5 * 34


def test_readiness_question_table(spark, readiness_dims):
    landed = [assessed(1, place(1), "2024-01-01", ["hr"], human_resource_hr_indicator2_remarks="second",
                       vaccine_management_vacc_mngt_indicator4_remarks="fridge")]
    clean = clean_form(form(spark, READINESS, landed), READINESS)
    answers = readiness.question_answers(clean, readiness_dims)
    assert rows(answers.where("indicators_value is not null"), "indicators_value", "indicators_remarks",
                "indicators_label", "indicators_category") == [
        # The one human-resource question carries the second indicator's remark; the fourth
        # vaccine-management answer is its own remark and not in the dictionary.
        ("Yes", "second", " hr 1 ", "hr"), ("fridge", "fridge", None, None)]
    long = readiness.public_assessment(readiness.assessment(clean, readiness_dims))
    assert rows(long.where("indicators_category = 'hr'"), "indicators_label", "no_of_questions", "vaccine_label",
                "submitted_at") == [("hr 1", 1, None, "2024-05-01")]


def test_duplicate_dimension_key_multiplies_and_is_reported(spark):
    from fieldtally.operators.lookup import admin_lookup, assert_unique

    dims = dimensions(spark, admin1=[(1, "North"), (1, "Again")])
    facts = table(spark, "id admin1", (1, "1"))
    assert admin_lookup(facts, dims.areas, levels=1).count() == 2
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique(dims.areas[1], ["name"])
    assert assert_unique(dims.areas[2], ["name"]) is dims.areas[2]


# ---------------------------------------------------------------- rapid coverage

@pytest.fixture(scope="module")
def coverage(spark):
    repeat = group(
        RAPID_COVERAGE,
        {"age_group_label": "0-4", "not_vaccinated_males": "2", "not_vaccinated_females": 3, "present_males": 6,
         "unvaccinated/reason_10": "4", "unvaccinated/other_reasons": 1},
        {"age_group_label": "5-9", "not_vaccinated_males": None, "vaccinated_females": 8})

    def checked(number, place, json, **more):
        return {"_id": str(number), "_airbyte_raw_id": f"c{number}", "_submission_time": STAMP, "_date_modified": STAMP,
                **places("geographical_location", *place), "assessment_details_rca_date": "2024-03-01",
                "immunization_coverage_vaccine_administered": "mr", "immunization_coverage_doors_visited": 9,
                "immunization_coverage_vaccination": json, **more}

    return clean_form(form(spark, RAPID_COVERAGE, [
        checked(1, NORTH, repeat, sources_radio=3, sources_health_workers="2", assessment_details_conducted_by="moh",
                rca_mop_up="Yes"),
        checked(2, SOUTH, "[]"),
        checked(3, SOUTH, None, immunization_coverage_vaccine_administered="unlisted"),
        checked(4, NORTH, group(RAPID_COVERAGE, {"age_group_label": "0-4"})),
    ]), RAPID_COVERAGE)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, "question code label", ("vaccine_administered", "mr", "Measles"),
                 ("conducted_by", "moh", "Ministry"), ("conducted_by", "mr", "Wrong question"))


def test_rapid_coverage(spark, coverage, labels):
    dims = dimensions(spark)
    children = rapid_coverage.children(coverage, dims, labels)
    assert children.count() == 18
    assert rows(children.where("indicator_value is not null"), "submission_id", "age_group_label", "rca_category",
                "indicator_category", "indicator_value", "iso2_code") == [
        (1, "0-4", "Not vaccinated", "Females", 3, "X-HIL"), (1, "0-4", "Not vaccinated", "Males", 2, "X-HIL"),
        (1, "0-4", "Present in hh", "Males", 6, "X-HIL"), (1, "5-9", "Vaccinated", "Females", 8, "X-HIL")]
    submissions = rapid_coverage.submissions(coverage, dims, labels)
    assert rows(submissions, "submission_id", "vaccine_administered", "conducted_by", "doors_visited", "rca_mop_up",
                "total_not_vaccinated", "iso2_code") == [
        (1, "Measles", "Ministry", 9, "Yes", 5, "X-HIL"), (2, "Measles", None, 9, None, None, None),
        (3, None, None, 9, None, None, None), (4, "Measles", None, 9, None, None, "X-HIL")]
    assert rows(rapid_coverage.information_sources(coverage, dims, labels), "submission_id", "sources_info", "no_doors") == [
        (1, "Health workers", 2), (1, "Radio", 3)]
    reasons = rapid_coverage.not_vaccinated_reasons(coverage, dims, labels)
    assert rows(reasons, "submission_id", "rca_date", "reasons", "reasons_value") == [
        ("1", "2024-03-01", "Other", 1), ("1", "2024-03-01", "Reason 10", 4)]


# ---------------------------------------------------------------- social mobilization

def test_social_fan_out(spark):
    def reported(number, refusals, **more):
        return {"_id": str(number), "_submission_time": STAMP, "assessment_details_assessment_date": "2024-03-01",
                **places("geographical_location", 1, 11, 111, 1111), "soc_mob_indicators_hhs_visited": "12",
                "soc_mob_indicators_refusals": refusals, **more}

    def refusal(vaccine, n):
        return {"vaccine_label": vaccine, "refusals_addressed": n}

    clean = clean_form(form(spark, SOCIAL, [
        reported(1, None, assessment_details_conducted_by="others", assessment_details_conducted_by_other="club"),
        reported(2, group(SOCIAL, refusal("mr", "3")), assessment_details_conducted_by="moh"),
        reported(3, group(SOCIAL, refusal("mr", "1"), refusal("opv", 2), refusal(None, None))),
    ]), SOCIAL)
    found = social.indicators(clean, dimensions(spark))
    assert rows(found.groupBy("id").count()) == [(1, 9), (2, 10), (3, 36)]
    assert rows(found.select("id", "conducted_by").distinct()) == [(1, "club"), (2, "moh"), (3, None)]
    visited = found.where("indicators_category = 'Households visited'")
    assert rows(visited, "id", "indicators_value", "vaccine_administered") == [
        (1, 12, None), (2, 12, "mr"), (3, 12, "mr"), (3, 12, "opv"), (3, 12, None)]
    addressed = found.where("id = 3 and indicators_category = 'Refusals addressed'")
    assert addressed.count() == 9
    assert rows(addressed.agg(F.sum("indicators_value"))) == [(9,)]
    single = social.indicators(clean, dimensions(spark), fanout=False)
    assert rows(single.groupBy("id").count()) == [(1, 9), (2, 10), (3, 12)]
    assert single.where("vaccine_administered is not null").count() == 0
    assert dict(social.public_indicators(found).dtypes)["submitted_at"] == "date"


# ---------------------------------------------------------------- monitoring

def test_monitoring_scores(spark):
    part1 = {f"part1_part1_indicator{i}": "Yes" for i in range(1, 25)}
    part2 = {f"part2_part2_indicator{i}": "Yes" for i in range(1, 31)}
    team = {q.name: "Yes" for q in TEAM_QUESTIONS}

    def monitored(number, facility, answers, *teams):
        return {"_id": str(number), "_airbyte_raw_id": f"m{number}", **places("geographical_location", *NORTH[:4], facility),
                "campaign_activity_details_date_vaccination_activity": day("2024-03-01"),
                "immunization_coverage_vaccine_label": "mr", "immunization_coverage_hc_target": "40",
                "immunization_coverage_total_vaccinated_as_time_visit": 8,
                "part3_vaccination_team_info": group(MONITORING, *teams) if teams else None, **answers}

    clean = clean_form(form(spark, MONITORING, [
        monitored(1, 5001, {**part1, **part2}, team),
        monitored(2, 5001, {**part1, **part2}, team, team),  # two teams overshoot their category
        monitored(3, 5001, part1),
        monitored(4, 9999, {**part1, **part2}, team),  # facility not listed
        monitored(5, 5003, {}),  # nothing answered
        monitored(6, 5003, {"part2_part2_indicator28a": "7", "part2_part2_indicator28b": "seven"}),
    ]), MONITORING)
    names = [q.name for q in MONITORING.questions + TEAM_QUESTIONS]
    dims = dimensions(
        spark, indicators=[(MONITORING_NAME, n, f"label {n}", n[:5]) for n in names],
        monitoring_questions=[("part1", 24), ("part2", 30), ("part3", 18)])
    long = monitoring.monitoring_tool(clean, dims)
    assert rows(long.groupBy("id").count()) == [(1, 75), (2, 93), (3, 57), (5, 57), (6, 57)]
    assert rows(long.where("id = 6 and indicators_value is not null"), "indicators_value", "indicators_remarks",
                "indicators_label", "no_of_questions") == [("7", "seven", "label part2_indicator28a", 30)]
    scores = monitoring.facility_scores(clean, dims)
    assert rows(scores, "id", F.round("overall_facility_proportion", 4), "overall_proportion_category") == [
        (1, 100.0, "100%"), (2, 66.6667, "50-99%"), (3, 33.3333, "<50%"), (6, 0.0, "<50%")]
    assert monitoring.visit_questions(clean, dims).count() == 6 * 57
    assert rows(monitoring.team_questions(clean, dims).groupBy("parent_id").count()) == [(1, 18), (2, 36), (4, 18)]
    children = monitoring.vaccinated_children(clean, dims)
    assert rows(children, "id", "admin5", "total_vaccinated_as_time_visit", "hc_target", "iso2_code")[3] == (
        4, None, 8, 40, "X-HIL")
