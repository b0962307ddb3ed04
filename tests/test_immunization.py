"""Activity, targets and doses on hand-written submissions."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldtally.forms import ACTIVITY, TARGET
from fieldtally.operators.aggregate import pivot_sums
from fieldtally.operators.ingest import clean_form
from fieldtally.plans import immunization as im
from fieldtally.sources import date_spine
from landed import NORTH, SOUTH, STAMP, day, dimensions, form, group, places


def visit(number, place, when, vaccine, children, used=None, dosage=None, discarded=None):
    return {
        "_id": str(number), "_airbyte_raw_id": f"r{number}", "_submission_time": STAMP, "_date_modified": STAMP,
        **places("geographic_location", *place),
        "geographic_location_admin4_lat": 1.5, "geographic_location_admin4_long": 2.5,
        "campaign_activity_details_date_vaccination_activity": day(when),
        "campaign_activity_details_enumerator": "ann",
        "immunization_coverage_vaccine_label": vaccine, "immunization_coverage_vaccine": children,
        "vaccine_logistics_vials_used": used, "vaccine_logistics_vial_dosage": dosage,
        "vaccine_logistics_vials_discarded": discarded,
    }


def age(label, **counts):
    where = {**{f"vaccinated_{s}": "coverage" for s in ("males", "females")},
             **{f"vaccinated_{s}_previously_{k}": "coverage" for s in ("males", "females") for k in ("deferred", "refused")}}
    return {"age_group_label": label, "pos": "1",
            **{f"{where.get(c, c.split('_')[0])}/{c}": v for c, v in counts.items()}}


def campaign(name, place, start, end, vaccine, children):
    return {
        "_id": name, "_airbyte_raw_id": name, **places("geographic_location", *place),
        "immunization_campaign_details_campaign_start_date": start,
        "immunization_campaign_details_campaign_end_date": end,
        "immunization_coverage_vaccine_label": vaccine, "immunization_coverage_target_children": children,
    }


@pytest.fixture(scope="module")
def activity(spark):
    return clean_form(form(spark, ACTIVITY, [
        # A number, a quoted number, a missing key and a JSON null in one submission.
        visit(1, NORTH, "2024-03-01", "mr", group(
            ACTIVITY,
            age("0-4", vaccinated_males=3, vaccinated_females="4", vaccinated_males_previously_refused="2", deferred_males=1),
            age("5-9", vaccinated_males=None, vaccinated_females=5, refused_females=6, deferred_reason_2=2, refused_other="3"),
        ), used=4, dosage=10, discarded=1),
        # The same facility label under another parent, same day and vaccine.
        visit(2, SOUTH, "2024-03-01", "mr", group(ACTIVITY, age("0-4", deferred_females=2)), used=2, dosage=5),
        # Facility not listed; repeat group NULL; repeat group empty.
        visit(3, (1, 11, 111, 1111, 9999), "2024-03-02", "mr", group(ACTIVITY, age("0-4", vaccinated_males=7))),
        visit(4, NORTH, "2024-03-03", "mr", None, used=1, dosage=10),
        visit(5, NORTH, "2024-03-03", "mr", "[]", dosage=20),
        # On the last campaign day, after it, and after the as-of day.
        visit(6, NORTH, "2024-03-10", "mr", group(ACTIVITY, age("0-4", vaccinated_males=1))),
        visit(7, NORTH, "2024-03-11", "mr", group(ACTIVITY, age("0-4", vaccinated_males=1))),
        visit(8, NORTH, "2024-04-01", "mr", group(ACTIVITY, age("0-4", vaccinated_males=1))),
    ]), ACTIVITY)


@pytest.fixture(scope="module")
def target(spark):
    return clean_form(form(spark, TARGET, [
        campaign("a", NORTH, "2024-03-01", "2024-03-10", "mr", group(
            TARGET, {"age_group_label": "0-4", "no_children": 100}, {"age_group_label": "5-9", "no_children": "50"})),
        # Overlaps the first on one day, for one age group; no count stated for it.
        campaign("b", NORTH, "2024-03-10", "2024-03-12", "mr", group(
            TARGET, {"age_group_label": "0-4", "no_children": None}, {"age_group_label": "5-9"})),
        # No age groups at all; unlisted facility.
        campaign("c", SOUTH, "2024-05-01", "2024-05-03", "opv", None),
        campaign("d", (1, 11, 111, 1111, 9999), "2024-03-01", "2024-03-09", "mr", group(
            TARGET, {"age_group_label": "0-4", "no_children": 9})),
    ]), TARGET)


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


@pytest.fixture(scope="module")
def spine(spark):
    return date_spine(spark, "2024-03-01", "2024-03-31")


def test_clean_form_keeps_local_time(activity):
    assert rows(activity.limit(1), "submitted_at") == [("2024-05-01T23:30:00",)]


def test_actuals(activity, dims):
    found = im.actuals(activity, dims)
    assert found.count() == 70
    one = found.where("submission_id = 1 and indicator_value is not null")
    assert rows(one, "age_group_label", "coverage_category", "indicator_category", "indicator_value") == [
        ("0-4", "Deferred", "Males", 1), ("0-4", "Refused Vaccinated", "Males", 2),
        ("0-4", "Vaccinated", "Females", 4), ("0-4", "Vaccinated", "Males", 3),
        ("5-9", "Refused", "Females", 6), ("5-9", "Vaccinated", "Females", 5)]
    assert rows(found.where("submission_id = 3").select("admin1", "admin5").distinct()) == [("North", None)]
    assert dict(found.dtypes)["latitude"] == "float" and dict(found.dtypes)["indicator_value"] == "bigint"


def test_reasons(activity, dims):
    assert rows(im.unreached_reasons(activity, dims), "submission_id", "age_group_label", "reason_category",
                "coverage_category", "reasons_value") == [
        (1, "5-9", "Other", "Refused", 3), (1, "5-9", "Reason 2", "Deferred", 2)]


def test_targets(target, dims):
    assert rows(im.targets(target, dims), "admin5", "campaign_start_date", "campaign_days", "campaign_target",
                "age_group_label") == [
        ("Clinic", "2024-03-01", 9, 100, "0-4"), ("Clinic", "2024-03-01", 9, 50, "5-9"),
        ("Clinic", "2024-03-10", 2, None, "0-4"), ("Clinic", "2024-03-10", 2, None, "5-9"),
        ("Clinic", "2024-05-01", 2, None, None), (None, "2024-03-01", 8, 9, "0-4")]


def test_doses(activity, dims):
    found = rows(im.doses(activity, dims).where("date_vaccination_activity < '2024-03-05'"),
                 "date_vaccination_activity", "admin1", "admin5", "vial_dosage", "vials_used", "vaccine_dose", "vials_discarded")
    assert found == [
        ("2024-03-01", "North", "Clinic", "10", 4, 40, 1), ("2024-03-01", "South", "Clinic", "5", 2, 10, None),
        ("2024-03-02", "North", None, None, None, None, None), ("2024-03-03", "North", "Clinic", "20", 1, 10, None)]


def daily(activity, target, dims, spine, as_of="2024-03-31"):
    return im.daily_against_target(activity, im.targets(target, dims), im.doses(activity, dims), dims, spine, as_of)


def test_daily_against_target(activity, target, dims, spine):
    found = rows(daily(activity, target, dims, spine), "date", "admin1", "admin5", "total_vaccinated",
                 "campaign_target", "vials_used")
    assert found == [
        # Doses join on the facility label only, so both parents' doses meet both rows.
        ("2024-03-01", "North", "Clinic", 14, 150, 2), ("2024-03-01", "North", "Clinic", 14, 150, 4),
        ("2024-03-01", "South", "Clinic", None, 150, 2), ("2024-03-01", "South", "Clinic", None, 150, 4),
        # An unlisted facility matches neither target nor doses.
        ("2024-03-02", "North", None, 7, None, None),
        # Last day of one campaign and first of the next: both match, the second without a count.
        ("2024-03-10", "North", "Clinic", 1, 150, None), ("2024-03-10", "North", "Clinic", 1, None, None),
        ("2024-03-11", "North", "Clinic", 1, None, None)]


def test_as_of_and_calendar_end(activity, target, dims, spine, spark):
    assert daily(activity, target, dims, spine, "2024-03-02").select("date").distinct().count() == 2
    longer = date_spine(spark, "2024-03-01", "2024-04-30")
    assert daily(activity, target, dims, longer, "2024-04-30").where("date = '2024-04-01'").count() == 1
    assert daily(activity, target, dims, longer, "2024-03-31").where("date = '2024-04-01'").count() == 0


def test_daily_by_age_group(activity, target, dims, spine):
    found = rows(
        im.daily_by_age_group(activity, im.targets(target, dims), dims, spine, "2024-03-31").where("date <= '2024-03-02'"),
        "date", "admin1", "age_group_label", "total_vaccinated", "total_deferred", "total_refused",
        "total_vaccinated_previously_deferred", "total_vaccinated_previously_refused", "campaign_target", "iso2_code")
    assert found == [
        ("2024-03-01", "North", "0-4", 7, 1, None, None, 2, 100, "X-HIL"),
        ("2024-03-01", "North", "5-9", 5, None, 6, None, None, 50, "X-HIL"),
        ("2024-03-01", "South", "0-4", None, 2, None, None, None, 100, None),
        ("2024-03-02", "North", "0-4", 7, None, None, None, None, None, "X-HIL")]


def test_direct_totals_equal_totals_of_the_long_table(activity, dims, spine, target):
    long = im.actuals(activity, dims)
    keys = ["date_vaccination_activity", "admin1", "admin5", "age_group_label"]
    pivot = pivot_sums(long.where("date_vaccination_activity < '2024-04-01'"), keys,
                       {"total_vaccinated": ["Vaccinated"], "total_deferred": ["Deferred"]}, "coverage_category", "indicator_value")
    direct = im.daily_by_age_group(activity, im.targets(target, dims), dims, spine, "2024-03-31")
    columns = ["admin1", "admin5", "age_group_label", "total_vaccinated", "total_deferred"]
    assert rows(direct.select(F.col("date"), *columns).distinct()) == rows(pivot, "date_vaccination_activity", *columns)


def test_large_area_tables_give_the_same_totals(spark, activity, target, dims, spine):
    """Without broadcasts rows are combined per area code first; equal labels still meet afterwards."""
    def results():
        return [rows(daily(activity, target, dims, spine)), rows(im.doses(activity, dims)),
                rows(im.daily_by_age_group(activity, im.targets(target, dims), dims, spine, "2024-03-31"))]

    small = results()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_records(activity, dims):
    assert im.records(activity, dims).count() == 8
    public = im.public_records(im.records(activity, dims))
    assert dict(public.dtypes)["submitted_at"] == "date"


def test_malformed_count_raises(spark, dims):
    bad = clean_form(form(spark, ACTIVITY, [
        visit(1, NORTH, "2024-03-01", "mr", group(ACTIVITY, age("0-4", vaccinated_males="many")))]), ACTIVITY)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        im.actuals(bad, dims).collect()


def test_malformed_json_raises(spark, dims):
    bad = clean_form(form(spark, ACTIVITY, [visit(1, NORTH, "2024-03-01", "mr", "[{broken")]), ACTIVITY)
    with pytest.raises(Exception, match="MALFORMED"):
        im.actuals(bad, dims).collect()


def test_as_of_day_reaches_the_scan(spark, activity, target, dims, tmp_path):
    """The calendar's last day limits the rows read from the landed form."""
    path = str(tmp_path / "activity")
    form(spark, ACTIVITY, [visit(1, NORTH, "2024-03-01", "mr", "[]")]).write.parquet(path)
    landed = clean_form(spark.read.schema(ACTIVITY.landed_schema()).parquet(path), ACTIVITY)
    plan = daily(landed, target, dims, date_spine(spark, "2024-03-01", "2024-03-31"), "2024-03-05")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(campaign_activity_details_date_vaccination_activity,2024-03-05)" in text
