"""Monitoring visit during a campaign: microplan, vaccine management and one block per vaccination team."""

from fieldtally.forms.base import (
    EXTRACTED_AT,
    PLATFORM_COLUMNS,
    RAW_ID,
    FormSpec,
    Question,
    Repeat,
    answered,
    area_columns,
    question_block,
)

# Fixed value: the form's name in the indicator dictionary.
DICTIONARY_NAME = "synchronized_vaccination_monitoring_tool"

CATEGORIES = 3

_FOLLOW_UPS = ("28a", "28b", "29a", "29b", "30a", "30b", "30c")

TEAM_QUESTIONS = question_block("part3_indicator", 18)

MONITORING = FormSpec(
    name="monitoring",
    groups={
        "campaign_activity_details": (
            "date_vaccination_activity", "time_vaccination_activity", "enumerator", "reporting_office",
        ),
        "geographical_location": area_columns(6),
        "immunization_coverage": (
            "hc_target", "total_vaccinated_as_time_visit", "vaccination_teams_no", "vaccine_administered",
            "vaccine_label",
        ),
        "part1": answered("part1_indicator", 24),
        "part2": answered("part2_indicator", 30) + tuple(f"part2_indicator{n}" for n in _FOLLOW_UPS),
        "part3": ("vaccination_team_info", "vaccination_team_info_count"),
        "remarks_grp": ("remarks", "end_note", "endnote2"),
    },
    plain=PLATFORM_COLUMNS + (RAW_ID, EXTRACTED_AT),
    types={
        "submitted_at": "date",
        "modified_at": "date",
        "today": "date",
        "start": "timestamp_ntz",
        "end": "timestamp_ntz",
        "date_vaccination_activity": "date",
        "admin4_lat": "float",
        "admin4_long": "float",
        "vaccination_teams_no": "int",
        "total_vaccinated_as_time_visit": "int",
    },
    landed_types={
        "_submission_time": "date",
        "_date_modified": "date",
        "campaign_activity_details_date_vaccination_activity": "date",
        "geographical_location_admin4_lat": "float",
        "geographical_location_admin4_long": "float",
        "immunization_coverage_total_vaccinated_as_time_visit": "int",
        "immunization_coverage_vaccination_teams_no": "int",
    },
    # A follow-up question's remark is landed as the b-part of the same number.
    questions=(
        *question_block("part1_indicator", 24),
        *question_block("part2_indicator", 30),
        *(Question(f"part2_indicator{n}a", f"part2_indicator{n}a", f"part2_indicator{n}b") for n in (28, 29, 30)),
    ),
    repeat=Repeat(
        column="part3_vaccination_team_info",
        path="part3/vaccination_team_info",
        fields=dict.fromkeys(
            ("pos", "vt_leader", "note")
            + answered("part3_indicator", 18)
            + tuple(f"part3_indicator{n}" for n in ("7a", "7b", "12a")),
            "string",
        ),
    ),
)
