"""Rapid coverage assessment: door-to-door check after a campaign."""

from fieldtally.forms.base import (
    EXTRACTED_AT,
    PLATFORM_COLUMNS,
    RAW_ID,
    SUBMISSION_TYPES,
    FormSpec,
    Repeat,
    area_columns,
    numbered,
)

# Information source shown in reports -> column with the number of doors.
INFORMATION_SOURCES = (
    ("Radio", "radio"),
    ("Tv", "tv"),
    ("Flyers", "flyers"),
    ("Other sources of information", "others"),
    ("Streamer/Tarpaulin", "streamer"),
    ("Officials", "officials"),
    ("Social media", "social_media"),
    ("Health workers", "health_workers"),
    ("Relatives/Neighbours", "relatives_neighbours"),
)

# Fixed values: (status, sex, field) of the children counts.
CHILDREN_COUNTS = tuple(
    (status, sex, f"{stem}_{sex.lower()}")
    for status, stem in (
        ("Present in hh", "present"),
        ("Vaccinated", "vaccinated"),
        ("Not vaccinated", "not_vaccinated"),
    )
    for sex in ("Males", "Females")
)

NOT_VACCINATED = "Not vaccinated"

# Reason shown in reports -> field with the number of children.
REASONS = tuple((f"Reason {i}", f"reason_{i}") for i in range(1, 11)) + (("Other", "other_reasons"),)

INT_COLUMNS = (
    "radio", "tv", "flyers", "others", "streamer", "officials", "social_media", "relatives_neighbours",
    "sources_total", "doors_visited", "vaccinated_total", "total_unvaccinated",
)

_BY_SEX = tuple(
    f"{stem}_{sex}"
    for stem in ("present", "vaccinated", "not_vaccinated", "finger_marked")
    for sex in ("males", "females")
)

RAPID_COVERAGE = FormSpec(
    name="rapid_coverage",
    groups={
        "assessment_details": ("rca_date", "conducted_by", "conducted_by_other", "enumerator", "team_members"),
        "geographical_location": area_columns(5),
        "immunization_coverage": (
            "age_group", "doors_visited", "total_unvaccinated", "vaccinated_total", "vaccination",
            "vaccination_count", "vaccine_administered",
        ),
        "remarks_grp": ("remarks", "end_note", "endnote2"),
        "sources": (
            "radio", "tv", "flyers", "others", "streamer", "officials", "social_media", "health_workers",
            "relatives_neighbours", "source_info", "source_info_other", "sources_note", "sources_total",
        ),
    },
    # The mop-up answer keeps its prefix: it is the field's own name.
    plain=PLATFORM_COLUMNS + ("rca_mop_up", RAW_ID, EXTRACTED_AT),
    types={**SUBMISSION_TYPES, **dict.fromkeys(INT_COLUMNS, "int")},
    landed_types={
        **{
            f"sources_{c}": "int"
            for c in ("radio", "tv", "flyers", "others", "streamer", "officials", "social_media",
                      "relatives_neighbours", "sources_total")
        },
        **{f"immunization_coverage_{c}": "int" for c in ("doors_visited", "vaccinated_total", "total_unvaccinated")},
    },
    repeat=Repeat(
        column="immunization_coverage_vaccination",
        path="immunization_coverage/vaccination",
        fields=dict.fromkeys(
            ("pos", "age_group_name", "age_group_label")
            + _BY_SEX
            + ("males_remain", "females_remain", "total_vaccinated", "total_not_vaccinated")
            + numbered("unvaccinated/reason_", 10)
            + tuple(
                f"unvaccinated/{c}"
                for c in ("other_reasons", "reasons", "reasons_note", "reasons_other", "reasons_total")
            ),
            "string",
        ),
    ),
)
