"""Daily immunization activity: children vaccinated, deferred and refused, and vials used."""

from fieldtally.forms.base import (
    PLATFORM_COLUMNS,
    RAW_ID,
    SUBMISSION_TYPES,
    FormSpec,
    Repeat,
    area_columns,
    numbered,
)

VACCINATED = "Vaccinated"
DEFERRED = "Deferred"
REFUSED = "Refused"
DEFERRED_VACCINATED = "Deferred Vaccinated"
REFUSED_VACCINATED = "Refused Vaccinated"

# Status shown in reports -> the two fields (males, females) that count it.
STATUS_FIELDS = {
    VACCINATED: ("vaccinated_males", "vaccinated_females"),
    DEFERRED_VACCINATED: ("vaccinated_males_previously_deferred", "vaccinated_females_previously_deferred"),
    REFUSED_VACCINATED: ("vaccinated_males_previously_refused", "vaccinated_females_previously_refused"),
    DEFERRED: ("deferred_males", "deferred_females"),
    REFUSED: ("refused_males", "refused_females"),
}

COVERAGE_COUNTS = tuple(
    (status, sex, column)
    for status, columns in STATUS_FIELDS.items()
    for sex, column in zip(("Males", "Females"), columns)
)

# Statuses that count as reached by the campaign.
REACHED = (VACCINATED, DEFERRED_VACCINATED, REFUSED_VACCINATED)

# Fixed values: (reason shown in reports, status, field) of the deferral and refusal reasons.
REASON_COUNTS = tuple(
    (reason, status, column)
    for status, stem in ((DEFERRED, "deferred"), (REFUSED, "refused"))
    for reason, column in [(f"Reason {i}", f"{stem}_reason_{i}") for i in range(1, 13)] + [("Other", f"{stem}_other")]
)


def _unreached(stem: str) -> dict[str, str]:
    """Fields of the deferred or the refused block."""
    counts = numbered(f"{stem}/{stem}_reason_", 12) + tuple(f"{stem}/{stem}_{c}" for c in ("other", "males", "females"))
    texts = tuple(f"{stem}/{stem}_{c}" for c in ("reason", "total", "note", "reason_other"))
    return dict.fromkeys(counts, "bigint") | dict.fromkeys(texts + (f"{stem}/total_{stem}_reason",), "string")


ACTIVITY = FormSpec(
    name="activity",
    groups={
        "campaign_activity_details": ("date_vaccination_activity", "enumerator"),
        "geographic_location": area_columns(6),
        "immunization_coverage": ("age_group", "vaccine", "vaccine_administered", "vaccine_count", "vaccine_label"),
        "remarks_grp": ("remarks", "endnote", "endnote2"),
        "vaccine_logistics": ("vial_dosage", "vials_discarded", "vials_used"),
    },
    plain=PLATFORM_COLUMNS + (RAW_ID,),
    types={
        **SUBMISSION_TYPES,
        "date_vaccination_activity": "date",
        "admin4_lat": "double",
        "admin4_long": "double",
        "vial_dosage": "int",
        "vials_discarded": "int",
        "vials_used": "int",
    },
    landed_types={
        "campaign_activity_details_date_vaccination_activity": "date",
        "geographic_location_admin4_lat": "double",
        "geographic_location_admin4_long": "double",
        "vaccine_logistics_vial_dosage": "int",
        "vaccine_logistics_vials_discarded": "int",
        "vaccine_logistics_vials_used": "int",
    },
    repeat=Repeat(
        column="immunization_coverage_vaccine",
        path="immunization_coverage/vaccine",
        fields={
            **dict.fromkeys(("pos", "age_group_name", "age_group_label"), "string"),
            **dict.fromkeys((f"coverage/{c}" for s in REACHED for c in STATUS_FIELDS[s]), "bigint"),
            **_unreached("deferred"),
            **_unreached("refused"),
            "coverage/vaccinated_males_previously_refused": "string",
        },
    ),
)
