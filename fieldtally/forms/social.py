"""Social mobilization indicators, collected during or after a campaign; four area levels."""

from fieldtally.forms.base import PLATFORM_COLUMNS, SUBMISSION_TYPES, FormSpec, Repeat, area_columns

# Indicator shown in reports -> column with its count.
RUMOURS = (
    ("Vaccine related", "vaccine_related"),
    ("Vaccination team", "vaccination_team"),
    ("Vaccination campaign", "vaccination_campaign"),
)
MOBILIZATION = (
    ("Social mobilisers/community volunteers engaged", "social_mobilisers"),
    ("Households visited", "hhs_visited"),
    ("Group meetings/learning sessions with caregivers conducted", "learning_sessions"),
    ("Religious institutions visited", "religious_institutions"),
    ("Advocacy meetings with community leaders", "advocacy_meetings"),
    ("Posters and banners produced and displayed", "posters_banners"),
)
REFUSALS_ADDRESSED = "Refusals addressed"

SOCIAL = FormSpec(
    name="social",
    groups={
        "assessment_details": ("assessment_date", "conducted_by", "conducted_by_other", "enumerator"),
        "geographical_location": area_columns(4),
        "remarks_grp": ("remarks", "end_note", "endnote2"),
        "soc_mob_indicators": (
            "vaccine_related", "vaccination_team", "vaccination_campaign", "social_mobilisers", "hhs_visited",
            "learning_sessions", "religious_institutions", "advocacy_meetings", "posters_banners",
            "refusals", "refusals_count", "rumors_misinformation", "vaccine_administered",
        ),
    },
    plain=PLATFORM_COLUMNS,
    types=SUBMISSION_TYPES,
    repeat=Repeat(
        column="soc_mob_indicators_refusals",
        path="soc_mob_indicators/refusals",
        fields=dict.fromkeys(("pos", "vaccine_name", "vaccine_label", "refusals_addressed"), "string"),
    ),
    levels=4,
)
