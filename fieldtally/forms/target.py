"""Campaign targets per facility, vaccine and age group; every landed column is text."""

from fieldtally.forms.base import PLATFORM_COLUMNS, RAW_ID, FormSpec, Repeat, area_columns

TARGET = FormSpec(
    name="target",
    groups={
        "geographic_location": area_columns(5),
        "immunization_campaign_details": (
            "campaign_start_date", "campaign_end_date", "campaign_round", "reporting_office",
        ),
        "immunization_coverage": (
            "age_group", "target_children", "target_children_count", "vaccine_administered", "vaccine_label",
        ),
        "vaccine_logistics": ("vaccines_received",),
    },
    plain=PLATFORM_COLUMNS + (RAW_ID,),
    repeat=Repeat(
        column="immunization_coverage_target_children",
        path="immunization_coverage/target_children",
        fields={"pos": "string", "age_group_name": "string", "age_group_label": "string", "no_children": "bigint"},
    ),
)
