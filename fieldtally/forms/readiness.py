"""Health-centre readiness assessment, filled in before a campaign."""

from fieldtally.forms.base import (
    PLATFORM_COLUMNS,
    SUBMISSION_TYPES,
    FormSpec,
    Question,
    answered,
    area_columns,
    numbered,
    question_block,
)

# Fixed value: the form's name in the indicator dictionary.
DICTIONARY_NAME = "hcl_monitoring_and_assessment_of_readiness"

CATEGORIES = 8

READINESS = FormSpec(
    name="readiness",
    groups={
        "microplan": answered("microplan_indicator", 9),
        "logistics_supply": answered("logistics_indicator", 7),
        "social_mobilization": answered("social_mob_indicator", 3),
        "immunization_safety": answered("imm_safety_indicator", 2),
        "supervision": answered("supervision_indicator", 5),
        "reporting_system": answered("reporting_indicator", 3),
        "vaccine_management": numbered("vacc_mngt_indicator", 3) + numbered("vacc_mngt_indicator", 4, "_remarks"),
        "human_resource": answered("hr_indicator", 2),
        "remarks_grp": ("remarks", "end_note", "endnote2"),
        "assessment_details": (
            "assessment_date", "assessment_time", "enumerator", "reporting_office",
            "vaccine_administered", "vaccine_label",
        ),
        "geographical_location": area_columns(5),
    },
    plain=PLATFORM_COLUMNS + ("section_note",),
    # The fourth vaccine-management answer is landed only as its remark; both names read that column.
    copies={"vacc_mngt_indicator4": "vaccine_management_vacc_mngt_indicator4_remarks"},
    types=SUBMISSION_TYPES,
    # The single human-resource question carries the remark of its second indicator.
    questions=(
        *question_block("microplan_indicator", 9),
        *question_block("logistics_indicator", 7),
        *question_block("social_mob_indicator", 3),
        *question_block("imm_safety_indicator", 2),
        *question_block("supervision_indicator", 5),
        *question_block("reporting_indicator", 3),
        *question_block("vacc_mngt_indicator", 4),
        Question("hr_indicator1", "hr_indicator1", "hr_indicator2_remarks"),
    ),
)
