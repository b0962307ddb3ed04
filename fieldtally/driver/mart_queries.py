"""One query per clean, staging and public table, from driver tables landed as forms.

The check SQL of a table starts from plain columns and follows the tables' definition literally: long
rows first, labels joined to them, totals and scores taken last.
"""

from __future__ import annotations

from fieldtally.driver import raw_forms as raw
from fieldtally.driver.registry import query
from fieldtally.driver.sql import (
    AGES, CHOICES, MONITORING_DICTIONARY, MONITORING_SIZES, READINESS_DICTIONARY, READINESS_SIZES, area_joins,
    area_labels, cells, coordinates, filled_columns, iso_code, iso_join, json_group, readiness_answers, stamps,
)
from fieldtally.forms import ACTIVITY, FORMS, MONITORING, RAPID_COVERAGE, READINESS, TARGET
from fieldtally.forms.activity import COVERAGE_COUNTS, REASON_COUNTS
from fieldtally.forms.rapid_coverage import CHILDREN_COUNTS, INFORMATION_SOURCES, REASONS
from fieldtally.forms.social import MOBILIZATION, REFUSALS_ADDRESSED, RUMOURS
from fieldtally.operators.repeat import short_name
from fieldtally.plans.warehouse import Warehouse

ORDER_DAY = raw.ORDER_DAY
PLACE_LIST = "admin1, admin2, admin3, admin4, admin5"


def _mart(key: str, table_name: str, sql: str, forms: tuple[str, ...], fill: bool = False) -> None:
    """Register warehouse table ``table_name`` under ``key``; ``fill`` gives all landed columns a content."""
    query(key, sql)(lambda spark, sf_dir: Warehouse(raw.inputs(spark, sf_dir, forms, fill))[table_name])


def _clean(name: str, key: str, stated: tuple[str, ...], sql: str, more: dict[str, str] | None = None,
           typed: dict[str, str] | None = None) -> None:
    """Register a clean form with all its columns. ``sql`` selects the ``stated`` ones, ``more`` states others, and
    the rest are filled, as text unless ``typed`` says otherwise."""
    more = more or {}
    rest = filled_columns(FORMS[name], key, {*stated, *more}, typed or {})
    added = ", ".join([*[f'{e} as "{c}"' for c, e in more.items()], rest])
    _mart(f"clean_{name}", f"clean.{name}", sql.replace("select ", f"select {added}, ", 1), (name,), fill=True)


def _repeat(key: str, table_name: str, form: str, stated: tuple[str, ...], sql: str) -> None:
    """Register a repeat table with all its columns; those that no submission answers are NULL text."""
    fields = [short_name(f) for f in FORMS[form].repeat.fields]
    unanswered = "".join(f'cast(null as varchar) as "{f}", ' for f in dict.fromkeys(fields) if f not in stated)
    _mart(key, table_name, sql.replace("select ", f"select {unanswered}", 1), (form,))


def _public(key: str, table_name: str, staged: str, forms: tuple[str, ...]) -> None:
    """Register the reporting projection of a staged table: its two timestamps become dates."""
    _mart(key, table_name, f"""
        select * replace (cast(submitted_at as date) as submitted_at, cast(modified_at as date) as modified_at)
        from ({staged})""", forms)


# ---------------------------------------------------------------- readiness

VISIT_DAY = raw.visit_day("c_custkey")
FACILITY_CODE = f"(case when c_custkey % 29 = 0 then null else {raw.FACILITY} end)"
READINESS_AREAS = area_joins(raw.FACILITY, codes={5: FACILITY_CODE})

HC_ASSESSMENT = f"""
    select a.id, a.indicators_value, a.indicators_remarks, d.label as indicators_label, d.category as indicators_category
    from (select c_custkey as id, {readiness_answers()} from customer) a
    left join {READINESS_DICTIONARY} d on d.name = a.indicator_name"""

HCL_ASSESSMENT = f"""
    with latest as (
        select {FACILITY_CODE} as facility, max({VISIT_DAY}) as day from customer group by 1),
    answers as (
        select c_custkey, c_mktsegment, {readiness_answers()} from customer)
    select a.c_custkey as id, cast(l.day as varchar) as assessment_date, cast(null as varchar) as vaccine_label,
           {area_labels()}, {coordinates('a.c_custkey')}, a.indicators_value, a.indicators_remarks,
           trim(d.label) as indicators_label, d.category as indicators_category, s.n as no_of_questions,
           {stamps(raw.visit_day('a.c_custkey'))}, a.c_mktsegment as enumerator
    from (select * from answers) a
    left join latest l on l.facility = {FACILITY_CODE.replace('c_custkey', 'a.c_custkey')}
                      and l.day = {raw.visit_day('a.c_custkey')}
    left join {READINESS_DICTIONARY} d on d.name = a.indicator_name
    left join {READINESS_SIZES} s on s.category = d.category
    {READINESS_AREAS.replace('c_custkey %', 'a.c_custkey %')}"""

READY_FACILITIES = f"""
    with category as (
        select *, cast(yes_count as double) / cast(no_of_questions as double) as p
        from (select {PLACE_LIST}, latitude, longitude, indicators_category, no_of_questions,
                     count(id) filter (where indicators_value = 'Yes') as yes_count
              from ({HCL_ASSESSMENT}) group by all)),
    facility as (
        select {PLACE_LIST}, latitude, longitude,
               coalesce(list({{'yes': yes_count, 'size': no_of_questions}}) filter (p is not null), []) as parts,
               cast(round_even(cast(sum(case when p = 1 then 1 else 0 end) as double) / 8 * 100, 0) as int) as category_value
        from category group by all),
    common as (
        select *, coalesce(cast(list_aggregate(list_distinct(list_transform(parts, lambda x: x.size)), 'product') as hugeint), 1) as whole
        from facility),
    scored as (select *, list_sum(list_transform(parts, lambda x: x.yes * (whole // x.size))) as total from common)
    select {PLACE_LIST}, latitude, longitude, cast(total as double) / cast(whole as double) as readiness_value,
           case when total = 8 * whole then 'Yes' else 'No' end as facility_ready, category_value,
           case when category_value < 50 then '<50%' when category_value <= 99 then '50-99%'
                when category_value = 100 then '100%' end as category_label
    from scored"""

_mart("mart_hc_assessment", "staging.hc_assessment", HC_ASSESSMENT, ("readiness",))
_mart("mart_hcl_monitoring_assessment", "staging.hcl_monitoring_assessment", HCL_ASSESSMENT, ("readiness",))
_mart("mart_ready_facilities", "staging.ready_facilities", READY_FACILITIES, ("readiness",))
_public("public_hcl_monitoring_assessment", "public.hcl_monitoring_assessment", HCL_ASSESSMENT, ("readiness",))


# ---------------------------------------------------------------- rapid coverage

RCA_BASE = f"""
    select o_orderkey as submission_id, {ORDER_DAY} as rca_date, {area_labels()}, {coordinates('o_custkey')},
           v.label as vaccine_administered, {iso_code()} as iso2_code, o_orderkey, o_orderstatus
    from orders {area_joins('o_custkey')} {iso_join()}
    left join {CHOICES} v on v.code = o_orderpriority and v.question = 'vaccine_administered'"""
RCA_KEYS = f"submission_id, rca_date, {PLACE_LIST}, latitude, longitude, vaccine_administered"

RCA_ACTUALS = f"""
    select {RCA_KEYS}, iso2_code, age as age_group_label, {cells(
        ('rca_category', 'indicator_category', 'indicator_value'),
        [(f"'{status}'", f"'{sex}'", f"cast({raw.child_cell(field, 'e')} as bigint)")
         for status, sex, field in CHILDREN_COUNTS])}
    from ({RCA_BASE}), {AGES} where e < {raw.repeat_length('o_orderkey')}"""

RCA = f"""
    with missed as (
        select submission_id, cast(sum(indicator_value) filter (where rca_category = 'Not vaccinated') as bigint) as total
        from ({RCA_ACTUALS}) group by submission_id)
    select {', '.join('b.' + k.strip() for k in RCA_KEYS.split(','))}, b.iso2_code,
           cast(b.o_orderkey % 30 as bigint) as doors_visited,
           case when b.o_orderkey % 3 = 0 then 'Yes' else 'No' end as rca_mop_up, c.label as conducted_by,
           m.total as total_not_vaccinated, {stamps('b.rca_date')}, concat('enumerator ', b.o_orderkey % 17) as enumerator
    from ({RCA_BASE}) b
    left join missed m on m.submission_id = b.submission_id
    left join {CHOICES} c on c.code = b.o_orderstatus and c.question = 'conducted_by'"""

RCA_SOURCES = f"""
    select * from (
        select {RCA_KEYS}, {cells(
            ('sources_info', 'no_doors'),
            [(f"'{label}'", f"cast({raw.source_cell(column)} as bigint)") for label, column in INFORMATION_SOURCES])}
        from ({RCA_BASE})) where no_doors is not null"""

RCA_REASONS = f"""
    select * replace (cast(submission_id as varchar) as submission_id, cast(rca_date as varchar) as rca_date) from (
        select {RCA_KEYS}, {cells(
            ('reasons', 'reasons_value'),
            [(f"'{label}'", f"cast({raw.reason_cell(field, 'e')} as bigint)") for label, field in REASONS])}
        from ({RCA_BASE}), {AGES} where e < {raw.repeat_length('o_orderkey')}) where reasons_value is not null"""

_mart("mart_rca_actuals", "staging.rca_actuals", RCA_ACTUALS, ("rapid_coverage",))
_mart("mart_rca", "staging.rca", RCA, ("rapid_coverage",))
_mart("mart_rca_sources_info", "staging.rca_sources_info", RCA_SOURCES, ("rapid_coverage",))
_mart("mart_rca_not_vaccinated_reasons", "staging.rca_not_vaccinated_reasons", RCA_REASONS, ("rapid_coverage",))
_public("public_rca", "public.rca", RCA, ("rapid_coverage",))


# ---------------------------------------------------------------- immunization

SIA_BASE = f"""
    select o_orderkey, o_orderkey as submission_id, {ORDER_DAY} as date_vaccination_activity, {area_labels()},
           {coordinates('o_custkey')}, o_orderpriority as vaccine_administered
    from orders {area_joins('o_custkey')}"""
SIA_KEYS = f"submission_id, date_vaccination_activity, {PLACE_LIST}, latitude, longitude, vaccine_administered"

SIA_ACTUALS = f"""
    select {SIA_KEYS}, age as age_group_label, {cells(
        ('coverage_category', 'indicator_category', 'indicator_value'),
        [(f"'{status}'", f"'{sex}'", f"cast({raw.activity_cell(field, 'e')} as bigint)")
         for status, sex, field in COVERAGE_COUNTS])}
    from ({SIA_BASE}), {AGES} where e < {raw.repeat_length('o_orderkey')}"""

SIA_REASONS = f"""
    select * from (
        select submission_id, date_vaccination_activity, {PLACE_LIST}, vaccine_administered, age as age_group_label, {cells(
            ('reason_category', 'coverage_category', 'reasons_value'),
            [(f"'{reason}'", f"'{status}'", f"cast({raw.activity_cell(field, 'e')} as bigint)")
             for reason, status, field in REASON_COUNTS])}
        from ({SIA_BASE}), {AGES} where e < {raw.repeat_length('o_orderkey')}) where reasons_value is not null"""

CAMPAIGN = f"({raw.CAMPAIGNS_SQL.format(orders='orders')})"
SIA_TARGETS = f"""
    select {area_labels()}, first_day as campaign_start_date, first_day + {raw.CAMPAIGN_LENGTH} as campaign_end_date,
           {raw.CAMPAIGN_LENGTH} as campaign_days, o_orderpriority as vaccine_administered,
           cast(t.target as bigint) as campaign_target, t.age as age_group_label
    from {CAMPAIGN} c
    left join (select o_custkey as k, o_orderpriority as p, half as h, age, {raw.target_cell('e')} as target
               from {CAMPAIGN}, {AGES} where e < {raw.repeat_length('o_custkey')}) t
      on t.k = c.o_custkey and t.p = c.o_orderpriority and t.h = c.half
    {area_joins('o_custkey')}"""

SIA_DOSE = f"""
    select {ORDER_DAY} as date_vaccination_activity, {area_labels()}, o_orderpriority as vaccine_administered,
           cast(max({raw.VIAL_DOSAGE}) as varchar) as vial_dosage, cast(sum({raw.VIALS_USED}) as bigint) as vials_used,
           cast(sum({raw.VIAL_DOSAGE} * ({raw.VIALS_USED})) as bigint) as vaccine_dose,
           cast(sum({raw.VIALS_DISCARDED}) as bigint) as vials_discarded
    from orders {area_joins('o_custkey')} group by all"""

SPINE = """(select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
                                               interval 1 day)) as date) as date from orders)"""


def _status_sum(*statuses: str) -> str:
    listed = ", ".join(f"'{s}'" for s in statuses)
    return f"cast(sum(indicator_value) filter (where coverage_category in ({listed})) as bigint)"


AGGREGATED = f"""
    with actuals as (
        select date_vaccination_activity, {PLACE_LIST}, latitude, longitude, vaccine_administered,
               {_status_sum('Vaccinated', 'Deferred Vaccinated', 'Refused Vaccinated')} as total_vaccinated
        from ({SIA_ACTUALS}) group by all),
    goals as (
        select admin5, vaccine_administered, campaign_start_date, campaign_end_date,
               cast(sum(campaign_target) as bigint) as campaign_target
        from ({SIA_TARGETS}) group by all)
    select s.date, a.admin1, a.admin2, a.admin3, a.admin4, a.admin5, a.vaccine_administered, a.total_vaccinated,
           g.campaign_target, d.vials_used, d.vials_discarded, d.vaccine_dose, d.vial_dosage, a.latitude, a.longitude
    from {SPINE} s
    left join actuals a on a.date_vaccination_activity = s.date
    left join goals g on g.vaccine_administered = a.vaccine_administered and g.admin5 = a.admin5
                     and s.date between g.campaign_start_date and g.campaign_end_date
    left join ({SIA_DOSE}) d on d.date_vaccination_activity = s.date and d.admin5 = a.admin5
                            and d.vaccine_administered = a.vaccine_administered
    where s.date <= date '{raw.AS_OF}' and a.date_vaccination_activity is not null"""

BY_AGE_GROUP = f"""
    with actuals as (
        select date_vaccination_activity as day, {PLACE_LIST}, latitude, longitude, vaccine_administered, age_group_label,
               {_status_sum('Vaccinated')} as total_vaccinated, {_status_sum('Deferred')} as total_deferred,
               {_status_sum('Refused')} as total_refused,
               {_status_sum('Deferred Vaccinated')} as total_vaccinated_previously_deferred,
               {_status_sum('Refused Vaccinated')} as total_vaccinated_previously_refused
        from ({SIA_ACTUALS}) group by all)
    select s.date, a.* exclude (day), g.campaign_target, {iso_code()} as iso2_code
    from {SPINE} s
    left join actuals a on a.day = s.date
    left join ({SIA_TARGETS}) g on g.vaccine_administered = a.vaccine_administered and g.admin5 = a.admin5
         and g.age_group_label = a.age_group_label and s.date between g.campaign_start_date and g.campaign_end_date
    left join nation iso on iso.n_name = a.admin2 and iso.n_nationkey % {raw.ISO_GAP} <> 0
    where s.date <= date '{raw.AS_OF}' and a.day is not null"""

SIA_RECORDS = f"""
    select submission_id, date_vaccination_activity, {PLACE_LIST}, vaccine_administered,
           {stamps('date_vaccination_activity')}, concat('enumerator ', o_orderkey % 17) as enumerator
    from ({SIA_BASE})"""

_mart("mart_sia_actuals", "staging.sia_actuals", SIA_ACTUALS, ("activity",))
_mart("mart_sia_targets", "staging.sia_targets", SIA_TARGETS, ("target",))
_mart("mart_sia_vaccine_dose", "staging.sia_vaccine_dose", SIA_DOSE, ("activity",))
_mart("mart_aggregated_sia_actuals_target", "staging.aggregated_sia_actuals_target", AGGREGATED, ("activity", "target"))
_mart("mart_sia_actuals_target", "staging.sia_actuals_target", BY_AGE_GROUP, ("activity", "target"))
_mart("mart_deferred_refused_reasons", "staging.deferred_refused_reasons", SIA_REASONS, ("activity",))
_mart("mart_sia_records", "staging.sia_records", SIA_RECORDS, ("activity",))
_public("public_sia_records", "public.sia_records", SIA_RECORDS, ("activity",))


# ---------------------------------------------------------------- social mobilization

SOCIAL = f"""
    with counted as (
        select event_id, {cells(
            ('indicators_category', 'indicators_value'),
            [(f"'{label}'", f"cast({raw.social_cell(column)} as bigint)") for label, column in RUMOURS + MOBILIZATION])}
        from events),
    refusals as (
        select event_id, cast({raw.refusal_cell('e')} as bigint) as addressed, {raw.refusal_vaccine('e')} as vaccine
        from events, {AGES} where e < {raw.REFUSAL_ROWS}),
    combined as (
        select * from counted
        union all select event_id, '{REFUSALS_ADDRESSED}', addressed from refusals)
    select c.event_id as id, {raw.EVENT_DAY} as assessment_date, {area_labels((1, 2, 3, 4))},
           case when {raw.SOCIAL_CONDUCTED_BY} = 'others' then concat('team ', user_id % 9)
                else {raw.SOCIAL_CONDUCTED_BY} end as conducted_by,
           c.indicators_category, c.indicators_value, r.vaccine as vaccine_administered, {iso_code()} as iso2_code,
           {stamps(raw.EVENT_DAY)}, concat('enumerator ', c.event_id % 17) as enumerator
    from combined c
    join events f on f.event_id = c.event_id
    {area_joins('user_id', (1, 2, 3, 4))} {iso_join()}
    left join refusals r on r.event_id = c.event_id"""

_mart("mart_social_mobilization_indicators", "staging.social_mobilization_indicators", SOCIAL, ("social",))
_public("public_social_mobilization_indicators", "public.social_mobilization_indicators", SOCIAL, ("social",))


# ---------------------------------------------------------------- monitoring tool

NAMES = ("indicator_name", "indicators_value", "indicators_remarks")
VISIT_ANSWERS = f"""select c_custkey as id, {cells(NAMES, [
    (f"'{q.name}'", raw.monitoring_answer(q.name), raw.monitoring_remark(q.remark)) for q in MONITORING.questions])}
    from customer"""
TEAM_ANSWERS = f"""select c_custkey as id, {cells(NAMES, [
    (f"'{name}'", raw.team_answer(name, 'e'),
     f"case when (c_custkey + {i} + e) % 4 = 0 then concat('note ', {i} + e) end")
    for i, name in enumerate(raw.TEAM_FIELDS)])}
    from customer, {AGES} where e < {raw.TEAMS}"""


def _labelled(answers: str, key: str = "id") -> str:
    return f"""
        select a.id as {key}, a.indicators_value, a.indicators_remarks, d.label as indicators_label,
               d.category as indicators_category
        from ({answers}) a left join {MONITORING_DICTIONARY} d on d.name = a.indicator_name"""


MONITORING_AREAS = area_joins("c_custkey", codes={5: "(case when c_custkey % 13 = 0 then null else c_custkey end)"})
MONITORING_TOOL = f"""
    select mt.id, {VISIT_DAY} as date_vaccination_activity, {area_labels()}, {coordinates('c.c_custkey')},
           concat('vaccine ', c.c_nationkey % 3) as vaccine_label, mt.indicators_value, mt.indicators_remarks,
           mt.indicators_label, mt.indicators_category, s.n as no_of_questions
    from ({_labelled(VISIT_ANSWERS)} union all {_labelled(TEAM_ANSWERS)}) mt
    left join {MONITORING_SIZES} s on s.category = mt.indicators_category
    left join (select c_custkey, c_nationkey from customer) c on c.c_custkey = mt.id
    {MONITORING_AREAS.replace('c_custkey', 'c.c_custkey').replace('a5.c.c_custkey', 'a5.c_custkey')}
    where a5.c_name is not null""".replace(VISIT_DAY, raw.visit_day("c.c_custkey"))

FACILITY_SCORES = f"""
    with category as (
        select *, cast(yes_count as double) / cast(no_of_questions as double) as p
        from (select id, date_vaccination_activity, {PLACE_LIST}, latitude, longitude, vaccine_label,
                     indicators_category, no_of_questions,
                     count(id) filter (where indicators_value = 'Yes') as yes_count
              from ({MONITORING_TOOL}) where indicators_value is not null group by all)),
    visit as (
        select id, date_vaccination_activity, {PLACE_LIST}, latitude, longitude, vaccine_label as vaccine_administered,
               cast(sum(case when p = 1 then 1 else 0 end) as double) / 3 * 100 as overall_facility_proportion
        from category group by all)
    select *, case when overall_facility_proportion < 50 then '<50%'
                   when overall_facility_proportion <= 99 then '50-99%'
                   when overall_facility_proportion = 100 then '100%' end as overall_proportion_category
    from visit"""

VACCINATED_CHILDREN = f"""
    select c.c_custkey as id, {area_labels()}, {coordinates('c.c_custkey')},
           {raw.visit_day('c.c_custkey')} as date_vaccination_activity,
           concat('vaccine ', c.c_nationkey % 3) as vaccine_administered,
           cast(c.c_custkey % 90 as bigint) as total_vaccinated_as_time_visit,
           cast(c.c_custkey % 120 as bigint) as hc_target, {iso_code()} as iso2_code,
           {raw.visit_day('c.c_custkey')} as submitted_at, {raw.visit_day('c.c_custkey')} + 1 as modified_at,
           c.c_mktsegment as enumerator
    from customer c
    {MONITORING_AREAS.replace('c_custkey', 'c.c_custkey').replace('a5.c.c_custkey', 'a5.c_custkey')} {iso_join()}"""

_mart("mart_microplan_vaccine_management", "staging.microplan_vaccine_management", _labelled(VISIT_ANSWERS), ("monitoring",))
_mart("mart_vaccination_site_questions", "staging.vaccination_site_questions_monitoring_tool",
      _labelled(TEAM_ANSWERS, "parent_id"), ("monitoring",))
_mart("mart_monitoring_tool", "staging.monitoring_tool", MONITORING_TOOL, ("monitoring",))
_mart("mart_monitored_facilities_overall_proportion", "staging.monitored_facilities_overall_proportion",
      FACILITY_SCORES, ("monitoring",))
_mart("mart_vaccinated_children", "staging.vaccinated_children_under_monitoring_tool", VACCINATED_CHILDREN, ("monitoring",))
_public("public_vaccinated_children", "public.vaccinated_children_under_monitoring_tool", VACCINATED_CHILDREN, ("monitoring",))


# ---------------------------------------------------------------- clean repeat groups

_repeat("clean_activity_vaccine", "clean.activity_vaccine", "activity",
        ("_airbyte_ab_id", "pos", "age_group_label", "age_group_name", *raw.ACTIVITY_FIELDS), f"""
    select concat('r', o_orderkey) as _airbyte_ab_id, cast(e + 1 as varchar) as pos, age as age_group_label,
           concat('g', e) as age_group_name,
           {', '.join(f"cast({raw.activity_cell(f, 'e')} as {'varchar' if f == 'vaccinated_males_previously_refused' else 'bigint'}) as {f}"
                      for f in raw.ACTIVITY_FIELDS)}
    from orders, {AGES} where e < {raw.repeat_length('o_orderkey')}""")
_mart("clean_target_children", "clean.target_children", f"""
    select concat('t', o_custkey, '-', o_orderpriority, '-', half) as _airbyte_ab_id, cast(e + 1 as varchar) as pos,
           age as age_group_label, concat('g', e) as age_group_name, cast({raw.target_cell('e')} as bigint) as no_children
    from {CAMPAIGN}, {AGES} where e < {raw.repeat_length('o_custkey')}""", ("target",))
_repeat("clean_rapid_coverage_vaccination", "clean.rapid_coverage_vaccination", "rapid_coverage",
        ("_airbyte_ab_id", "_airbyte_emitted_at", "pos", "age_group_name", "age_group_label", *raw.CHILD_FIELDS, *raw.REASON_FIELDS), f"""
    select concat('c', o_orderkey) as _airbyte_ab_id, cast({ORDER_DAY} as varchar) as _airbyte_emitted_at,
           cast(e + 1 as varchar) as pos, concat('g', e) as age_group_name, age as age_group_label,
           {', '.join(f"cast({raw.child_cell(f, 'e')} as varchar) as {f}" for f in raw.CHILD_FIELDS)},
           {', '.join(f"cast({raw.reason_cell(f, 'e')} as varchar) as {f}" for f in raw.REASON_FIELDS)}
    from orders, {AGES} where e < {raw.repeat_length('o_orderkey')}""")
_mart("clean_social_refusals", "clean.social_refusals", f"""
    select cast(event_id as varchar) as id, cast(e + 1 as varchar) as pos, concat('v', e) as vaccine_name,
           {raw.refusal_vaccine('e')} as vaccine_label, cast({raw.refusal_cell('e')} as varchar) as refusals_addressed
    from events, {AGES} where e < {raw.REFUSAL_ROWS}""", ("social",))
_repeat("clean_monitoring_team_info", "clean.monitoring_team_info", "monitoring",
        ("_airbyte_ab_id", "_airbyte_emitted_at", "pos", "vt_leader", *raw.TEAM_FIELDS, *[f"{f}_remarks" for f in raw.TEAM_FIELDS]), f"""
    select concat('m', c_custkey) as _airbyte_ab_id, cast({VISIT_DAY} as varchar) as _airbyte_emitted_at,
           cast(e + 1 as varchar) as pos, concat('leader ', e) as vt_leader,
           {', '.join(f"{raw.team_answer(f, 'e')} as {f}" for f in raw.TEAM_FIELDS)},
           {', '.join(f"case when (c_custkey + {i} + e) % 4 = 0 then concat('note ', {i} + e) end as {f}_remarks"
                      for i, f in enumerate(raw.TEAM_FIELDS))}
    from customer, {AGES} where e < {raw.TEAMS}""")


# ---------------------------------------------------------------- clean forms

def _area_texts(place: str, levels: int = 5, codes: dict[int, str] | None = None) -> str:
    return ", ".join(
        f"cast({(codes or {}).get(i, raw.area_code(place, i))} as varchar) as admin{i}" for i in range(1, levels + 1))


_AREA_NAMES = ("admin1", "admin2", "admin3", "admin4", "admin5")
_READINESS_FILLED = {q.value: raw.readiness_answer(q.name) for q in READINESS.questions} | {
    q.remark: raw.readiness_remark(q.remark) for q in READINESS.questions}
_MONITORING_FILLED = {q.value: raw.monitoring_answer(q.name) for q in MONITORING.questions} | {
    q.remark: raw.monitoring_remark(q.remark) for q in MONITORING.questions}


def _filled(cells_by_column: dict[str, str]) -> str:
    return ", ".join(f"{expression} as {column}" for column, expression in cells_by_column.items())


_clean("readiness", "c_custkey",
    ("id", "assessment_date", "enumerator", "submitted_at", "modified_at", *_AREA_NAMES, *_READINESS_FILLED),
    f"""
    select cast(c_custkey as varchar) as id, cast({VISIT_DAY} as varchar) as assessment_date, c_mktsegment as enumerator,
           {stamps(VISIT_DAY)}, {_area_texts(raw.FACILITY, codes={5: FACILITY_CODE})}, {_filled(_READINESS_FILLED)}
    from customer""",
    more={"admin4_lat": raw.text(raw.latitude("c_custkey")), "admin4_long": raw.text(raw.longitude("c_custkey")),
        "vaccine_administered": """concat('["', lower(c_mktsegment), '" "opv"]')"""})
_clean("monitoring", "c_custkey",
    ("id", "_airbyte_ab_id", "date_vaccination_activity", "submitted_at", "modified_at", "admin4_lat",
               "total_vaccinated_as_time_visit", *_AREA_NAMES, *_MONITORING_FILLED),
    f"""
    select cast(c_custkey as varchar) as id, concat('m', c_custkey) as _airbyte_ab_id,
           {VISIT_DAY} as date_vaccination_activity, {VISIT_DAY} as submitted_at, {VISIT_DAY} + 1 as modified_at,
           cast({raw.latitude('c_custkey')} as real) as admin4_lat, cast(c_custkey % 90 as int) as total_vaccinated_as_time_visit,
           {_area_texts('c_custkey', codes={5: "(case when c_custkey % 13 = 0 then 'unknown' else cast(c_custkey as varchar) end)"})},
           {_filled(_MONITORING_FILLED)}
    from customer""",
    more={"admin4_long": f"cast({raw.longitude('c_custkey')} as real)", "enumerator": "c_mktsegment",
        "vaccine_label": "concat('vaccine ', c_nationkey % 3)", "hc_target": "cast(c_custkey % 120 as varchar)",
        "_airbyte_emitted_at": f"cast({VISIT_DAY} as varchar)",
        "vaccination_team_info": json_group(MONITORING, raw.TEAMS, raw.monitoring_elements())},
    typed={"vaccination_teams_no": "int", "start": "timestamp", "end": "timestamp", "today": "date"})
_clean("rapid_coverage", "o_orderkey",
    ("id", "_airbyte_ab_id", "rca_date", "doors_visited", "rca_mop_up", "conducted_by", "vaccine_administered",
               "submitted_at", "modified_at", *_AREA_NAMES, *[c for _, c in INFORMATION_SOURCES]),
    f"""
    select cast(o_orderkey as varchar) as id, concat('c', o_orderkey) as _airbyte_ab_id,
           cast({ORDER_DAY} as varchar) as rca_date, cast(o_orderkey % 30 as int) as doors_visited,
           case when o_orderkey % 3 = 0 then 'Yes' else 'No' end as rca_mop_up, o_orderstatus as conducted_by,
           o_orderpriority as vaccine_administered, {stamps(ORDER_DAY)}, {_area_texts('o_custkey')},
           {_filled({c: f"cast({raw.source_cell(c)} as {'varchar' if c == 'health_workers' else 'int'})"
                     for _, c in INFORMATION_SOURCES})}
    from orders""",
    more={"enumerator": "concat('enumerator ', o_orderkey % 17)", "_airbyte_emitted_at": f"cast({ORDER_DAY} as varchar)",
        "admin4_lat": raw.text(raw.latitude("o_custkey")), "admin4_long": raw.text(raw.longitude("o_custkey")),
        "vaccination": json_group(RAPID_COVERAGE, raw.repeat_length("o_orderkey"), raw.rapid_coverage_elements(), nulls=True)},
    typed={"total_unvaccinated": "int", "vaccinated_total": "int", "sources_total": "int"})
_clean("activity", "o_orderkey",
    ("id", "_airbyte_ab_id", "date_vaccination_activity", "vaccine_label", "vials_used", "vial_dosage",
               "vials_discarded", "admin4_lat", "admin4_long", "submitted_at", "modified_at", *_AREA_NAMES),
    f"""
    select cast(o_orderkey as varchar) as id, concat('r', o_orderkey) as _airbyte_ab_id,
           {ORDER_DAY} as date_vaccination_activity, o_orderpriority as vaccine_label, {raw.VIALS_USED} as vials_used,
           {raw.VIAL_DOSAGE} as vial_dosage, {raw.VIALS_DISCARDED} as vials_discarded,
           {raw.latitude('o_custkey')} as admin4_lat, {raw.longitude('o_custkey')} as admin4_long,
           {stamps(ORDER_DAY)}, {_area_texts('o_custkey')}
    from orders""",
    more={"enumerator": "concat('enumerator ', o_orderkey % 17)",
        "vaccine": json_group(ACTIVITY, raw.repeat_length("o_orderkey"), raw.activity_elements())})
_clean("target", "o_custkey",
    ("id", "vaccine_label", "campaign_start_date", "campaign_end_date", *_AREA_NAMES),
    f"""
    select concat(o_custkey, '-', o_orderpriority, '-', half) as id, o_orderpriority as vaccine_label,
           cast(first_day as varchar) as campaign_start_date,
           cast(first_day + {raw.CAMPAIGN_LENGTH} as varchar) as campaign_end_date, {_area_texts('o_custkey')}
    from {CAMPAIGN}""",
    more={"_airbyte_ab_id": "concat('t', o_custkey, '-', o_orderpriority, '-', half)",
        "target_children": json_group(
            TARGET, raw.repeat_length("o_custkey"),
            # one array has one type: the number landed as text becomes a number like the others
            [{**cells, "no_children": raw.target_cell(e)} for e, cells in enumerate(raw.target_elements())], nulls=True)})
_clean("social", "event_id",
    ("id", "assessment_date", "conducted_by", "submitted_at", "modified_at", *_AREA_NAMES[:4], *raw.SOCIAL_COLUMNS),
    f"""
    select cast(event_id as varchar) as id, cast({raw.EVENT_DAY} as varchar) as assessment_date,
           {raw.SOCIAL_CONDUCTED_BY} as conducted_by, {stamps(raw.EVENT_DAY)}, {_area_texts('user_id', 4)},
           {_filled({c: f"cast({raw.social_cell(c)} as varchar)" for c in raw.SOCIAL_COLUMNS})}
    from events""",
    more={"enumerator": "concat('enumerator ', event_id % 17)", "conducted_by_other": "concat('team ', user_id % 9)",
        "refusals": json_group(FORMS["social"], raw.REFUSAL_ROWS, raw.social_elements())})


# ---------------------------------------------------------------- public tables that rename a staged one

_mart("public_ready_facilities", "public.ready_facilities", READY_FACILITIES, ("readiness",))
_mart("public_rca_actuals", "public.rca_actuals", RCA_ACTUALS, ("rapid_coverage",))
_mart("public_rca_sources_info", "public.rca_sources_info", RCA_SOURCES, ("rapid_coverage",))
_mart("public_rca_not_vaccinated_reasons", "public.rca_not_vaccinated_reasons", RCA_REASONS, ("rapid_coverage",))
_mart("public_sia_actuals", "public.sia_actuals", SIA_ACTUALS, ("activity",))
_mart("public_aggregated_sia_actuals_target", "public.aggregated_sia_actuals_target", AGGREGATED, ("activity", "target"))
_mart("public_sia_actuals_targets", "public.sia_actuals_targets", BY_AGE_GROUP, ("activity", "target"))
_mart("public_sia_deferred_refused_reasons", "public.sia_deferred_refused_reasons", SIA_REASONS, ("activity",))
_mart("public_monitoring_tool", "public.monitoring_tool", MONITORING_TOOL, ("monitoring",))
_mart("public_monitored_facilities_overall_proportion", "public.monitored_facilities_overall_proportion",
      FACILITY_SCORES, ("monitoring",))
