"""One query per operator, on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.driver import raw_forms as raw
from fieldtally.driver.registry import query
from fieldtally.driver.raw_forms import table
from fieldtally.driver.sql import (
    AGES, CHOICES, READINESS_DICTIONARY, READINESS_SIZES, area_joins, cells, iso_code, iso_join, readiness_answers,
)
from fieldtally.forms import ACTIVITY, RAPID_COVERAGE, READINESS, SOCIAL
from fieldtally.forms.rapid_coverage import INFORMATION_SOURCES
from fieldtally.forms.readiness import DICTIONARY_NAME
from fieldtally.forms.social import MOBILIZATION, REFUSALS_ADDRESSED, RUMOURS
from fieldtally.functions import (
    complete_share, count_where, days_between, fixed_width, half_even_percent, is_yes, resolve_other, score_band, sum_where,
)
from fieldtally.operators import aggregate, ingest, lookup, publish, relate, repeat, reshape
from fieldtally.sources import rename_choices, spine_between

ORDER_DAY = raw.ORDER_DAY


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the day as a date."""
    return table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


def coded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the text codes of their five areas."""
    codes = {f"admin{i}": F.expr(raw.text(raw.area_code("o_custkey", i))) for i in raw.AREAS}
    return orders(spark, sf_dir).select("o_orderkey", *[c.alias(n) for n, c in codes.items()])


# ---------------------------------------------------------------- sources and publishing

@query("choice_labels", """
    select 'facility' as question, cast(c_custkey as varchar) as code, c_name as label from customer""")
def choice_labels(spark, sf_dir):
    choices = table(spark, sf_dir, "customer").selectExpr(
        "'facility' as field", "cast(c_custkey as string) as value", "c_name as label")
    return rename_choices(choices)


@query("dim_scan", " union all ".join(
    f"select {level} as level, cast({key} as varchar) as name, {label} as label from {name}"
    for level, (name, key, label, _) in raw.AREAS.items()))
def dim_scan(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    return reshape.union_positional(*[
        area.select(F.lit(level).alias("level"), F.col("name").cast("string").alias("name"), "label")
        for level, area in dims.areas.items()
    ])


@query("date_spine", """
    select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
                                       interval 1 day)) as date) as date from orders""")
def date_spine(spark, sf_dir):
    return spine_between(orders(spark, sf_dir), "day")


@query("bi_projection", """
    select o_orderkey as submission_id, o_orderpriority as vaccine_administered,
           cast(o_orderdate as date) as submitted_at from orders""")
def bi_projection(spark, sf_dir):
    staged = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as submission_id", "o_orderpriority as vaccine_administered", "o_orderdate as submitted_at",
        "o_totalprice as unused")
    return publish.bi_projection(staged, ("submission_id", "vaccine_administered", "submitted_at"), ("submitted_at",))


@query("publish_view", "select o_custkey, count(*) as submissions from orders group by o_custkey")
def publish_view(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("submissions"))
    return publish.publish(counts, "staging.submissions_per_facility")


# ---------------------------------------------------------------- clean forms

@query("degroup_fields", f"""
    select cast(o_orderkey as varchar) as id, concat('r', o_orderkey) as _airbyte_ab_id,
           cast({raw.area_code('o_custkey', 1)} as varchar) as admin1, cast(o_custkey as varchar) as admin5,
           {raw.VIALS_USED} as vials_used, o_orderpriority as vaccine_label,
           concat(cast({ORDER_DAY} as varchar), 'T08:30:00+02:00') as submitted_at
    from orders""")
def degroup_fields(spark, sf_dir):
    form = ingest.strip_group_prefix(raw.activity(spark, sf_dir), ACTIVITY.groups)
    return form.select("id", "_airbyte_ab_id", "admin1", "admin5", "vials_used", "vaccine_label", "submitted_at")


@query("typed_cast", f"""
    select cast(o_orderkey as varchar) as id, {ORDER_DAY} as date_vaccination_activity,
           cast({ORDER_DAY} as timestamp) + interval '8 hours 30 minutes' as submitted_at,
           cast({ORDER_DAY} as timestamp) + interval '17 hours 45 minutes 10 seconds' as modified_at,
           {raw.latitude('o_custkey')} as admin4_lat, {raw.VIALS_USED} as vials_used
    from orders""")
def typed_cast(spark, sf_dir):
    form = ingest.clean_form(raw.activity(spark, sf_dir), ACTIVITY)
    return form.select("id", "date_vaccination_activity", "submitted_at", "modified_at", "admin4_lat", "vials_used")


@query("typed_cast_lenient", """
    select event_id, try_cast(regexp_replace(props, '[^0-9]', '', 'g') as bigint) as number,
           try_cast(event_type as bigint) as malformed from events""")
def typed_cast_lenient(spark, sf_dir):
    landed = table(spark, sf_dir, "events").selectExpr(
        "event_id", "regexp_replace(props, '[^0-9]', '') as number", "event_type as malformed")
    types = {"event_id": "bigint", "number": "bigint", "malformed": "bigint"}
    return ingest.apply_types(landed, types, on_error="null")


@query("constant_columns", f"""
    select event_id, '{REFUSALS_ADDRESSED}' as indicators_category, cast(null as varchar) as vaccine_label from events""")
def constant_columns(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.lit(REFUSALS_ADDRESSED).alias("indicators_category"),
        F.lit(None).cast("string").alias("vaccine_label"))


@query("other_specify", f"""
    select cast(event_id as varchar) as id,
           case when {raw.SOCIAL_CONDUCTED_BY} = 'others' then concat('team ', user_id % 9)
                else {raw.SOCIAL_CONDUCTED_BY} end as conducted_by
    from events""")
def other_specify(spark, sf_dir):
    form = ingest.clean_form(raw.social(spark, sf_dir), SOCIAL)
    return form.select("id", resolve_other("conducted_by", "conducted_by_other").alias("conducted_by"))


@query("fixed_width", "select c_custkey, substring(c_name, 1, 12) as label from customer")
def fixed_width_text(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", fixed_width("c_name", 12).alias("label"))


# ---------------------------------------------------------------- reshaping

SOURCE_CELLS = cells(("sources_info", "no_doors"), [
    (f"'{label}'", f"cast({raw.source_cell(column)} as bigint)") for label, column in INFORMATION_SOURCES])


def _doors(spark, sf_dir) -> DataFrame:
    form = ingest.clean_form(raw.rapid_coverage(spark, sf_dir), RAPID_COVERAGE)
    return reshape.unpivot_pairs(form, ["id"], INFORMATION_SOURCES, "sources_info", "no_doors", cast="bigint")


@query("unpivot_pairs", f"select cast(o_orderkey as varchar) as id, {SOURCE_CELLS} from orders")
def unpivot_pairs(spark, sf_dir):
    return _doors(spark, sf_dir)


@query("drop_unanswered", f"""
    select * from (select cast(o_orderkey as varchar) as id, {SOURCE_CELLS} from orders) where no_doors is not null""")
def drop_unanswered(spark, sf_dir):
    return reshape.drop_unanswered(_doors(spark, sf_dir), "no_doors")


def _answers(spark, sf_dir) -> DataFrame:
    form = ingest.clean_form(raw.readiness(spark, sf_dir), READINESS)
    return reshape.unpivot_questions(form, ["id"], READINESS.questions)


@query("unpivot_questions", f"""
    select cast(c_custkey as varchar) as id, {readiness_answers()} from customer""")
def unpivot_questions(spark, sf_dir):
    return _answers(spark, sf_dir)


@query("unpivot_crosstab", "select l_orderkey, l_linenumber, " + cells(("status", "sex", "children"), [
    ("'Vaccinated'", "'Males'", "cast(l_quantity as bigint)"),
    ("'Vaccinated'", "'Females'", "cast(l_quantity as bigint) + l_linenumber"),
    ("'Refused'", "'Males'", "cast(l_linenumber as bigint)"),
    ("'Refused'", "'Females'", "cast(l_suppkey as bigint)"),
]) + " from lineitem")
def unpivot_crosstab(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_quantity as bigint) as vaccinated_males",
        "cast(l_quantity as bigint) + l_linenumber as vaccinated_females", "l_linenumber as refused_males",
        "l_suppkey as refused_females")
    table_cells = [(status, sex, f"{status}_{sex}".lower())
                   for status in ("Vaccinated", "Refused") for sex in ("Males", "Females")]
    return reshape.unpivot_crosstab(wide, ["l_orderkey", "l_linenumber"], table_cells, ("status", "sex", "children"))


@query("union_all", """
    select o_orderkey as id, o_orderpriority as indicators_category, cast(o_orderkey % 9 as bigint) as indicators_value from orders
    union all
    select event_id, event_type, cast(event_id % 7 as bigint) from events""")
def union_all(spark, sf_dir):
    first = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id", "o_orderpriority as indicators_category", "o_orderkey % 9 as indicators_value")
    second = table(spark, sf_dir, "events").selectExpr(
        "event_id as parent_id", "event_type as indicator_category", "event_id % 7 as indicator_value")
    return reshape.union_positional(first, second)


# ---------------------------------------------------------------- repeat groups

@query("repeat_explode", f"""
    select concat('r', o_orderkey) as _airbyte_ab_id, cast(e + 1 as varchar) as pos, age as age_group_label
    from orders, {AGES} where e < {raw.repeat_length('o_orderkey')}""")
def repeat_explode(spark, sf_dir):
    return repeat.explode_repeat(
        raw.activity(spark, sf_dir).withColumnRenamed("_airbyte_raw_id", "_airbyte_ab_id"),
        ACTIVITY.repeat.column, ACTIVITY.repeat.path, {"pos": "string", "age_group_label": "string"}, ["_airbyte_ab_id"])


@query("repeat_text_field", f"""
    select concat('c', o_orderkey) as _airbyte_ab_id, age as age_group_label,
           cast({raw.child_cell('present_males', 'e')} as varchar) as present_males,
           cast({raw.reason_cell('reason_3', 'e')} as varchar) as reason_3
    from orders, {AGES} where e < {raw.repeat_length('o_orderkey')}""")
def repeat_text_field(spark, sf_dir):
    form = ingest.clean_form(raw.rapid_coverage(spark, sf_dir), RAPID_COVERAGE)
    rows = repeat.explode_group(form, RAPID_COVERAGE.repeat, ["_airbyte_ab_id"],
                                only=("age_group_label", "present_males", "reason_3"), column="vaccination")
    return rows.select("_airbyte_ab_id", "age_group_label", "present_males", "reason_3")


TYPED_FIELDS = ("vaccinated_males", "deferred_females", "refused_males", "deferred_reason_2", "refused_other")


@query("repeat_typed_field", f"""
    select concat('r', o_orderkey) as _airbyte_ab_id, cast(e + 1 as varchar) as pos,
           {', '.join(f"cast({raw.activity_cell(f, 'e')} as bigint) as {f}" for f in TYPED_FIELDS)}
    from orders, {AGES} where e < {raw.repeat_length('o_orderkey')}""")
def repeat_typed_field(spark, sf_dir):
    form = ingest.clean_form(raw.activity(spark, sf_dir), ACTIVITY)
    return repeat.explode_group(form, ACTIVITY.repeat, ["_airbyte_ab_id"], only=("pos", *TYPED_FIELDS), column="vaccine")


@query("repeat_constant", f"""
    select cast(event_id as varchar) as id, '{REFUSALS_ADDRESSED}' as indicator_category,
           cast({raw.refusal_cell('e')} as varchar) as indicator_value
    from events, {AGES} where e < {raw.REFUSAL_ROWS}""")
def repeat_constant(spark, sf_dir):
    form = ingest.clean_form(raw.social(spark, sf_dir), SOCIAL)
    rows = repeat.explode_group(form, SOCIAL.repeat, ["id"], only=("refusals_addressed",), column="refusals")
    return rows.select("id", F.lit(REFUSALS_ADDRESSED).alias("indicator_category"),
                       F.col("refusals_addressed").alias("indicator_value"))


@query("select_multiple", """
    select event_id, trim(unnest(string_split(regexp_replace(props, '[\\[\\]"]', '', 'g'), ' '))) as option from events""")
def select_multiple(spark, sf_dir):
    return repeat.explode_select_multiple(table(spark, sf_dir, "events"), "props", ["event_id"], "option")


@query("text_cleanup", """
    select doc_id, trim(regexp_replace(text, '[\\[\\]"]', '', 'g'), ' ') as text from documents""")
def text_cleanup(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.trim(F.regexp_replace("text", r'[\[\]"]', "")).alias("text"))


# ---------------------------------------------------------------- lookups

@query("admin_lookup", f"""
    select o_orderkey, a1.r_name as admin1, a2.n_name as admin2, a3.s_name as admin3, a4.p_name as admin4,
           a5.c_name as admin5
    from orders {area_joins('o_custkey')}""")
def admin_lookup(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    return lookup.admin_lookup(coded_orders(spark, sf_dir), dims.areas, spread_by=["o_orderkey"])


@query("admin_lookup_codes", f"""
    select o_orderkey, a5.c_name as admin5, cast(o_custkey as varchar) as admin5_code
    from orders {area_joins('o_custkey', levels=(5,))}""")
def admin_lookup_codes(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    base = coded_orders(spark, sf_dir).select("o_orderkey", "admin5")
    return lookup.admin_lookup(base, dims.areas, levels=(5,), keep_codes=True, spread_by=["o_orderkey"])


@query("choice_lookup", f"""
    select o_orderkey, v.label as vaccine_administered, c.label as conducted_by
    from orders
    left join {CHOICES} v on v.code = o_orderpriority and v.question = 'vaccine_administered'
    left join {CHOICES} c on c.code = o_orderstatus and c.question = 'conducted_by'""")
def choice_lookup(spark, sf_dir):
    labels = rename_choices(raw.choices(spark))
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    named = lookup.choice_lookup(facts, labels, "vaccine_administered", "o_orderpriority", "vaccine_administered")
    named = lookup.choice_lookup(named, labels, "conducted_by", "o_orderstatus", "conducted_by")
    return named.select("o_orderkey", "vaccine_administered", "conducted_by")


@query("indicator_lookup", f"""
    select a.*, d.label as indicators_label, d.category as indicators_category
    from (select cast(c_custkey as varchar) as id, {readiness_answers()} from customer) a
    left join {READINESS_DICTIONARY} d on d.name = a.indicator_name""")
def indicator_lookup(spark, sf_dir):
    return lookup.indicator_lookup(
        _answers(spark, sf_dir), raw.dimensions(spark, sf_dir).indicators, DICTIONARY_NAME)


@query("question_count", f"""
    select a.id, a.indicator_name, d.category as indicators_category, q.n as no_of_questions
    from (select cast(c_custkey as varchar) as id, {readiness_answers()} from customer) a
    left join {READINESS_DICTIONARY} d on d.name = a.indicator_name
    left join {READINESS_SIZES} q on q.category = d.category""")
def question_count(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    named = lookup.indicator_lookup(_answers(spark, sf_dir), dims.indicators, DICTIONARY_NAME)
    return lookup.question_count_lookup(named, dims.readiness_questions).select(
        "id", "indicator_name", "indicators_category", "no_of_questions")


@query("iso_by_code", f"""
    select o_orderkey, a2.n_name as admin2, {iso_code()} as iso2_code
    from orders {area_joins('o_custkey', levels=(2,))} {iso_join()}""")
def iso_by_code(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    base = coded_orders(spark, sf_dir).select("o_orderkey", "admin2")
    return lookup.admin_lookup(base, dims.areas, levels=(2,), iso=dims.iso, spread_by=["o_orderkey"])


@query("iso_by_label", f"""
    select o_orderkey, a2.n_name as admin2, {iso_code()} as iso2_code
    from orders {area_joins('o_custkey', levels=(2,))}
    left join nation iso on iso.n_name = a2.n_name and iso.n_nationkey % {raw.ISO_GAP} <> 0""")
def iso_by_label(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    base = coded_orders(spark, sf_dir).select("o_orderkey", "admin2")
    named = lookup.admin_lookup(base, dims.areas, levels=(2,), spread_by=["o_orderkey"])
    return lookup.iso_lookup(named, dims.iso, "admin2", on="province_label")


@query("require_label", f"""
    select o_orderkey, a3.s_name as admin3 from orders {area_joins('o_custkey', levels=(3,))}
    where a3.s_name is not null""")
def require_label(spark, sf_dir):
    dims = raw.dimensions(spark, sf_dir)
    base = coded_orders(spark, sf_dir).select("o_orderkey", "admin3")
    named = lookup.admin_lookup(base, dims.areas, levels=(3,), spread_by=["o_orderkey"])
    return lookup.require_label(named, "admin3")


# ---------------------------------------------------------------- relations

@query("attach_parent", """
    select l_orderkey, l_linenumber, l_quantity, o_orderpriority, o_custkey
    from lineitem left join orders on l_orderkey = o_orderkey""")
def attach_parent(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return relate.attach_parent(child, table(spark, sf_dir, "orders"), ("l_orderkey", "o_orderkey"),
                                ["o_orderpriority", "o_custkey"])


@query("attach_children", """
    select o_orderkey, o_orderpriority, l_linenumber, l_quantity
    from orders left join lineitem on l_orderkey = o_orderkey""")
def attach_children(spark, sf_dir):
    parent = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return relate.attach_children(parent, table(spark, sf_dir, "lineitem"), ("o_orderkey", "l_orderkey"),
                                  ["l_linenumber", "l_quantity"])


@query("reattach_submission", """
    select l_orderkey as id, l_returnflag as indicators_category, o_orderstatus, cast(o_orderdate as date) as day
    from lineitem left join orders on cast(l_orderkey as varchar) = cast(o_orderkey as varchar)""")
def reattach_submission(spark, sf_dir):
    long = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as id", "l_returnflag as indicators_category", "cast(l_orderkey as string) as text_id")
    form = orders(spark, sf_dir).withColumn("text_key", F.col("o_orderkey").cast("string"))
    return relate.attach_parent(long, form, ("text_id", "text_key"), ["o_orderstatus", "day"]).drop("text_id")


SPINE = ("1996-02-01", "2000-10-31")


@query("spine_join", f"""
    select d.date, o_orderkey, o_custkey
    from (select cast(unnest(generate_series(date '{SPINE[0]}', date '{SPINE[1]}', interval 1 day)) as date) as date) d
    left join orders on cast(o_orderdate as date) = d.date where o_orderkey is not null""")
def spine_join(spark, sf_dir):
    from fieldtally.sources import date_spine as listed_days

    facts = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    return relate.on_spine(listed_days(spark, *SPINE), facts, "day").drop("day")


@query("asof_cutoff", f"""
    select o_orderkey, {ORDER_DAY} as day from orders where {ORDER_DAY} <= date '{raw.AS_OF}'""")
def asof_cutoff(spark, sf_dir):
    return relate.cutoff(orders(spark, sf_dir).select("o_orderkey", "day"), "day", raw.AS_OF)


@query("campaign_window", f"""
    with campaign as ({raw.CAMPAIGNS_SQL.format(orders='orders')})
    select o_orderkey, o.o_custkey, o.o_orderpriority, {ORDER_DAY} as day, c.first_day as campaign_start_date,
           cast(c.n * 100 as bigint) as campaign_target
    from orders o left join campaign c
      on c.o_custkey = o.o_custkey and c.o_orderpriority = o.o_orderpriority
     and {ORDER_DAY} between c.first_day and c.first_day + {raw.CAMPAIGN_LENGTH}""")
def campaign_window(spark, sf_dir):
    facts = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority", "day")
    goals = raw.campaigns(spark, sf_dir).selectExpr(
        "o_custkey as facility", "o_orderpriority as vaccine", "first_day as campaign_start_date",
        f"first_day + {raw.CAMPAIGN_LENGTH} as campaign_end_date", "n * 100 as campaign_target")
    joined = relate.campaign_window_join(
        facts, goals, [("o_custkey", "facility"), ("o_orderpriority", "vaccine")], "day",
        "campaign_start_date", "campaign_end_date", spread_by=["o_orderkey"])
    return joined.drop("facility", "vaccine", "campaign_end_date")


@query("campaign_days", f"""
    with campaign as ({raw.CAMPAIGNS_SQL.format(orders='orders')})
    select o_custkey, o_orderpriority, half, cast(first_day + cast(n as int) - first_day as int) as campaign_days from campaign""")
def campaign_days(spark, sf_dir):
    spans = raw.campaigns(spark, sf_dir).withColumn("last_day", F.expr("first_day + cast(n as int)"))
    return spans.select("o_custkey", "o_orderpriority", "half",
                        days_between("last_day", "first_day").alias("campaign_days"))


@query("dose_join", """
    with visits as (
        select cast(o_orderdate as date) as day, o_custkey % 50 as facility, o_orderpriority as vaccine,
               count(*) as submissions
        from orders group by all),
    vials as (
        select cast(l_shipdate as date) as day, l_suppkey % 50 as facility, concat(l_linenumber % 5 + 1, l_returnflag) as kind,
               cast(sum(l_linenumber) as bigint) as vials_used
        from lineitem group by all)
    select v.day, v.facility, v.vaccine, v.submissions, d.vials_used
    from visits v left join vials d on d.day = v.day and d.facility = v.facility and d.kind = substring(v.vaccine, 1, 1) || 'R'""")
def dose_join(spark, sf_dir):
    visits = orders(spark, sf_dir).withColumns(
        {"facility": F.expr("o_custkey % 50"), "kind": F.expr("concat(substring(o_orderpriority, 1, 1), 'R')")}
    ).groupBy("day", "facility", F.col("o_orderpriority").alias("vaccine"), "kind").agg(F.count("*").alias("submissions"))
    vials = aggregate.sums(
        table(spark, sf_dir, "lineitem").selectExpr(
            "cast(l_shipdate as date) as ship_day", "l_suppkey % 50 as ship_facility",
            "concat(l_linenumber % 5 + 1, l_returnflag) as ship_kind", "cast(l_linenumber as bigint) as vials"),
        ["ship_day", "ship_facility", "ship_kind"], {"vials_used": "vials"})
    from fieldtally.operators.join import sized_join

    joined = sized_join(visits, vials, [("day", "ship_day"), ("facility", "ship_facility"), ("kind", "ship_kind")], hot=None)
    return joined.select("day", "facility", "vaccine", "submissions", "vials_used")


@query("latest_per_key", """
    select o_orderkey, o.o_custkey, cast(o_orderdate as date) as day from orders o
    join (select o_custkey, max(o_orderdate) as latest from orders group by o_custkey) l
      on l.o_custkey = o.o_custkey and l.latest = o.o_orderdate""")
def latest_per_key(spark, sf_dir):
    facts = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    return relate.latest_per_key(facts, "o_custkey", "day", spread_by=["o_orderkey"])


@query("attach_latest", """
    select o_orderkey, o_custkey,
           case when cast(o_orderdate as date) = max(cast(o_orderdate as date)) over (partition by o_custkey)
                then cast(o_orderdate as date) end as latest_assessment
    from orders""")
def attach_latest(spark, sf_dir):
    facts = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    return relate.attach_latest(facts, "o_custkey", "day", "latest_assessment", spread_by=["o_orderkey"]).drop("day")


@query("aggregate_join_back", """
    select cast(o_orderkey as varchar) as id, o_orderstatus, r.total_returned
    from orders left join (
        select l_orderkey, cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag = 'R') as bigint) as total_returned
        from lineitem group by l_orderkey) r on r.l_orderkey = o_orderkey""")
def aggregate_join_back(spark, sf_dir):
    totals = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        sum_where(F.col("l_quantity").cast("bigint"), F.col("l_returnflag") == "R").alias("total_returned"))
    detail = table(spark, sf_dir, "orders").selectExpr("cast(o_orderkey as string) as id", "o_orderstatus")
    return relate.join_back(detail, totals, ("id", "l_orderkey"))


# ---------------------------------------------------------------- aggregates and scores

def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey", "cast(l_shipdate as date) as day", "l_returnflag", "l_linestatus", "l_orderkey",
        "l_linenumber", "cast(l_quantity as bigint) as quantity")


@query("grouped_sum", """
    select l_suppkey, l_returnflag, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem group by all""")
def grouped_sum(spark, sf_dir):
    return aggregate.sums(_lines(spark, sf_dir), ["l_suppkey", "l_returnflag"], {"total": "quantity"})


@query("sum_filter", """
    select l_orderkey,
           cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag in ('A', 'R')) as bigint) as total
    from lineitem group by l_orderkey""")
def sum_filter(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_orderkey").agg(
        sum_where("quantity", F.col("l_returnflag").isin("A", "R")).alias("total"))


@query("count_filter", """
    select l_orderkey, count(l_linenumber) filter (where l_returnflag = 'R') as total from lineitem group by l_orderkey""")
def count_filter(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_orderkey").agg(
        count_where("l_linenumber", F.col("l_returnflag") == "R").alias("total"))


@query("pivot_sums", """
    select l_suppkey, cast(l_shipdate as date) as day,
           cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag = 'A') as bigint) as total_a,
           cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag = 'N') as bigint) as total_n,
           cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag = 'R') as bigint) as total_r,
           cast(sum(cast(l_quantity as bigint)) filter (where l_returnflag in ('A', 'N')) as bigint) as total_kept
    from lineitem group by all""")
def pivot_sums(spark, sf_dir):
    outputs = {"total_a": ["A"], "total_n": ["N"], "total_r": ["R"], "total_kept": ["A", "N"]}
    return aggregate.pivot_sums(_lines(spark, sf_dir), ["l_suppkey", "day"], outputs, "l_returnflag", "quantity")


@query("dose_rollup", """
    select l_suppkey, l_returnflag, cast(max(l_linenumber) as varchar) as vial_dosage,
           cast(sum(cast(l_quantity as bigint)) as bigint) as vials_used,
           cast(sum(l_linenumber * cast(l_quantity as bigint)) as bigint) as vaccine_dose
    from lineitem group by all""")
def dose_rollup(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_suppkey", "l_returnflag").agg(
        F.max("l_linenumber").cast("string").alias("vial_dosage"),
        F.sum("quantity").alias("vials_used"),
        F.sum(F.col("l_linenumber") * F.col("quantity")).alias("vaccine_dose"))


@query("case_sum", """
    select o_custkey, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as complete
    from orders group by o_custkey""")
def case_sum(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("complete"))


VISIT_CATEGORIES = """(
    select o_custkey as id, o_orderpriority as indicators_category, 2 as no_of_questions,
           count(o_orderkey) filter (where o_orderstatus = 'F') as yes_count,
           cast(count(o_orderkey) filter (where o_orderstatus = 'F') as double) / cast(2 as double) as yes_category_proportion
    from orders group by all)"""
SHARE = "cast(sum(case when yes_category_proportion = 1 then 1 else 0 end) as double)"
BAND = """case when {0} >= 0 and {0} < 50 then '<50%' when {0} >= 50 and {0} <= 99 then '50-99%'
          when {0} = 100 then '100%' end"""


def _proportions(spark, sf_dir) -> DataFrame:
    """Customers as visits, order priorities as categories of two questions, status F as yes."""
    answers = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as id", "o_orderkey", "o_orderpriority as indicators_category", "2 as no_of_questions",
        "case when o_orderstatus = 'F' then 'Yes' else 'No' end as indicators_value")
    return aggregate.category_proportion(answers, ["id"], counted="o_orderkey")


@query("category_proportion", f"select * from {VISIT_CATEGORIES}")
def category_proportion(spark, sf_dir):
    return _proportions(spark, sf_dir)


@query("readiness_score", f"""
    select id, cast(total as double) / cast(2 as double) as readiness_value, case when total = 10 then 'Yes' else 'No' end as facility_ready,
           category_value, {BAND.format('category_value')} as category_label
    from (select id, sum(yes_count) as total, cast(round_even({SHARE} / 5 * 100, 0) as int) as category_value
          from {VISIT_CATEGORIES} group by id)""")
def readiness_score(spark, sf_dir):
    return aggregate.readiness_score(_proportions(spark, sf_dir), ["id"], categories=5)


@query("monitoring_score", f"""
    select id, p as overall_facility_proportion, {BAND.format('p')} as overall_proportion_category
    from (select id, {SHARE} / 3 * 100 as p from {VISIT_CATEGORIES} group by id)""")
def monitoring_score(spark, sf_dir):
    return aggregate.monitoring_score(_proportions(spark, sf_dir), ["id"], categories=3)


@query("half_even_percent", """
    select o_orderkey, cast(round_even(cast(o_orderkey % 9 as double) / 8 * 100, 0) as int) as percent from orders""")
def half_even(spark, sf_dir):
    share = F.expr("cast(o_orderkey % 9 as double) / 8 * 100")
    return table(spark, sf_dir, "orders").select("o_orderkey", half_even_percent(share).alias("percent"))


@query("score_band", f"""
    select p_partkey, {BAND.format('p')} as band
    from (select p_partkey, case when p_partkey % 11 = 0 then null else cast(p_partkey % 220 as double) / 2 end as p from part)""")
def score_bands(spark, sf_dir):
    scored = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "case when p_partkey % 11 = 0 then null else cast(p_partkey % 220 as double) / 2 end as p")
    return scored.select("p_partkey", score_band("p").alias("band"))
