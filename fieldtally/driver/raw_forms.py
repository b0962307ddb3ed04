"""The driver tables shaped as landed forms, with the same formulas as SQL text for checking.

Every formula is an SQL expression that Spark and DuckDB both read, so a query and its check start from
the same values but reach the result on different ways: Spark through landed text and JSON repeat
groups, the check from plain columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.forms import ACTIVITY, MONITORING, RAPID_COVERAGE, READINESS, SOCIAL, TARGET, FormSpec
from fieldtally.forms.monitoring import DICTIONARY_NAME as MONITORING_NAME
from fieldtally.forms.readiness import DICTIONARY_NAME as READINESS_NAME
from fieldtally.forms.rapid_coverage import INFORMATION_SOURCES
from fieldtally.forms.social import MOBILIZATION, RUMOURS
from fieldtally.operators.join import estimated_bytes
from fieldtally.operators.repeat import short_name
from fieldtally.plans.dims import Dimensions
from fieldtally.plans.warehouse import Inputs
from fieldtally.sources import spine_between

AGE_GROUPS = ("0-11 months", "12-59 months", "5-14 years")
AS_OF = "2001-03-31"

# Area level -> (table, key, label, number of distinct codes the forms use).
AREAS = {
    1: ("region", "r_regionkey", "r_name", 6),
    2: ("nation", "n_nationkey", "n_name", 26),
    3: ("supplier", "s_suppkey", "s_name", 110),
    4: ("part", "p_partkey", "p_name", 2100),
    5: ("customer", "c_custkey", "c_name", None),
}
# Nations without an ISO code.
ISO_GAP = 6


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a table's files that one task makes forms from.
SPREAD_BYTES = 16 << 20


def submissions(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become submissions, dealt over the cores and over more tasks as it grows.

    A file is read in as many tasks as it has row groups, often one; a form makes a hundred columns and a table up to a
    hundred rows of each row read. The shuffle is of the columns that are used, below which filters still reach the scan.
    """
    rows = table(spark, sf_dir, name)
    return rows.repartition(max(2 * spark.sparkContext.defaultParallelism, (estimated_bytes(rows) or 0) // SPREAD_BYTES))


# ---------------------------------------------------------------- formulas

def area_code(place: str, level: int) -> str:
    size = AREAS[level][3]
    return place if size is None else f"({place} % {size})"


def repeat_length(key: str) -> str:
    """Rows of a repeat group: 0 to 3, NULL where the group was left out."""
    return f"case when {key} % 40 = 0 then null else cast({key} % 4 as int) end"


def count_cell(key: str, column: int, element: int | str, gap: int = 7) -> str:
    """A count with gaps."""
    return (
        f"case when ({key} + {column} + {element}) % {gap} = 0 then null "
        f"else ({key} * {column + 3} + {element} * 11 + {column}) % 23 end"
    )


def sparse_cell(key: str, column: int, element: int | str) -> str:
    """A count that is mostly left out."""
    return f"case when ({key} + {column} + {element}) % 9 = 0 then ({key} + {column}) % 5 + {element} end"


def answer_cell(key: str, number: int, category: int, categories: int) -> str:
    """A yes/no answer: a submission completes the categories up to its own level, with a few gaps."""
    return (
        f"case when ({key} + {3 * number}) % 101 = 0 then null "
        f"when {key} % {categories + 1} > {category} or ({key} + {number}) % 3 = 0 then 'Yes' else 'No' end"
    )


def remark_cell(key: str, number: int) -> str:
    return f"case when ({key} + {number}) % 4 = 0 then 'note {number}' end"


def latitude(key: str) -> str:
    return f"cast({key} % 10 as double) + 0.25"


def longitude(key: str) -> str:
    return f"cast({key} % 6 as double) + 0.5"


def visit_day(key: str) -> str:
    return f"date '2024-01-01' + cast({key} * 7 % 60 as int)"


def text(expression: str) -> str:
    return f"cast({expression} as string)"


# ---------------------------------------------------------------- landing

def filler(spec: FormSpec, landed_name: str, key: str) -> str:
    """A value for a column that no table needs: text with gaps, or what its type takes."""
    number = spec.landed_columns().index(landed_name)
    clean = next((to for name, _, to in spec.clean_columns() if name == landed_name), "string")
    kind = spec.landed_types.get(landed_name, clean)
    values = {
        "int": f"cast(({key} + {number}) % 19 as int)",
        "double": f"cast(({key} + {number}) % 9 as double) + 0.5",
        "float": f"cast(({key} + {number}) % 9 as double) + 0.5",
        "date": f"date '2024-02-01' + cast(({key} + {number}) % 25 as int)",
        "timestamp_ntz": f"concat(cast(date '2024-02-01' + cast(({key} + {number}) % 25 as int) as string), ' 09:30:00')",
        "string": f"case when ({key} + {number}) % 3 <> 0 then concat('v{number} ', {key} % 11) end",
    }
    return values[kind]


def landed(base: DataFrame, spec: FormSpec, values: Mapping[str, str], fill: str | None = None) -> DataFrame:
    """``base`` as a landed form: ``values`` gives the columns that tables need. The others are NULL, or filled
    from the key column ``fill``."""
    unknown = set(values) - set(spec.landed_columns())
    if unknown:
        raise KeyError(f"not in form {spec.name}: {sorted(unknown)}")
    others = {c: filler(spec, c, fill) if fill else "null" for c in spec.landed_columns() if c not in values}
    return base.selectExpr(
        *[
            f"cast({values.get(c) or others[c]} as {spec.landed_types.get(c, 'string')}) as `{c}`"
            for c in spec.landed_columns()
        ]
    )


def json_group(spec: FormSpec, length: str, elements: Sequence[Mapping[str, str]], nulls: bool = False) -> str:
    """A repeat group as JSON text: the first ``length`` of ``elements`` (field path -> expression).

    Only the rows that the group has are made, one at a time: all cells of all rows in one expression make a method
    that the JVM does not compile.
    """
    structs = [
        "named_struct({})".format(", ".join(f"'{spec.repeat.key(f)}', {e}" for f, e in element.items()))
        for element in elements
    ]
    cases = " ".join(f"when {i} then {struct}" for i, struct in enumerate(structs))
    rows = f"transform(slice(array({', '.join(map(str, range(len(structs))))}), 1, {length}), e -> case e {cases} end)"
    options = ", map('ignoreNullFields', 'false')" if nulls else ""
    return f"to_json({rows}{options})"


def _areas(prefix: str, place: str, levels: int = 5) -> dict[str, str]:
    return {f"{prefix}_admin{i}": text(area_code(place, i)) for i in range(1, levels + 1)}


def _common(key: str, day: str) -> dict[str, str]:
    return {
        "_id": text(key),
        "_submission_time": f"concat({text(day)}, 'T08:30:00+02:00')",
        "_date_modified": f"concat({text(day)}, 'T17:45:10+02:00')",
    }


# ---------------------------------------------------------------- activity and target, from orders

ORDER_DAY = "cast(o_orderdate as date)"
ACTIVITY_FIELDS = {
    short_name(f): (f, i) for i, (f, to) in enumerate(
        (f, to) for f, to in ACTIVITY.repeat.fields.items()
        if to == "bigint" or f == "coverage/vaccinated_males_previously_refused"
    )
}
VIALS_USED = "case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 50 as int) end"
VIAL_DOSAGE = "cast(5 * (o_orderkey % 3 + 1) as int)"
VIALS_DISCARDED = "cast(o_orderkey % 4 as int)"


def activity_cell(field: str, element: int | str) -> str:
    """Coverage, deferral and refusal counts are dense, their reasons sparse."""
    index = ACTIVITY_FIELDS[field][1]
    sparse = "reason" in field or field.endswith("_other")
    return sparse_cell("o_orderkey", index, element) if sparse else count_cell("o_orderkey", index, element)


def activity_elements() -> list[dict[str, str]]:
    return [
        {
            "pos": f"'{e + 1}'",
            "age_group_name": f"'g{e}'",
            "age_group_label": f"'{label}'",
            # Every second count is landed as a quoted number.
            **{
                path: activity_cell(name, e) if i % 2 else text(activity_cell(name, e))
                for name, (path, i) in ACTIVITY_FIELDS.items()
            },
        }
        for e, label in enumerate(AGE_GROUPS)
    ]


def activity(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    return landed(submissions(spark, sf_dir, "orders"), ACTIVITY, {
        **_common("o_orderkey", ORDER_DAY),
        **_areas("geographic_location", "o_custkey"),
        "_airbyte_raw_id": "concat('r', o_orderkey)",
        "campaign_activity_details_date_vaccination_activity": ORDER_DAY,
        "campaign_activity_details_enumerator": "concat('enumerator ', o_orderkey % 17)",
        "geographic_location_admin4_lat": latitude("o_custkey"),
        "geographic_location_admin4_long": longitude("o_custkey"),
        "immunization_coverage_vaccine_label": "o_orderpriority",
        "immunization_coverage_vaccine": json_group(ACTIVITY, repeat_length("o_orderkey"), activity_elements()),
        "vaccine_logistics_vials_used": VIALS_USED,
        "vaccine_logistics_vial_dosage": VIAL_DOSAGE,
        "vaccine_logistics_vials_discarded": VIALS_DISCARDED,
    }, "o_orderkey" if fill else None)


# A campaign per facility, vaccine and half of the orders: the two halves' windows often overlap.
CAMPAIGNS_SQL = """
    select o_custkey, o_orderpriority, o_orderkey % 2 as half, min(cast(o_orderdate as date)) as first_day,
           count(*) as n
    from {orders} group by o_custkey, o_orderpriority, o_orderkey % 2
"""
CAMPAIGN_LENGTH = 700


def target_cell(element: int | str) -> str:
    return f"case when (o_custkey + {element}) % 13 = 0 then null else n * 100 + {element} end"


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CAMPAIGNS_SQL.format(orders="{orders}"), orders=table(spark, sf_dir, "orders"))


def target_elements() -> list[dict[str, str]]:
    return [
        {
            "pos": f"'{e + 1}'",
            "age_group_name": f"'g{e}'",
            "age_group_label": f"'{label}'",
            "no_children": target_cell(e) if e else text(target_cell(e)),
        }
        for e, label in enumerate(AGE_GROUPS)
    ]


def target(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    return landed(campaigns(spark, sf_dir), TARGET, {
        **_areas("geographic_location", "o_custkey"),
        "_id": "concat(o_custkey, '-', o_orderpriority, '-', half)",
        "_airbyte_raw_id": "concat('t', o_custkey, '-', o_orderpriority, '-', half)",
        "immunization_campaign_details_campaign_start_date": text("first_day"),
        "immunization_campaign_details_campaign_end_date": text(f"first_day + {CAMPAIGN_LENGTH}"),
        "immunization_coverage_vaccine_label": "o_orderpriority",
        "immunization_coverage_target_children": json_group(TARGET, repeat_length("o_custkey"), target_elements(), nulls=True),
    }, "o_custkey" if fill else None)


# ---------------------------------------------------------------- rapid coverage, from orders

CHILD_FIELDS = ("present_males", "present_females", "vaccinated_males", "vaccinated_females",
                "not_vaccinated_males", "not_vaccinated_females")
REASON_FIELDS = tuple(f"reason_{i}" for i in range(1, 11)) + ("other_reasons",)


def child_cell(field: str, element: int | str) -> str:
    return count_cell("o_orderkey", CHILD_FIELDS.index(field), element, gap=5)


def reason_cell(field: str, element: int | str) -> str:
    return sparse_cell("o_orderkey", REASON_FIELDS.index(field), element)


def source_cell(column: str) -> str:
    return count_cell("o_orderkey", [c for _, c in INFORMATION_SOURCES].index(column), 0, gap=2)


def rapid_coverage_elements() -> list[dict[str, str]]:
    return [
        {
            "pos": f"'{e + 1}'",
            "age_group_name": f"'g{e}'",
            "age_group_label": f"'{label}'",
            **{f: child_cell(f, e) for f in CHILD_FIELDS},
            **{f"unvaccinated/{f}": text(reason_cell(f, e)) for f in REASON_FIELDS},
        }
        for e, label in enumerate(AGE_GROUPS)
    ]


def rapid_coverage(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    return landed(submissions(spark, sf_dir, "orders"), RAPID_COVERAGE, {
        **_common("o_orderkey", ORDER_DAY),
        **_areas("geographical_location", "o_custkey"),
        "_airbyte_raw_id": "concat('c', o_orderkey)",
        "_airbyte_extracted_at": text(ORDER_DAY),
        "assessment_details_rca_date": text(ORDER_DAY),
        "assessment_details_conducted_by": "o_orderstatus",
        "assessment_details_enumerator": "concat('enumerator ', o_orderkey % 17)",
        "rca_mop_up": "case when o_orderkey % 3 = 0 then 'Yes' else 'No' end",
        "immunization_coverage_vaccine_administered": "o_orderpriority",
        "immunization_coverage_doors_visited": "cast(o_orderkey % 30 as int)",
        "geographical_location_admin4_lat": text(latitude("o_custkey")),
        "geographical_location_admin4_long": text(longitude("o_custkey")),
        "immunization_coverage_vaccination": json_group(
            RAPID_COVERAGE, repeat_length("o_orderkey"), rapid_coverage_elements(), nulls=True),
        **{f"sources_{c}": f"cast({source_cell(c)} as int)" for _, c in INFORMATION_SOURCES},
    }, "o_orderkey" if fill else None)


# Choices of the rapid coverage form: question, code, label. One vaccine has no label.
CHOICES = (
    ("vaccine_administered", "1-URGENT", "Measles and rubella"),
    ("vaccine_administered", "2-HIGH", "Oral polio"),
    ("vaccine_administered", "3-MEDIUM", "Vitamin A"),
    ("vaccine_administered", "5-LOW", "Tetanus"),
    ("conducted_by", "F", "Ministry"),
    ("conducted_by", "O", "Partner"),
    ("conducted_by", "1-URGENT", "Not a vaccine"),
)


def small_table(spark: SparkSession, rows: Sequence[tuple], names: str) -> DataFrame:
    """A listed dimension; the optimizer knows its exact size."""
    columns = names.split()
    return spark.createDataFrame(pa.table({c: list(v) for c, v in zip(columns, zip(*rows))}))


def choices(spark: SparkSession) -> DataFrame:
    return small_table(spark, CHOICES, "field value label")


# ---------------------------------------------------------------- readiness and monitoring, from customers

READINESS_CATEGORIES = {
    "microplan": ("Microplan", 9),
    "logistics": ("Logistics and supply", 7),
    "social_mob": ("Social mobilization", 3),
    "imm_safety": ("Immunization safety", 2),
    "supervision": ("Supervision", 4),
    "reporting": ("Reporting system", 3),
    "vacc_mngt": ("Vaccine management", 3),
    "hr": ("Human resources", 1),
}
# A question the dictionary does not list.
UNLISTED = "supervision_indicator5"
READINESS_PLACES = 400
FACILITY = f"(c_custkey % {READINESS_PLACES})"


def _stem(question: str) -> str:
    return question.split("_indicator")[0]


def readiness_answer(name: str) -> str:
    if name == "vacc_mngt_indicator4":
        return readiness_remark("vacc_mngt_indicator4_remarks")
    names = [q.name for q in READINESS.questions]
    category = list(READINESS_CATEGORIES).index(_stem(name))
    return answer_cell("c_custkey", names.index(name), category, len(READINESS_CATEGORIES))


def readiness_remark(column: str) -> str:
    if column == "vacc_mngt_indicator4_remarks":
        return "case when c_custkey % 50 = 7 then 'Yes' else 'cold chain checked' end"
    return remark_cell("c_custkey", sorted(q.remark for q in READINESS.questions).index(column))


def readiness(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    answers = {q.value: readiness_answer(q.name) for q in READINESS.questions if q.name != "vacc_mngt_indicator4"}
    remarks = {q.remark: readiness_remark(q.remark) for q in READINESS.questions}
    filled = {**answers, **remarks}
    grouped = {
        f"{group}_{name}": filled[name] for group, names in READINESS.groups.items() for name in names if name in filled
    }
    return landed(submissions(spark, sf_dir, "customer"), READINESS, {
        **_common("c_custkey", visit_day("c_custkey")),
        **_areas("geographical_location", FACILITY),
        "geographical_location_admin5": f"case when c_custkey % 29 = 0 then null else {text(FACILITY)} end",
        "geographical_location_admin4_lat": text(latitude("c_custkey")),
        "geographical_location_admin4_long": text(longitude("c_custkey")),
        "assessment_details_assessment_date": text(visit_day("c_custkey")),
        "assessment_details_enumerator": "c_mktsegment",
        "assessment_details_vaccine_administered": """concat('["', lower(c_mktsegment), '" "opv"]')""",
        **grouped,
    }, "c_custkey" if fill else None)


TEAM_FIELDS = tuple(f"part3_indicator{i}" for i in range(1, 19))
MONITORING_CATEGORIES = {"part1": ("Microplan", 24), "part2": ("Vaccine management", 30), "part3": ("Vaccination site", 18)}


def monitoring_answer(name: str) -> str:
    """Visit answers; the follow-up questions are answered in numbers or not at all."""
    number = int("".join(ch for ch in name.split("indicator")[1] if ch.isdigit()))
    if name.endswith("a"):
        return f"case when c_custkey % 5 = 0 then cast(c_custkey % 7 + {number} as string) end"
    return answer_cell("c_custkey", number, list(MONITORING_CATEGORIES).index(_stem(name)), 3)


def monitoring_remark(column: str) -> str:
    number = int("".join(ch for ch in column.split("indicator")[1] if ch.isdigit()))
    return remark_cell("c_custkey", number)


def team_answer(name: str, element: int | str) -> str:
    number = TEAM_FIELDS.index(name) + 1
    return (
        f"case when (c_custkey + {number} + {element}) % 59 = 0 then null "
        f"when c_custkey % 4 > 2 or (c_custkey + {number} * {element}) % 3 = 0 then 'Yes' else 'No' end"
    )


TEAMS = "cast(c_custkey % 3 as int)"


def monitoring_elements() -> list[dict[str, str]]:
    return [
        {
            "pos": f"'{e + 1}'",
            "vt_leader": f"concat('leader ', {e})",
            **{f: team_answer(f, e) for f in TEAM_FIELDS},
            **{f"{f}_remarks": remark_cell("c_custkey", i + e) for i, f in enumerate(TEAM_FIELDS)},
        }
        for e in range(2)
    ]


def monitoring(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    columns = {q.value: monitoring_answer(q.name) for q in MONITORING.questions}
    columns |= {q.remark: monitoring_remark(q.remark) for q in MONITORING.questions}
    return landed(submissions(spark, sf_dir, "customer"), MONITORING, {
        **{f"{c.split('_')[0]}_{c}": e for c, e in columns.items()},
        **_areas("geographical_location", "c_custkey"),
        "geographical_location_admin5": f"case when c_custkey % 13 = 0 then 'unknown' else {text('c_custkey')} end",
        "geographical_location_admin4_lat": latitude("c_custkey"),
        "geographical_location_admin4_long": longitude("c_custkey"),
        "_id": text("c_custkey"),
        "_airbyte_raw_id": "concat('m', c_custkey)",
        "_airbyte_extracted_at": text(visit_day("c_custkey")),
        "_submission_time": visit_day("c_custkey"),
        "_date_modified": f"{visit_day('c_custkey')} + 1",
        "campaign_activity_details_date_vaccination_activity": visit_day("c_custkey"),
        "campaign_activity_details_enumerator": "c_mktsegment",
        "immunization_coverage_vaccine_label": "concat('vaccine ', c_nationkey % 3)",
        "immunization_coverage_total_vaccinated_as_time_visit": "cast(c_custkey % 90 as int)",
        "immunization_coverage_hc_target": text("c_custkey % 120"),
        "part3_vaccination_team_info": json_group(MONITORING, TEAMS, monitoring_elements()),
    }, "c_custkey" if fill else None)


def dictionary_rows() -> list[tuple[str, str, str, str]]:
    """Indicator dictionary: form, question, label (with stray blanks), category."""
    rows = [
        (READINESS_NAME, q.name, f" Readiness question {q.name} ", READINESS_CATEGORIES[_stem(q.name)][0])
        for q in READINESS.questions if q.name != UNLISTED
    ]
    names = [q.name for q in MONITORING.questions] + list(TEAM_FIELDS)
    rows += [(MONITORING_NAME, n, f"Monitoring question {n}", MONITORING_CATEGORIES[_stem(n)][0]) for n in names]
    # The same question name in another form must not be picked up.
    rows.append((MONITORING_NAME, "microplan_indicator1", "Other form", "Other form"))
    return rows


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    def area(level: int) -> DataFrame:
        name, key, label, _ = AREAS[level]
        return table(spark, sf_dir, name).select(F.col(key).alias("name"), F.col(label).alias("label"))

    def counts(rows: Mapping[str, tuple[str, int]]) -> DataFrame:
        return small_table(spark, list(rows.values()), "indicators_category no_of_questions").withColumn(
            "no_of_questions", F.col("no_of_questions").cast("int"))

    iso = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as admin2_id", "n_name as province_label",
        f"case when n_nationkey % {ISO_GAP} <> 0 then concat('ISO-', n_nationkey) end as iso2_code"
    )
    indicators = small_table(spark, dictionary_rows(), "form_name indicator_name indicator_label category")
    return Dimensions(
        areas={level: area(level) for level in AREAS},
        iso=iso,
        indicators=indicators,
        readiness_questions=counts(READINESS_CATEGORIES),
        monitoring_questions=counts(MONITORING_CATEGORIES),
    )


# ---------------------------------------------------------------- social mobilization, from events

EVENT_DAY = "cast(ts as date)"
SOCIAL_COLUMNS = tuple(c for _, c in RUMOURS + MOBILIZATION)
REFUSAL_ROWS = "case when event_id % 40 = 0 then null else cast(event_id % 4 as int) end"


def social_cell(column: str) -> str:
    return count_cell("event_id", SOCIAL_COLUMNS.index(column), 0, gap=6)


def refusal_cell(element: int | str) -> str:
    return count_cell("event_id", 20, element, gap=8)


def refusal_vaccine(element: int | str) -> str:
    return f"concat('vaccine ', (event_id + {element}) % 4)"


def social_elements() -> list[dict[str, str]]:
    return [
        {
            "pos": f"'{e + 1}'",
            "vaccine_name": f"'v{e}'",
            "vaccine_label": refusal_vaccine(e),
            "refusals_addressed": text(refusal_cell(e)),
        }
        for e in range(3)
    ]


def social(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    return landed(submissions(spark, sf_dir, "events"), SOCIAL, {
        **_common("event_id", EVENT_DAY),
        **_areas("geographical_location", "user_id", 4),
        "assessment_details_assessment_date": text(EVENT_DAY),
        "assessment_details_conducted_by": SOCIAL_CONDUCTED_BY,
        "assessment_details_conducted_by_other": "concat('team ', user_id % 9)",
        "assessment_details_enumerator": "concat('enumerator ', event_id % 17)",
        **{f"soc_mob_indicators_{c}": text(social_cell(c)) for c in SOCIAL_COLUMNS},
        "soc_mob_indicators_refusals": json_group(SOCIAL, REFUSAL_ROWS, social_elements()),
    }, "event_id" if fill else None)


SOCIAL_CONDUCTED_BY = "case event_type when 'error' then 'others' when 'view' then null else event_type end"


# ---------------------------------------------------------------- everything

LANDED = {
    "activity": activity,
    "target": target,
    "rapid_coverage": rapid_coverage,
    "readiness": readiness,
    "monitoring": monitoring,
    "social": social,
}


def inputs(spark: SparkSession, sf_dir: str, forms: Sequence[str] = tuple(LANDED), fill: bool = False) -> Inputs:
    """Warehouse inputs built from the driver tables, columns that no table needs NULL or filled."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return Inputs(
        forms={name: LANDED[name](spark, sf_dir, fill) for name in forms},
        choices={name: choices(spark) for name in ("readiness", "rapid_coverage", "activity")},
        dims=dimensions(spark, sf_dir),
        spine=spine_between(days, "day"),
        as_of=AS_OF,
    )
