"""Pieces of check SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from fieldtally.driver import raw_forms as raw
from fieldtally.forms import READINESS, FormSpec

# Elements of a repeat group: index and age group.
AGES = "(values {}) ages(e, age)".format(", ".join(f"({e}, '{age}')" for e, age in enumerate(raw.AGE_GROUPS)))

CHOICES = "(select * from (values {}) choices(question, code, label))".format(
    ", ".join(str(row) for row in raw.CHOICES))

READINESS_DICTIONARY = "(select * from (values {}) dictionary(name, label, category))".format(", ".join(
    f"('{name}', '{label}', '{category}')"
    for form, name, label, category in raw.dictionary_rows() if form == raw.READINESS_NAME))

MONITORING_DICTIONARY = "(select * from (values {}) dictionary(name, label, category))".format(", ".join(
    f"('{name}', '{label}', '{category}')"
    for form, name, label, category in raw.dictionary_rows() if form == raw.MONITORING_NAME))


def _sizes(categories: dict[str, tuple[str, int]]) -> str:
    return "(select * from (values {}) sizes(category, n))".format(
        ", ".join(f"('{label}', {n})" for label, n in categories.values()))


READINESS_SIZES = _sizes(raw.READINESS_CATEGORIES)
MONITORING_SIZES = _sizes(raw.MONITORING_CATEGORIES)


def cells(names: Sequence[str], rows: Sequence[Sequence[str]]) -> str:
    """Rows of expressions expanded beside the current row, one output column per name."""
    structs = ", ".join("{" + ", ".join(f"'{n}': {e}" for n, e in zip(names, row)) + "}" for row in rows)
    return f"unnest([{structs}], recursive := true)"


def area_joins(place: str, levels: Sequence[int] = (1, 2, 3, 4, 5), codes: dict[int, str] | None = None) -> str:
    """Left joins to the area tables as a1 .. a5."""
    joins = []
    for level in levels:
        name, key, _, _ = raw.AREAS[level]
        code = (codes or {}).get(level, raw.area_code(place, level))
        joins.append(f"left join {name} a{level} on a{level}.{key} = {code}")
    return " ".join(joins)


def area_labels(levels: Sequence[int] = (1, 2, 3, 4, 5)) -> str:
    return ", ".join(f"a{level}.{raw.AREAS[level][2]} as admin{level}" for level in levels)


def iso_join() -> str:
    return f"left join nation iso on iso.n_nationkey = a2.n_nationkey and iso.n_nationkey % {raw.ISO_GAP} <> 0"


def iso_code() -> str:
    return "case when iso.n_nationkey is not null then concat('ISO-', iso.n_nationkey) end"


def coordinates(key: str) -> str:
    return (f"cast({raw.latitude(key)} as real) as latitude, cast({raw.longitude(key)} as real) as longitude")


def stamps(day: str) -> str:
    return (f"cast({day} as timestamp) + interval '8 hours 30 minutes' as submitted_at, "
            f"cast({day} as timestamp) + interval '17 hours 45 minutes 10 seconds' as modified_at")


def readiness_answers() -> str:
    """Name, answer and remark of every readiness question beside a customer row."""
    return cells(("indicator_name", "indicators_value", "indicators_remarks"), [
        (f"'{q.name}'", raw.readiness_answer(q.name), raw.readiness_remark(q.remark)) for q in READINESS.questions])


def json_group(spec: FormSpec, length: str, elements: Sequence[Mapping[str, str]], nulls: bool = False) -> str:
    """The JSON text of a repeat group: the first ``length`` elements, NULL fields left out unless ``nulls``."""
    def entry(field: str, value: str) -> str:
        said = f"""'"{spec.repeat.key(field)}":' || to_json({value})::varchar"""
        missing = f"""'"{spec.repeat.key(field)}":null'""" if nulls else "null"
        return f"case when ({value}) is null then {missing} else {said} end"

    objects = ["'{' || array_to_string(list_filter([%s], lambda x: x is not null), ',') || '}'" % ", ".join(
        entry(f, e) for f, e in element.items()) for element in elements]
    return (f"case when ({length}) is not null then '[' || array_to_string(list_slice([{', '.join(objects)}], 1, {length}), ',') "
            f"|| ']' end")


def filled_columns(spec: FormSpec, key: str, stated: Collection[str], typed: Mapping[str, str]) -> str:
    """The columns of a clean form that are not ``stated``: fillers of their landed columns in the type that ``typed``
    gives, text by default."""
    return ", ".join(f'cast({raw.filler(spec, landed, key)} as {typed.get(clean, "varchar")}) as "{clean}"'
                     for landed, clean, _ in spec.clean_columns() if clean not in stated)
