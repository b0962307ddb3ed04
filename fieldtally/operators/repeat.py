"""Repeat groups and select-multiple answers: nested content of one submission becomes rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.forms import Repeat
from fieldtally.functions import option_tokens, typed, whole_number


def _elements(path: str, fields: Sequence[str]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f"{path}/{f}", T.StringType()) for f in fields]))


def is_parsed(df: DataFrame, column: str) -> bool:
    """Whether a repeat group is stored as an array of structs, as ``parsed_group`` makes it, and not as JSON text."""
    return isinstance(df.schema[column].dataType, T.ArrayType)


def parse_repeat(group: Column | str, path: str, fields: Sequence[str], on_error: str = "raise",
                 parsed: bool = False) -> Column:
    """The repeat group as structs holding only the wanted fields, each as text.

    From JSON text a missing key and a JSON null both read as NULL, and malformed text raises, or reads as NULL with
    ``on_error='null'``. From a ``parsed`` group the wanted fields alone reach the scan.
    """
    group = F.col(group) if isinstance(group, str) else group
    if parsed:
        return F.arrays_zip(*[group.getField(f"{path}/{f}") for f in fields]).cast(_elements(path, fields))
    mode = "FAILFAST" if on_error == "raise" else "PERMISSIVE"
    return F.from_json(group, _elements(path, fields), {"mode": mode})


def parsed_group(repeat: Repeat, column: str) -> Column:
    """All fields of a repeat group, as text, from its JSON: parsed once to be stored beside the text."""
    return parse_repeat(f"`{column}`", repeat.path, list(repeat.fields), repeat.on_error)


def repeat_field(element: Column, path: str, name: str, to: str = "string", on_error: str = "raise") -> Column:
    """A field of a parsed element."""
    value = element[f"{path}/{name}"]
    if to == "string":
        return value
    return whole_number(value, on_error) if to == "bigint" else typed(value, to, on_error)


def short_name(name: str) -> str:
    return name.rsplit("/", 1)[-1]


def explode_repeat(df: DataFrame, json_col: str, path: str, fields: Mapping[str, str], keys: Sequence[str],
                   outer: bool = False, on_error: str = "raise") -> DataFrame:
    """One row per array element, with the parent's ``keys`` beside it.

    The array is parsed and exploded once for all fields, in place: children need no join back to
    their parent. Parents without children disappear unless ``outer``.
    """
    kind, wanted = df.schema[json_col].dataType, [f"{path}/{f}" for f in fields]
    ready = is_parsed(df, json_col) and kind.elementType.names == wanted
    parsed = F.col(f"`{json_col}`") if ready else parse_repeat(f"`{json_col}`", path, list(fields), on_error, is_parsed(df, json_col))
    rows = df.select(*keys, (F.explode_outer if outer else F.explode)(parsed).alias("_element"))
    return rows.select(
        *keys, *[repeat_field(F.col("_element"), path, f, to, on_error).alias(short_name(f)) for f, to in fields.items()]
    )


def narrow_group(df: DataFrame, repeat: Repeat, only: Sequence[str], column: str | None = None) -> DataFrame:
    """The repeat group parsed with only the fields that ``only`` lists by short name, so that joins before it is
    exploded carry nothing else."""
    column = column or repeat.column
    fields = [f for f in repeat.fields if short_name(f) in only]
    return df.withColumn(column, parse_repeat(f"`{column}`", repeat.path, fields, repeat.on_error, is_parsed(df, column)))


def explode_group(df: DataFrame, repeat: Repeat, keys: Sequence[str], only: Sequence[str] | None = None,
                  column: str | None = None, outer: bool = False) -> DataFrame:
    """``explode_repeat`` of a declared repeat group; ``only`` limits the fields by short name."""
    fields = {f: to for f, to in repeat.fields.items() if only is None or short_name(f) in only}
    return explode_repeat(df, column or repeat.column, repeat.path, fields, keys, outer, repeat.on_error)


def group_total(repeat: Repeat, only: Sequence[str], column: str | None = None, parsed: bool = False) -> Column:
    """Sum of the named count fields over all rows of a submission's repeat group, within the submission.

    NULL when no count is stated, as a filtered sum over the exploded rows would be. Counts that the
    group declares as text are cast as they are for the exploded rows.
    """
    fields = [f for f in repeat.fields if short_name(f) in only]
    elements = parse_repeat(column or repeat.column, repeat.path, fields, repeat.on_error, parsed)

    def count(element: Column, name: str) -> Column:
        value = repeat_field(element, repeat.path, name, repeat.fields[name], repeat.on_error)
        return typed(value, "bigint", repeat.on_error)

    cells = F.flatten(F.transform(elements, lambda e: F.array(*[count(e, f) for f in fields])))
    stated = F.filter(cells, lambda c: c.isNotNull())
    total = F.aggregate(stated, F.lit(0).cast("bigint"), lambda acc, c: acc + c)
    return F.when(F.size(stated) > 0, total)


def explode_select_multiple(df: DataFrame, answer: str, keys: Sequence[str], out: str | None = None) -> DataFrame:
    """One row per chosen option; no row for a NULL or empty answer."""
    return df.select(*keys, F.explode(option_tokens(answer)).alias(out or answer))
