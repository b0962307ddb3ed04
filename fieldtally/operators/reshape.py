"""Unpivots: columns of a wide row become rows of a tidy table.

All cells of a row are laid out as one array of structs and expanded with ``inline``, so the input is
read once and no shuffle is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import Question


def sql_text(value: str) -> str:
    """A text literal for SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inline(rows: Sequence[Sequence[str]], names: Sequence[str]) -> Column:
    """Rows of SQL expressions as one generator; SQL text, since wide forms have hundreds of cells."""
    structs = ["struct({})".format(", ".join(f"{e} as {n}" for e, n in zip(row, names))) for row in rows]
    return F.expr(f"inline(array({', '.join(structs)}))")


def unpivot_pairs(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]],
                  name: str, value: str, cast: str | None = None) -> DataFrame:
    """One row per (label, column) pair: ``name`` holds the label, ``value`` the column's content."""
    rows = [(sql_text(label), f"cast(`{c}` as {cast})" if cast else f"`{c}`") for label, c in pairs]
    return df.select(*keys, _inline(rows, (name, value)))


def unpivot_questions(df: DataFrame, keys: Sequence[str], questions: Sequence[Question],
                      remarks: bool = True) -> DataFrame:
    """One row per question with its dictionary name, answer and, unless left out, remark."""
    names = ("indicator_name", "indicators_value") + (("indicators_remarks",) if remarks else ())
    rows = [(sql_text(q.name), f"`{q.value}`", f"`{q.remark}`") for q in questions]
    return df.select(*keys, _inline(rows, names))


def unpivot_crosstab(df: DataFrame, keys: Sequence[str], cells: Sequence[tuple[str, str, str]],
                     names: tuple[str, str, str], cast: str = "bigint") -> DataFrame:
    """One row per cell of a two-way table: (first label, second label, count)."""
    rows = [(sql_text(first), sql_text(second), f"cast(`{c}` as {cast})") for first, second, c in cells]
    return df.select(*keys, _inline(rows, names))


def drop_unanswered(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def union_positional(*frames: DataFrame) -> DataFrame:
    """Union by position, keeping duplicates; names come from the first frame."""
    first, *rest = frames
    for other in rest:
        first = first.union(other)
    return first
