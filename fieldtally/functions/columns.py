"""Column expressions shared by the operators; all are built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

YES = "Yes"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_yes(answer: Column | str) -> Column:
    """Answers count as yes only when spelled exactly so."""
    return _col(answer) == YES


def sum_where(value: Column | str, condition: Column) -> Column:
    """Filtered sum; NULL, not 0, when nothing qualifies."""
    return F.sum(F.when(condition, _col(value)))


def count_where(counted: Column | str, condition: Column) -> Column:
    """Filtered count of non-NULL values; 0 when nothing qualifies."""
    return F.count(F.when(condition, _col(counted)))


def sum_of_cells(*cells: Column | str) -> Column:
    """Sum across columns that skips NULL cells and is NULL only when every cell is."""
    cols = [_col(c) for c in cells]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0).cast("bigint")) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def typed(value: Column | str, to: str, on_error: str = "raise") -> Column:
    """Text as ``to``: malformed text raises, or is NULL with ``on_error='null'``."""
    return _col(value).try_cast(to) if on_error == "null" else _col(value).cast(to)


def whole_number(value: Column | str, on_error: str = "raise") -> Column:
    """A JSON scalar as bigint: integers directly, decimals rounded half up, other text as ``typed`` has it.

    Only for fields whose form declares them as numbers; counts that are read as text are cast plainly.
    """
    text = _col(value)
    return F.coalesce(text.try_cast("bigint"), F.round(typed(text, "decimal(38,9)", on_error)).cast("bigint"))


def fixed_width(value: Column | str, width: int) -> Column:
    """Text cut to ``width`` characters."""
    return F.substring(_col(value).cast("string"), 1, width)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Days from start to end; the end day itself is not counted."""
    return F.datediff(_col(end), _col(start))


def resolve_other(answer: Column | str, specified: Column | str, token: str = "others") -> Column:
    """The free text when the answer is the 'other' option, else the answer itself."""
    return F.when(_col(answer) == token, _col(specified)).otherwise(_col(answer))


def option_tokens(answer: Column | str) -> Column:
    """Chosen options of a select-multiple answer such as ``["mr" "opv"]``; empty text has none."""
    bare = F.regexp_replace(_col(answer), r'[\[\]"]', "")
    tokens = F.transform(F.split(bare, " "), lambda token: F.trim(token))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(tokens)


def complete_share(proportion: Column | str, categories: int) -> Column:
    """Aggregate: percent of ``categories`` whose proportion is exactly 1; a NULL proportion is incomplete."""
    complete = F.sum(F.when(_col(proportion) == 1, 1).otherwise(0)).cast("double")
    return complete / F.lit(float(categories)) * F.lit(100.0)


def half_even_percent(percent: Column | str) -> Column:
    """Whole percent, ties to the even neighbour: 12.5 -> 12, 37.5 -> 38."""
    return F.bround(_col(percent), 0).cast("int")


def score_band(percent: Column | str) -> Column:
    """Band of a percentage; NULL between 99 and 100, above 100 and below 0."""
    p = _col(percent)
    return (
        F.when((p >= 0) & (p < 50), "<50%")
        .when((p >= 50) & (p <= 99), "50-99%")
        .when(p == 100, "100%")
    )
