"""From a landed form to its clean form: prefixes stripped, metadata renamed, columns typed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.forms import FormSpec
from fieldtally.forms.base import META_RENAMES


def clean_name(landed: str, groups: Iterable[str], overrides: Mapping[str, str] = META_RENAMES) -> str:
    """Reporting name of a landed column: an override, else the longest group prefix is cut once."""
    if landed in overrides:
        return overrides[landed]
    prefixes = sorted((g for g in groups if landed.startswith(f"{g}_")), key=len, reverse=True)
    return landed[len(prefixes[0]) + 1:] if prefixes else landed


def strip_group_prefix(df: DataFrame, groups: Iterable[str], overrides: Mapping[str, str] = META_RENAMES) -> DataFrame:
    """Rename every ``<group>_<field>`` column of a form to ``<field>``."""
    groups = list(groups)
    return df.select(*[F.col(f"`{c}`").alias(clean_name(c, groups, overrides)) for c in df.columns])


def _typed(column: str, to: str, alias: str, on_error: str) -> str:
    return f"{'try_cast' if on_error == 'null' else 'cast'}(`{column}` as {to}) as `{alias}`"


def apply_types(df: DataFrame, types: Mapping[str, str], default: str = "string", on_error: str = "raise") -> DataFrame:
    """Every column cast to its declared type, undeclared ones to ``default``.

    Malformed text raises, or becomes NULL with ``on_error='null'``.
    """
    return df.selectExpr(*[_typed(c, types.get(c, default), c, on_error) for c in df.columns])


def clean_form(raw: DataFrame, spec: FormSpec, on_error: str | None = None) -> DataFrame:
    """The clean form declared by ``spec``, malformed text as the spec or ``on_error`` has it.

    Only columns used downstream reach the scan.
    """
    return raw.selectExpr(*[_typed(landed, to, clean, on_error or spec.on_error) for landed, clean, to in spec.clean_columns()])
