"""The dimensions the plans look labels up in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

PLACES = tuple(f"admin{i}" for i in range(1, 6))


@dataclass(frozen=True)
class Dimensions:
    """``areas`` maps level to (name, label); the rest follow ``sources.tables.DIM_SCHEMAS``."""

    areas: dict[int, DataFrame]
    iso: DataFrame
    indicators: DataFrame
    readiness_questions: DataFrame
    monitoring_questions: DataFrame
