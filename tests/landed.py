"""Small landed forms and dimensions written by hand."""

import datetime
import json

import pyarrow as pa

from fieldtally.forms import FormSpec
from fieldtally.plans.dims import Dimensions

STAMP = "2024-05-01T23:30:00.000+02:00"


def form(spark, spec: FormSpec, submissions: list[dict]):
    """Landed rows from dicts of filled columns; the rest is NULL."""
    names = spec.landed_columns()
    for submission in submissions:
        assert set(submission) <= set(names), set(submission) - set(names)
    return spark.createDataFrame([tuple(s.get(n) for n in names) for s in submissions], spec.landed_schema())


def group(spec: FormSpec, *elements: dict) -> str:
    """JSON text of a repeat group, its keys given below the group's path."""
    return json.dumps([{spec.repeat.key(k): v for k, v in e.items()} for e in elements])


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


def table(spark, names: str, *rows):
    columns = names.split()
    return spark.createDataFrame(pa.table({c: list(v) for c, v in zip(columns, zip(*rows))}))


def dimensions(spark, indicators=(), readiness_questions=(), monitoring_questions=(), **areas) -> Dimensions:
    """Two regions, two provinces with one ISO code, and two facilities that share a label."""
    listed = {
        1: [(1, "North"), (2, "South")],
        2: [(11, "Hill"), (21, "Shore")],
        3: [(111, "Upper"), (211, "Lower")],
        4: [(1111, "Ward A"), (2111, "Ward B")],
        5: [(5001, "Clinic"), (5002, "Clinic"), (5003, "Post")],
    }
    listed.update({int(k[-1]): v for k, v in areas.items()})
    return Dimensions(
        areas={level: table(spark, "name label", *rows) for level, rows in listed.items()},
        iso=table(spark, "admin2_id province_label iso2_code", ("11", "Hill", "X-HIL")),
        indicators=table(spark, "form_name indicator_name indicator_label category",
                         *(indicators or [("none", "none", "none", "none")])),
        readiness_questions=table(spark, "indicators_category no_of_questions", *(readiness_questions or [("none", 1)])),
        monitoring_questions=table(spark, "indicators_category no_of_questions", *(monitoring_questions or [("none", 1)])),
    )


def places(prefix: str, *codes) -> dict:
    return {f"{prefix}_admin{i}": None if c is None else str(c) for i, c in enumerate(codes, start=1)}


NORTH = (1, 11, 111, 1111, 5001)
SOUTH = (2, 21, 211, 2111, 5002)
