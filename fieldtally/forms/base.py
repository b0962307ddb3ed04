"""Declarative form specs: what a form looks like when landed and how its clean form is named and typed.

A country team that changes a form (questions, administrative levels, categories) edits a spec with
``dataclasses.replace``; no operator or plan changes.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Metadata columns the form service and the connector put on every submission.
PLATFORM_COLUMNS = (
    "_attachments", "_bamboo_dataset_id", "_date_modified", "_duration", "_edited", "_geolocation",
    "_id", "_media_all_received", "_media_count", "_notes", "_review_comment", "_review_status",
    "_status", "_submission_time", "_submitted_by", "_tags", "_total_media", "_uuid", "_version",
    "_xform_id", "_xform_id_string", "device_id", "end", "formhub_uuid", "intro", "meta_instanceID",
    "start", "today", "username",
)

# Landed name -> reporting name of the metadata columns that are renamed.
META_RENAMES = {
    "_id": "id",
    "_submission_time": "submitted_at",
    "_date_modified": "modified_at",
    "formhub_uuid": "uuid",
    "meta_instanceID": "instanceid",
    "_airbyte_raw_id": "_airbyte_ab_id",
    "_airbyte_extracted_at": "_airbyte_emitted_at",
}

RAW_ID = "_airbyte_raw_id"
EXTRACTED_AT = "_airbyte_extracted_at"

SUBMISSION_TYPES = {"submitted_at": "timestamp_ntz", "modified_at": "timestamp_ntz"}


@dataclass(frozen=True)
class Question:
    """One yes/no question: its dictionary name and the columns holding answer and remark."""

    name: str
    value: str
    remark: str


@dataclass(frozen=True)
class Repeat:
    """A repeat group landed as a JSON array of objects whose keys are slash paths below ``path``."""

    column: str
    path: str
    fields: dict[str, str]
    #: What malformed text does: "raise", or "null" to read it as NULL.
    on_error: str = "raise"

    def key(self, name: str) -> str:
        return f"{self.path}/{name}"


@dataclass(frozen=True)
class FormSpec:
    name: str
    groups: dict[str, tuple[str, ...]]
    plain: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=lambda: dict(META_RENAMES))
    copies: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    landed_types: dict[str, str] = field(default_factory=dict)
    repeat: Repeat | None = None
    questions: tuple[Question, ...] = ()
    levels: int = 5
    on_error: str = "raise"

    def lenient(self) -> FormSpec:
        """The same form with malformed text, in its columns and its repeat group, read as NULL."""
        repeat = self.repeat and replace(self.repeat, on_error="null")
        return replace(self, on_error="null", repeat=repeat)

    def landed_columns(self) -> list[str]:
        grouped = [f"{group}_{name}" for group, names in self.groups.items() for name in names]
        return grouped + list(self.plain)

    def clean_columns(self) -> list[tuple[str, str, str]]:
        """(landed name, clean name, type) of every clean column, metadata included."""
        named = [(f"{group}_{name}", name) for group, names in self.groups.items() for name in names]
        named += [(name, self.renames.get(name, name)) for name in self.plain]
        named += [(landed, clean) for clean, landed in self.copies.items()]
        return [(landed, clean, self.types.get(clean, "string")) for landed, clean in named]

    def landed_schema(self) -> T.StructType:
        """Schema for reading landed files; text unless the connector types the column."""
        ddl = ", ".join(f"`{c}` {self.landed_types.get(c, 'string')}" for c in self.landed_columns())
        return T.StructType.fromDDL(ddl)


def numbered(stem: str, last: int, suffix: str = "") -> tuple[str, ...]:
    """``stem1 .. stemN`` with an optional suffix."""
    return tuple(f"{stem}{i}{suffix}" for i in range(1, last + 1))


def answered(stem: str, last: int) -> tuple[str, ...]:
    """Answer columns of a question block followed by their remark columns."""
    return numbered(stem, last) + numbered(stem, last, "_remarks")


def question_block(stem: str, last: int) -> tuple[Question, ...]:
    return tuple(Question(q, q, f"{q}_remarks") for q in numbered(stem, last))


def area_columns(levels: int) -> tuple[str, ...]:
    """Area codes from the country down to ``levels`` plus the coordinates of the fourth level."""
    return tuple(f"admin{i}" for i in range(levels + 1)) + ("admin4_lat", "admin4_long")
