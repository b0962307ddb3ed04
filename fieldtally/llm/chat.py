"""Conversations as training text: a finite-state machine over roles and a declarative template.

A template names, for each role, the control strings that open and close a turn and whether its text is learnt
from (the loss flag), and which roles may follow which. Formatting a conversation emits segments, each a text
with its loss flag: the opening string, the escaped turn text, the closing string. Control strings inside texts
cannot be taken for real ones: the characters that control strings start with are written as entities there, and
reading back undoes it.

The machine walks over the roles in turn order. A role that may not follow leads to the state `error`, which is
never left. Invalid conversations are formatted all the same and marked; what to do with them is the caller's.

Only built-in functions are used. The one shuffle is by conversation, whose turns have to meet in one row, as
that row is the output. Defined cases: a null text or role is empty; turns are ordered by number, nulls first,
then by role and text; repeated rows are turns of their own; rows without a conversation id form one
conversation; roles that the template does not name get a general marker and are errors to the machine.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    })
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    accepting: tuple[str, ...] = ("assistant",)
    #: The marker of roles without an entry in `turns`: the role's name stands between the two parts of its opening.
    other: tuple[str, str, str] = ("<turn:", ">", "</turn>")
    #: Characters that texts may not hold, since control strings start with them or end at them, and their entities.
    entities: dict[str, str] = field(default_factory=lambda: {"&": "&amp;", "<": "&lt;", ">": "&gt;", "[": "&lb;"})

    def __post_init__(self) -> None:
        strings = [s for t in self.turns.values() for s in (t.open, t.close)] + [self.other[0], self.other[2]]
        if any(s[:1] not in self.entities for s in strings) or next(iter(self.entities), "") != "&":
            raise ValueError("every control string has to start with a character that is escaped, '&' escaped first")
        if len(set(strings)) != len(strings):
            raise ValueError("control strings have to differ")


CHAT = Template()


def escaped(text: Column, template: Template = CHAT) -> Column:
    for char, entity in template.entities.items():
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescaped(text: Column, template: Template = CHAT) -> Column:
    for char, entity in reversed(template.entities.items()):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _by_role(role: Column, template: Template, pick, default: Column) -> Column:
    out = None
    for name, turn in template.turns.items():
        out = (out.when if out is not None else F.when)(role == name, F.lit(pick(turn)))
    return default if out is None else out.otherwise(default)


def _last_state(turns: Column, template: Template) -> Column:
    """The machine's state after all turns."""
    moves = [x for state, roles in template.follows.items() for role in roles for x in (F.lit(f"{state}>{role}"), F.lit(role))]
    table = F.create_map(*moves)
    return F.aggregate(turns, F.lit("start"), lambda state, t: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), t["role"])), F.lit("error")))


def _segments(turn: Column, template: Template) -> Column:
    """Opening, text and closing of one turn with their loss flags."""
    first, second, close = template.other
    opening = _by_role(turn["role"], template, lambda t: t.open,
                       F.concat(F.lit(first), escaped(turn["role"], template), F.lit(second)))
    closing = _by_role(turn["role"], template, lambda t: t.close, F.lit(close))
    loss = _by_role(turn["role"], template, lambda t: t.loss, F.lit(False))

    def segment(text: Column, flag: Column) -> Column:
        return F.struct(text.alias("text"), flag.alias("loss"))

    return F.array(segment(opening, F.lit(False)), segment(escaped(turn["text"], template), loss), segment(closing, F.lit(False)))


def format_chats(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row a conversation: conv_id, segments, formatted (all segments' text), state, valid, complete."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chats = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    made = chats.select("conv_id", _last_state(F.col("turns"), template).alias("state"),
                        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"))
    return made.select("conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"), "state",
                       (F.col("state") != "error").alias("valid"), F.col("state").isin(*template.accepting).alias("complete"))


def turns_of(formatted: Column, template: Template = CHAT) -> Column:
    """The turns that a formatted text holds, in order, as an array of (role, text), unescaped."""
    first, second, close = template.other
    openings = "|".join([re.escape(t.open) for t in template.turns.values()] + [re.escape(first) + "[^>]*" + re.escape(second)])
    closings = "|".join([re.escape(t.close) for t in template.turns.values()] + [re.escape(close)])
    guarded = "".join(re.escape(c) for c in template.entities if c != "&")
    pattern = F.lit(f"({openings})([^{guarded}]*)({closings})")
    marks, bodies = (F.regexp_extract_all(formatted, pattern, F.lit(i)) for i in (1, 2))

    def role(mark: Column) -> Column:
        out = None
        for name, turn in template.turns.items():
            out = (out.when if out is not None else F.when)(mark == turn.open, F.lit(name))
        named = unescaped(F.substring(mark, F.lit(len(first) + 1), F.length(mark) - len(first) - len(second)), template)
        return named if out is None else out.otherwise(named)

    return F.zip_with(marks, bodies, lambda m, b: F.struct(role(m).alias("role"), unescaped(b, template).alias("text")))


def read_back(chats: DataFrame, template: Template = CHAT) -> DataFrame:
    """The contract's columns, from the formatted texts and the segments' loss flags."""
    lost = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    read = chats.select("conv_id", "formatted", turns_of(F.col("formatted"), template).alias("turns"),
                        F.array_join(lost, "").alias("loss_text"), "state", "valid", "complete")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "state", "valid", "complete")
