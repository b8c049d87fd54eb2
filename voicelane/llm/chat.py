"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn; adjacent
turns of one role become one message; messages become text:

    <s>ROLE<t>TEXT<+>TEXT</s><s>ROLE<t>TEXT</s>

Control strings inside roles and texts are escaped reversibly: a backslash goes in
behind their first character, and every longer run of backslashes there grows by one.
The text of one message keeps its borders (``<+>``), so the rows can be read back.

Null texts and roles count as empty. Ties of turn are ordered by role and text, null
turns come first, repeated rows stay. Rows with a null conversation id form one
conversation. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "<s>"
    role_end: str = "<t>"
    join: str = "<+>"
    close: str = "</s>"
    #: Control strings of other templates that must not survive inside texts either.
    foreign: tuple[str, ...] = ("[INST]", "[/INST]")
    loss_role: str = "assistant"

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        if any(len(c) < 2 or "\\" in c or heads & set(c[1:]) for c in self.controls):
            raise ValueError("a control string starts with a character found nowhere else in it")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.role_end, self.join, self.close, *self.foreign)

    def _pattern(self, run: str) -> str:
        heads = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        rests = "|".join(re.escape(c[1:]) for c in self.controls)
        return rf"([{heads}]){run}(?={rests})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"(\\*)"), r"$1\\$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\(\\*)"), "$1$2")


DEFAULT = Template()


def merge_turns(turns: Column) -> Column:
    """Adjacent turns of one role as one message: array of (role, texts)."""
    at = F.sequence(F.lit(1), F.size(turns))
    role = lambda k: F.element_at(turns, k)["role"]
    starts = F.filter(at, lambda k: (k == 1) | (role(k) != role(F.greatest(k - 1, F.lit(1)))))
    stops = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(turns) + 1))
    return F.zip_with(
        starts, stops,
        lambda a, b: F.struct(
            role(a).alias("role"),
            F.transform(F.slice(turns, a, b - a), lambda t: t["text"]).alias("texts"),
        ),
    )


def format_chats(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, formatted, segments: one row per conversation.

    ``segments`` are the pieces of the formatted text in order, each with its place in
    the loss mask (the texts of the loss role are in, control strings are out).
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    piece = lambda text, loss: F.struct(text.alias("piece"), loss.alias("loss"))
    out = lambda text: piece(text, F.lit(False))

    def message(m: Column) -> Column:
        head = F.concat(F.lit(template.open), template.escape(m["role"]), F.lit(template.role_end))
        bodies = F.transform(
            m["texts"],
            lambda text, k: F.array(
                out(F.when(k == 0, head).otherwise(F.lit(template.join))),
                piece(template.escape(text), m["role"] == template.loss_role),
            ),
        )
        return F.concat(F.flatten(bodies), F.array(out(F.lit(template.close))))

    return (
        conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", merge_turns(F.col("turns")).alias("messages"))
        .select("conv_id", F.flatten(F.transform("messages", message)).alias("segments"))
        .select(
            "conv_id",
            F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"),
            "segments",
        )
    )


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    split = lambda text, mark: F.split(text, re.escape(mark), -1)
    shown = split(formatted, template.close)
    shown = F.slice(shown, 1, F.size(shown) - 1)

    def turns(message: Column) -> Column:
        parts = split(F.substring(message, F.lit(len(template.open) + 1), F.length(message)), template.role_end)
        role = template.unescape(F.element_at(parts, 1))
        return F.transform(
            split(F.element_at(parts, 2), template.join),
            lambda text: F.struct(role.alias("role"), template.unescape(text).alias("text")),
        )

    return F.flatten(F.transform(shown, turns))


def loss_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped."""
    inside = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(inside, lambda s: template.unescape(s["piece"])), "")
