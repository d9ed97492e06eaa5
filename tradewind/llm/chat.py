"""Chat formatting: a state machine over roles, and text segments with loss flags.

A template states how a turn is written, which roles are trained on and which role may follow which
state. Everything runs as DataFrame functions: a conversation's turns are gathered in order, the
state machine is a fold over them, and each turn becomes three segments: its head, its text and its
tail. Only the text of a trained role carries loss.

Control strings start with ``<|``. Inside a text, a ``<``, any number of backslashes and a ``|``
get one more backslash, so no text holds a control string, and reading back takes one away again.
Roles are written URL-encoded, so any string can be a role.

Turns are ordered by turn, then role, then text; repeated rows are turns of their own. A NULL text
or role is empty. A conversation out of order is formatted all the same and marked invalid, with
the position (from 0) of its first wrong turn. A conversation is one row of the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written, what is trained on, and the moves (state, role, next state)."""

    head: str = "<|im_start|>"
    head_end: str = "\n"
    tail: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "instructed"), ("start", "user", "asked"),
        ("instructed", "user", "asked"), ("asked", "assistant", "answered"),
        ("answered", "user", "asked"))

    def __post_init__(self):
        if not (self.head.startswith("<|") and self.tail.startswith("<|")
                and self.head_end == "\n"):
            raise ValueError("control strings start with <| and a head ends with a line")


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _run_machine(turns: Column, template: Template) -> Column:
    """struct(state, position, error): the state after the turns, the first wrong position."""
    table = F.create_map(*(F.lit(part) for state, role, then in template.moves
                           for part in (f"{state}\n{role}", then)))
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("position"),
                     F.lit(None).cast("int").alias("error"))

    def step(run: Column, turn: Column) -> Column:
        then = F.try_element_at(table, F.concat_ws("\n", run["state"], turn["role"]))
        return F.struct(
            F.coalesce(then, run["state"]).alias("state"),
            (run["position"] + 1).alias("position"),
            F.coalesce(run["error"], F.when(then.isNull(), run["position"])).alias("error"))

    return F.aggregate(turns, begin, step)


def format_conversations(turns: DataFrame, template: Template = CHATML,
                         conversation: str = "conv_id", order: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conversation, segments, formatted, valid, wrong_turn), a row per conversation.

    ``segments`` is an array of (text, loss); ``formatted`` is their texts joined.
    """
    gathered = turns.select(
        F.col(conversation).alias("_conversation"), F.struct(
            F.col(order).alias("place"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("_turn"),
    ).groupBy("_conversation").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    def written(turn: Column) -> Column:
        head = F.concat(F.lit(template.head), F.url_encode(turn["role"]),
                        F.lit(template.head_end))
        parts = ((head, F.lit(False)),
                 (escape(turn["text"]), turn["role"].isin(*template.trained)),
                 (F.lit(template.tail), F.lit(False)))
        return F.array(*(F.struct(part.alias("text"), loss.alias("loss"))
                         for part, loss in parts))

    return gathered.select(
        F.col("_conversation").alias(conversation),
        F.flatten(F.transform("_turns", written)).alias("segments"),
        _run_machine(F.col("_turns"), template)["error"].alias("wrong_turn")).select(
        conversation, "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("wrong_turn").isNull().alias("valid"), "wrong_turn")


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """array of (role, text) that a formatted conversation holds."""
    pieces = F.split(formatted, re.sub(r"([^\w])", r"\\\1", template.head))

    def read(piece: Column) -> Column:
        line = F.instr(piece, template.head_end)
        size = F.char_length(piece) - line - len(template.tail)
        return F.struct(
            F.url_decode(F.substring(piece, F.lit(1), line - 1)).alias("role"),
            unescape(F.substring(piece, line + 1, size)).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), read)


def read_trained(segments: Column) -> Column:
    """All text under the loss mask, unescaped, joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
