"""Conversations as one text each, with turn spans found by rendering prefixes.

The template is a black box: any function from a list of (role, text) to a text.  For turn ``k``
the first ``k`` turns are rendered and compared with the rendering of one turn less: if the
longer text continues the shorter one, what was added is the span of the turn.  Two more
renderings with one-letter texts in place of the turn's own show where its text begins and what
follows it, whatever the text itself looks like.  If the longer text does not continue the
shorter one, the template rewrites history: the turn is reported, and all spans are then located
by such probes in the rendering of the whole conversation.

The default template opens each turn with a control string and its role, and escapes control
strings inside texts reversibly: a backslash before every backslash and inside every ``<|``.

Rows are dealt by conversation, sorted by turn, and streamed; a task holds one conversation at a
time, which is also one row of the result.  Defined results: a NULL text or role is empty; rows
with one turn number are ordered by role and text; rows without a conversation id belong to no
conversation; an empty table has no conversations.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.store import map_arrow

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
Template = Callable[[list[tuple[str, str]]], str]


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def chat_markup(turns: list[tuple[str, str]]) -> str:
    """Default template: control string, role, line feed, escaped text, control string."""
    return "".join(f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{CLOSE}\n"
                   for role, text in turns)


@dataclass
class Span:
    """Places in the formatted text: the turn, and the turn's text inside it."""

    start: int
    end: int
    text_start: int
    text_end: int


def _shared(one: str, other: str) -> int:
    return len(os.path.commonprefix([one, other]))


def _text_span(render: Template, turns: list[tuple[str, str]], k: int, full: str) -> tuple:
    """Where the text of turn ``k`` stands in ``full``, by two one-letter texts in its place."""
    role = turns[k][0]
    one, other = (render([*turns[:k], (role, probe), *turns[k + 1:]]) for probe in "xy")
    head = _shared(one, other)
    tail = len(one) - head - 1
    return head, max(head, len(full) - tail)


def locate(render: Template, turns: list[tuple[str, str]]) -> tuple[str, list[Span], int | None]:
    """Formatted text, a span per turn, and the first turn (from 0) that rewrote history."""
    formatted, spans, rewritten = "", [], None
    for k in range(len(turns)):
        longer = render(turns[:k + 1])
        if not longer.startswith(formatted):
            rewritten = k
            break
        spans.append(Span(len(formatted), len(longer),
                          *_text_span(render, turns[:k + 1], k, longer)))
        formatted = longer
    if rewritten is not None:
        formatted = render(turns)
        places = [_text_span(render, turns, k, formatted) for k in range(len(turns))]
        starts = [0, *(end for _, end in places[:-1])]
        spans = [Span(min(start, place[0]), place[1], *place)
                 for start, place in zip(starts, places)]
    return formatted, spans, rewritten


TURNS = "array<struct<role:string,start:int,end:int,text_start:int,text_end:int,loss:boolean>>"


def _format(render: Template, learn: tuple[str, ...]):
    def finish(conv_id, turns) -> dict:
        formatted, spans, rewritten = locate(render, turns)
        return {"conv_id": conv_id, "formatted": formatted, "rewritten_by": rewritten, "turns": [
            {"role": role, "start": s.start, "end": s.end, "text_start": s.text_start,
             "text_end": s.text_end, "loss": role in learn}
            for (role, _), s in zip(turns, spans)]}

    schema = pa.schema([
        ("conv_id", pa.int64()), ("formatted", pa.string()), ("rewritten_by", pa.int32()),
        ("turns", pa.list_(pa.struct([
            ("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
            ("text_start", pa.int32()), ("text_end", pa.int32()), ("loss", pa.bool_())])))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns = None, []
        for batch in batches:
            done = []
            for conv_id, role, text in zip(*(batch[name].to_pylist()
                                             for name in ("conv_id", "role", "text"))):
                if turns and conv_id != current:
                    done.append(finish(current, turns))
                    turns = []
                current = conv_id
                turns.append((role, text))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if turns:
            yield pa.RecordBatch.from_pylist([finish(current, turns)], schema)
    return rows


def format_conversations(rows: DataFrame, template: Template = chat_markup,
                         learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns`` (role, span, span of the
    text, whether the text is under the loss mask; in code points, end exclusive) and
    ``rewritten_by``, the first turn whose rendering changed earlier text (else NULL)."""
    named = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = named.repartition(parts, "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    return map_arrow(dealt, _format(template, learn),
                     f"conv_id long, formatted string, rewritten_by int, turns {TURNS}")


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns read from texts of the default template: add ``read``, role, text and loss per turn."""
    whole = F.col("formatted")

    def turn(t: Column) -> Column:
        role = F.substring(whole, t["start"] + len(OPEN) + 1,
                           t["text_start"] - t["start"] - len(OPEN) - 1)
        text = F.substring(whole, t["text_start"] + 1, t["text_end"] - t["text_start"])
        plain = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
        return F.struct(_unescaped(plain).alias("role"), _unescaped(text).alias("text"),
                        t["loss"].alias("loss"))

    return formatted.withColumn("read", F.transform("turns", turn))


def digest(formatted: DataFrame) -> DataFrame:
    said = F.array_join(F.transform(F.filter("read", lambda t: t["loss"]),
                                    lambda t: t["text"]), "")
    told = F.array_join(F.transform(
        "read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"), F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
