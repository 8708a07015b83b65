"""Chat formatting from event logs.

A log has one row an event. It is partitioned by conversation and sorted by
sequence; a fold over the sorted rows turns streamed deltas, edits and
regenerations into final messages, which are rendered with a template that marks
turns and escapes what could be mistaken for a mark.

Events (``op``), each about the message ``message`` of its conversation:

- ``start``: opens the message with ``role`` and ``text``;
- ``delta``: appends ``text``;
- ``edit``: replaces the text;
- ``regenerate``: throws away what was streamed and starts again with ``text``;
- ``retract``: takes the message out.

A later event of a message never opened opens it with its ``role``; a second
``start`` of an open message counts as an edit of role and text. An unknown
``op`` is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK, END = "### ", "</turn>"
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]+|\\.|<(?!/turn>))*)</turn>\n", re.S)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\###").replace(END, "\\" + END)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>)", r"\1", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace(":", "\\:")


def render(messages: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[dict]]:
    """The formatted conversation, and the spans (code points) that the loss covers."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{MARK}{escape_role(role)}: ", escape(text)
        if role == learned:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages that ``render`` was given."""
    turns = []
    for role, body in TURN.findall(formatted):
        turns.append((re.sub(r"\\(.)", r"\1", role, flags=re.S), unescape(body)))
    return turns


def loss_text(formatted: str, spans: list[dict]) -> str:
    """What the loss mask covers, unescaped."""
    return "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)


class Fold:
    """The messages of one conversation, as far as its events have come."""

    def __init__(self) -> None:
        self.messages: dict = {}

    def add(self, op: str, message: object, role: str | None, text: str | None) -> None:
        now = self.messages.get(message)
        if op == "retract":
            self.messages.pop(message, None)
        elif now is None:
            self.messages[message] = [role or "", [text or ""]]
        elif op == "delta":
            now[1].append(text or "")
        elif op in ("edit", "regenerate"):
            now[1] = [text or ""]
        elif op == "start":
            now[0], now[1] = role or "", [text or ""]
        if op not in ("start", "delta", "edit", "regenerate", "retract"):
            raise ValueError(f"unknown event: {op}")

    def final(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for role, parts in self.messages.values()]


def events_of_rows(rows: DataFrame) -> DataFrame:
    """A table of finished messages (conv_id, turn, role, text) as a log: each
    message is opened empty and its text streamed. Rows that repeat a turn stay
    messages of their own, ordered by role and text; null turns come first."""
    sorted_key = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # equal rows get numbers of their own before they become events, so that each one's delta follows its start
    rows = rows.select("conv_id", "role", "text", sorted_key.alias("order"), F.monotonically_increasing_id().alias("row"))
    return rows.select("conv_id", F.posexplode(F.array(F.lit("start"), F.lit("delta"))).alias("step", "op"), "order", "row", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "conv_id", F.struct("order", "row", "step").alias("seq"), "op", F.lit(None).cast("string").alias("message"), "role", F.when(F.col("op") == "delta", F.col("text")).otherwise("").alias("text")
    )


def formatted(events: DataFrame, learned: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss`` (spans of code points) of each conversation.

    ``events`` has conv_id, seq (anything that sorts), op, message, role and
    text. A null ``message`` means the one opened last, and a ``start`` with a
    null message opens a new one. Null role or text: empty. Events that tie on
    seq are taken by op, message, role and text. A null conv_id is a conversation.
    No events: no rows. Other columns are ignored. A conversation is one row of
    the result; while folded, only one is held.
    """
    rows = events.select("conv_id", "seq", "op", F.col("message").cast("string").alias("message"), "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "op", "message", "role", "text").drop("seq")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        fold, now, opened, any_open, size = Fold(), None, 0, False, 0

        def out() -> pa.RecordBatch:
            a, b, c = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, key), pa.array(b), pa.array(c, SPANS)], names=["conv_id", "formatted", "loss"])

        key = pa.int64()
        for batch in batches:
            key = batch.schema.field("conv_id").type
            for conv, op, message, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if any_open and conv != now:
                    done.append((now, *render(fold.final(), learned)))
                    size += len(done[-1][1])
                    fold, opened = Fold(), 0
                    if size > 4_000_000 or len(done) >= 2000:
                        yield out()
                        size = 0
                now, any_open = conv, True
                if message is None:
                    opened += op == "start" or not opened
                    message = opened
                fold.add(op, message, role, text)
        if any_open:
            done.append((now, *render(fold.final(), learned)))
        if done:
            yield out()

    return rows.mapInArrow(run, f"conv_id {kind}, formatted string, loss array<struct<start:long,end:long>>")
