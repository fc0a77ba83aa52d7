"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events in sequence order::

    message     sets a turn's role and text (a complete message)
    delta       appends streamed text to a turn (creating it)
    edit        replaces a turn's text
    regenerate  empties a turn, whose new version follows as deltas or as a message
    retract     removes a turn

``reconstruct`` partitions the log by conversation, sorts each partition by
(conversation, sequence) and folds it while it streams past, so a task holds
one conversation at a time.  ``render`` writes the final messages with a
template whose control strings inside texts are escaped reversibly, and
returns the spans under the loss mask; ``parse`` reads an output back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strings with a meaning for chat models that must not occur inside a text.
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

# The template of one turn.
OPEN, BREAK, CLOSE = "<|turn|>", "\n", "<|end|>\n"

EVENTS = "conv_id, seq, event, turn, role, text"

MESSAGES = "conv_id bigint, turn bigint, role string, text string"
FORMATTED = "conv_id bigint, formatted string, loss array<struct<start: bigint, end: bigint>>, n_turns bigint"


def escape(text: str, line: bool = False) -> str:
    """Double each backslash, then part every control string by a backslash after its first character.

    ``line``: line breaks too (for a role, which ends at one).
    """
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        if control in text:
            text = text.replace(control, control[0] + "\\" + control[1:])
    return text.replace("\n", "\\n") if line else text


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str, line: bool = False) -> str:
    if "\\" not in text:
        return text
    return _ESCAPED.sub(lambda m: "\n" if line and m[1] == "n" else m[1], text)


def apply_event(turns: dict, event: str | None, turn, role: str | None, text: str | None) -> None:
    """Fold one event into the turns of a conversation; unknown events change nothing."""
    if event == "retract":
        turns.pop(turn, None)
        return
    if event not in ("message", "delta", "edit", "regenerate"):
        return
    known = turns.setdefault(turn, ["", []])
    if role is not None:
        known[0] = role
    if event == "delta":
        known[1].append(text or "")
    elif event == "regenerate":
        known[1] = []
    else:
        known[1] = [text or ""]


def final(turns: dict) -> list[tuple]:
    """(turn, role, text) in order of the turn, turns without a number last."""
    order = sorted(turns, key=lambda t: (t is None, t if t is not None else 0))
    return [(t, turns[t][0], "".join(turns[t][1])) for t in order]


def _events(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(*(column.to_pylist() for column in frame.columns), strict=True)


def _conversations(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, final messages), one after the other."""
    current, turns, started = None, {}, False
    for conv, _, event, turn, role, text in events:
        if started and conv != current:
            yield current, final(turns)
            turns = {}
        current, started = conv, True
        apply_event(turns, event, turn, role, text)
    if started:
        yield current, final(turns)


def _sorted(log: DataFrame) -> DataFrame:
    columns = [
        F.col("conv_id").cast("bigint"),
        F.col("seq").cast("bigint"),
        F.col("event").cast("string"),
        F.col("turn").cast("bigint"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    ]
    rows = log.select(*(c.alias(n) for c, n in zip(columns, EVENTS.split(", "), strict=True)))
    order = ["conv_id", F.asc_nulls_last("seq"), F.asc_nulls_last("turn"), "event", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _flushed(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``limit`` characters."""
    held, size = [], 0
    for row, weight in rows:
        held.append(row)
        size += weight + 64
        if size >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def reconstruct(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log (conv_id, seq, event, turn, role, text).

    Events apply in order of ``seq`` (null last); ties go by turn, event,
    role and text.  A null text is empty, a null role keeps the role a turn
    has (empty if none).  A repeated event applies again.  A null conv_id
    is a conversation of its own.  Further columns are ignored; an empty
    log gives no messages; a conversation whose turns are all retracted
    gives none.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def fold(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (((conv, *m), len(m[2])) for conv, found in _conversations(_events(frames)) for m in found)
        yield from _flushed(rows, schema)

    return _sorted(log).mapInArrow(fold, MESSAGES)


def render_turns(messages: list[tuple], trained: tuple[str, ...] = ("assistant",)) -> tuple[str, list[dict]]:
    """(formatted text, spans under the loss mask) of (turn, role, text) messages."""
    parts, spans, at = [], [], 0
    for _, role, text in messages:
        head = OPEN + escape(role, line=True) + BREAK
        body = escape(text)
        parts += [head, body, CLOSE]
        if role in trained:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def render(log: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: formatted text, loss spans in characters, number of turns.

    Reconstruction and rendering share one pass: a conversation is folded,
    rendered and forgotten.  Cases as for ``reconstruct``.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(span)), ("n_turns", pa.int64())])

    def fold(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv, messages in _conversations(_events(frames)):
                if messages:
                    text, spans = render_turns(messages, trained)
                    yield (conv, text, spans, len(messages)), len(text)

        yield from _flushed(rows(), schema)

    return _sorted(log).mapInArrow(fold, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of an output; a text holds no control string, so the template's own mark the turns."""
    out, at = [], 0
    while at < len(formatted):
        at += len(OPEN)
        middle = formatted.index(BREAK, at)
        end = formatted.index(CLOSE, middle + 1)
        out.append((unescape(formatted[at:middle], line=True), unescape(formatted[middle + 1 : end])))
        at = end + len(CLOSE)
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """Read outputs of ``render`` back: turns, their digest, and the text under the loss mask with its digest."""
    import hashlib

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows = []
            for conv, text, spans in zip(*(frame.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
                turns = parse(text)
                every, masked, chars = hashlib.sha256(), hashlib.sha256(), 0
                for part in chain.from_iterable((role, "\n", body, "\n") for role, body in turns):
                    every.update(part.encode())
                for span in spans:
                    body = unescape(text[span["start"] : span["end"]])
                    chars += len(body)
                    masked.update(body.encode())
                rows.append((conv, len(turns), every.hexdigest(), chars, masked.hexdigest(), len(text)))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    ddl = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(read, ddl)
