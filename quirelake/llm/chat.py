"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" body "<|im_end|>" "\\n"
    role         := characters but "<" and line feed; "\\\\l", "\\\\n", "\\\\b" stand for "<", line feed, "\\\\"
    body         := characters in which no "<|" stands; "<", n+1 backslashes, "|" stand for "<", n backslashes, "|"

Every turn is written plainly first and parsed again; where the parser refuses it or recovers another role or text, the
content is escaped and parsed once more, until both are identical. Formatted conversations come in segments of bounded
size (a usual conversation is one, a huge one many), each with the spans of its text that the loss covers. Turns are
dealt out by conversation and sorted, and both writer and reader handle them as a stream: one turn or segment at a time,
whatever the conversation's size.

Null texts and roles count as empty. Rows are ordered by turn (null first), then role and text, so repeated rows and
turns give a defined order; all are kept. A null conversation id is an id of its own. An empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.common import slices, small_batches

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose texts the loss covers.
LEARNED = ("assistant",)
SEGMENT_CHARS = 1 << 16

_BODY_ESCAPE = re.compile(r"<(\\*)\|")
_BODY_UNESCAPE = re.compile(r"<\\(\\*)\|")
_ROLE_CODES = {"\\b": "\\", "\\n": "\n", "\\l": "<"}


def escape_body(text: str) -> str:
    return _BODY_ESCAPE.sub(r"<\\\1|", text)


def unescape_body(text: str) -> str:
    return _BODY_UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\b").replace("\n", "\\n").replace("<", "\\l")


def unescape_role(role: str) -> str:
    return re.sub(r"\\[bnl]", lambda m: _ROLE_CODES[m[0]], role)


class Refused(ValueError):
    """The text is not of the grammar."""


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, unescaped text, and the body's start and end for each turn."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise Refused(f"no turn at {at}")
        line = text.find("\n", at)
        stop = text.find("<|", line + 1)
        if line < 0 or not text.startswith(END + "\n", stop) or stop < 0 or "<" in text[at + len(START) : line]:
            raise Refused(f"turn at {at} has no end")
        yield unescape_role(text[at + len(START) : line]), unescape_body(text[line + 1 : stop]), line + 1, stop
        at = stop + len(END) + 1


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn as the grammar writes it, and its body's place; parsing it gives the same role and text."""
    for written_role, body in ((role, text), (role, escape_body(text)), (escape_role(role), escape_body(text))):
        turn = f"{START}{written_role}\n{body}{END}\n"
        try:
            turns = list(parse(turn))
        except Refused:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return turn, turns[0][2], turns[0][3]
    raise Refused("no spelling of this turn can be read back")


SEGMENTS = "conv_id bigint, segment bigint, formatted string, loss array<struct<start:int,stop:int>>"
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
])


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    learned: tuple[str, ...] = LEARNED, segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """conv_id, segment (from 0), formatted, loss: character spans of the segment that the loss covers."""
    small_batches(turns.sparkSession)
    rows = turns.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, segment, parts, size, loss, begun = None, 0, [], 0, [], False

        def close() -> dict:
            return {"conv_id": conv, "segment": segment, "formatted": "".join(parts), "loss": loss}

        for batch in slices(batches):
            out = []
            for own, who, said in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if begun and (own != conv or size >= segment_chars):
                    out.append(close())
                    segment, parts, size, loss = segment + 1, [], 0, []
                if not begun or own != conv:
                    conv, segment, begun = own, 0, True
                written, start, stop = render(who, said)
                if who in learned:
                    loss.append({"start": size + start, "stop": size + stop})
                parts.append(written)
                size += len(written)
            yield pa.RecordBatch.from_pylist(out, _SEGMENTS)
        if begun:
            yield pa.RecordBatch.from_pylist([close()], _SEGMENTS)

    return ordered.mapInArrow(run, SEGMENTS)


CONVERSATIONS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_CONVERSATIONS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def read_back(segments: DataFrame) -> DataFrame:
    """Parse formatted segments and sum up each conversation: its turns, and the text under the loss spans."""
    small_batches(segments.sparkSession, 128)
    ordered = segments.select("conv_id", "segment", "formatted", "loss").repartition(F.col("conv_id"))
    ordered = ordered.sortWithinPartitions("conv_id", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun = None, False
        n, chars, covered, all_turns, under_loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()

        def close() -> dict:
            return {
                "conv_id": conv, "n_turns": n, "turns_sha256": all_turns.hexdigest(), "loss_chars": covered,
                "loss_sha256": under_loss.hexdigest(), "formatted_chars": chars,
            }

        for batch in slices(batches):
            out = []
            for own, _, formatted, loss in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if begun and own != conv:
                    out.append(close())
                if not begun or own != conv:
                    conv, begun = own, True
                    n, chars, covered, all_turns, under_loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                chars += len(formatted)
                for role, text, _, _ in parse(formatted):
                    n += 1
                    all_turns.update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape_body(formatted[span["start"] : span["stop"]])
                    covered += len(text)
                    under_loss.update(text.encode())
            yield pa.RecordBatch.from_pylist(out, _CONVERSATIONS)
        if begun:
            yield pa.RecordBatch.from_pylist([close()], _CONVERSATIONS)

    return ordered.mapInArrow(run, CONVERSATIONS)
