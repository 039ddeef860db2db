"""Chat formatting checked by a grammar round trip.

Each turn becomes one segment between control strings. A deterministic parser reads the segment
back; if role or text differ from the source, conflicting content is escaped, until they are
identical. The formatted conversation is its segments in order, and the reader below
recovers turns and loss mask from that output alone.

    turn  := "[INST]" text "[/INST]" | "<s>" text "</s>" | "<<SYS>>" text "<</SYS>>"
           | "<<TURN>>" role "<<TEXT>>" text "<</TURN>>"
    text  := any characters without a control string; "[\\INST]" stands for "[INST]",
             "[\\\\INST]" for "[\\INST]" and so on for every control string
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, ship_package

MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<<TURN>>", "<<TEXT>>", "<</TURN>>")
LOSS_ROLE = "assistant"

_ROLES = {opening: role for role, (opening, _) in MARKS.items()}
_NAMES = r"/?(?:INST\]|s>|SYS>>|TURN>>|TEXT>>)"
_CONFLICT = re.compile(rf"(<<|<|\[)(\\*)({_NAMES})")
_ESCAPED = re.compile(rf"(<<|<|\[)\\(\\*)({_NAMES})")
_CONTROL = re.compile("|".join(re.escape(m) for m in [*sum(MARKS.values(), ()), *OTHER]))


class Malformed(ValueError):
    pass


def escape(text: str) -> str:
    return _CONFLICT.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _segment(role: str, text: str) -> str:
    if role in MARKS:
        opening, closing = MARKS[role]
        return opening + text + closing
    return OTHER[0] + role + OTHER[1] + text + OTHER[2]


def parse(formatted: str) -> tuple[list[tuple[str, str]], str]:
    """The turns of `formatted` and what follows the last complete one."""
    turns, at = [], 0
    while at < len(formatted):
        opening = _CONTROL.match(formatted, at)
        if not opening:
            if any(m.startswith(formatted[at:]) for m in [*_ROLES, OTHER[0]]):
                break
            raise Malformed(f"no turn begins at {at}")
        start = opening.end()
        if opening[0] in _ROLES:
            role, wanted = _ROLES[opening[0]], MARKS[_ROLES[opening[0]]][1]
        elif opening[0] == OTHER[0]:
            named = _CONTROL.search(formatted, start)
            if not named:
                break
            if named[0] != OTHER[1]:
                raise Malformed(f"{named[0]} after a role")
            role, start, wanted = unescape(formatted[start : named.start()]), named.end(), OTHER[2]
        else:
            raise Malformed(f"{opening[0]} outside of a turn")
        closing = _CONTROL.search(formatted, start)
        if not closing:
            break
        if closing[0] != wanted:
            raise Malformed(f"{closing[0]} instead of {wanted}")
        turns.append((role, unescape(formatted[start : closing.start()])))
        at = closing.end()
    return turns, formatted[at:]


def render(role: str, text: str) -> str:
    """The turn's segment: as it stands if it reads back identically, escaped otherwise."""
    for change in (str, escape):
        segment = _segment(role if role in MARKS else change(role), change(text))
        try:
            if parse(segment) == ([(role, text)], ""):
                return segment
        except Malformed:
            pass
    raise Malformed(f"cannot be rendered: {role!r}, {text!r}")


def format_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, segment` of rows with `conv_id, turn, role, text`.

    Null texts and roles are empty. A conversation is its segments by turn; equal turns go by
    role, then segment, and a null turn comes first. Rows with a null conv_id form one conversation.
    """
    ship_package(conversations.sparkSession)

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            segments = pa.array(map(render, roles, texts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), segments],
                ["conv_id", "turn", "role", "segment"],
            )

    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text")
    )
    return rows.mapInArrow(rendered, "conv_id long, turn long, role string, segment string")


class _ReadBack:
    """Digests of one conversation, fed with its formatted text piece by piece."""

    def __init__(self) -> None:
        self.rest = ""
        self.turns = self.formatted = self.loss = 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str) -> None:
        self.formatted += len(piece)
        turns, self.rest = parse(self.rest + piece)
        for role, text in turns:
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == LOSS_ROLE:
                self.loss += len(text)
                self.masked.update(text.encode())

    def row(self) -> tuple:
        if self.rest:
            raise Malformed("the conversation ends inside a turn")
        return self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.formatted


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Parses the formatted conversations and digests what was recovered, one row each.

    Segments were rendered in parallel; a digest in turn order is sequential, so a conversation
    passes through one task, as a sorted stream of which one batch is in memory.
    """
    ship_package(segments.sparkSession)
    names = [field.split()[0] for field in _READ.split(", ")]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader = None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in in_slices(batches):
            done = []
            for conv_id, piece in zip(batch.column("conv_id").to_pylist(), batch.column("segment").to_pylist()):
                if reader is None or conv_id != current:
                    if reader is not None:
                        done.append((current, *reader.row()))
                    current, reader = conv_id, _ReadBack()
                reader.feed(piece)
            yield out(done)
        if reader is not None:
            yield out([(current, *reader.row())])

    return (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "segment")
        .select("conv_id", "segment")
        .mapInArrow(streamed, _READ)
    )
