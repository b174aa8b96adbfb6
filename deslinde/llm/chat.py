"""Chat formatting with a grammar round trip: what is rendered is parsed again, and escaped until it parses to its source."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deslinde.llm.common import column, ready, saved

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
# A conversation is rendered in chunks of so many turns or characters at most, so that a long one is many rows.
CHUNK_TURNS, CHUNK_CHARS = 64, 1 << 18

_CONTROL = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
_ROLE_UNSAFE = re.compile(r"[\\\n]")


def escape(text: str) -> str:
    """One more backslash in every control string, those already escaped included: `unescape` takes it away again."""
    return _CONTROL.sub(r"<\\\1|im_\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|im_\2|>", text)


def _role(role: str) -> str:
    return escape(_ROLE_UNSAFE.sub(lambda m: "\\n" if m[0] == "\n" else "\\\\", role))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Broken(ValueError):
    """The rendered text is not of the grammar."""


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end are the text's place in ``rendered``.

    The grammar: turns = { START role LF text END LF }, where role has no line end, and neither role
    nor text holds a control string. There is one way to read a text, or none, which raises `Broken`.
    """
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise Broken("a turn begins without its mark")
        line = rendered.find("\n", at)
        stop = rendered.find(END, at)
        if line < 0 or stop < 0 or stop < line or rendered[stop + len(END) : stop + len(END) + 1] != "\n":
            raise Broken("a turn has no end")
        role, text = rendered[at + len(START) : line], rendered[line + 1 : stop]
        if START in role or START in text:
            raise Broken("a turn within a turn")
        turns.append((_unrole(role), unescape(text), line + 1, stop))
        at = stop + len(END) + 1
    return turns


def render(role: str, text: str) -> str:
    """One turn, rendered so that it parses to itself: as it is if it can be, else with its text or role escaped."""
    for own_role, own_text in ((role, text), (role, escape(text)), (_role(role), escape(text))):
        out = f"{START}{own_role}\n{own_text}{END}\n"
        try:
            back = parse(out)
        except Broken:
            continue
        if [(r, t) for r, t, _, _ in back] == [(role, text)]:
            return out
    raise Broken(f"a turn that can't be rendered: {role[:40]!r}")


# Code points of a text by which rows of one turn and role are parted.
PARTED_CHARS = 256
FORMATTED = "conv_id long, chunk long, n_turns int, formatted string, mask array<struct<start:int,end:int>>"
_MASK = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, n_turns, formatted, mask): conversations rendered in order, in chunks; mask has the places of trained texts.

    Rows (conv_id, turn, role, text) are ranged by conversation and turn, so a conversation of any length
    is shared by tasks; the chunks of one are in order of ``chunk``. Null role and text are empty, a null
    turn comes first, rows with the same turn follow by role and text; rows without conv_id are one
    conversation without id. Every chunk is parsed once more as a whole.
    """
    ready(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # rows of one turn may be parted by role and text, never by chance, and in the order of the texts; the driver holds
    # a sample of what is ranged by, so texts are parted by their first characters
    order = ["conv_id", "turn", "role", F.substring("text", 1, PARTED_CHARS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv, parts, source, chars, out = TaskContext.get().partitionId() << 32, None, [], [], 0, []

        def chunk():
            nonlocal key
            rendered = "".join(parts)
            back = parse(rendered)
            if [(r, t) for r, t, _, _ in back] != source:
                raise Broken(f"conversation {conv} doesn't parse to its turns")
            mask = [{"start": a, "end": b} for r, _, a, b in back if r == TRAINED]
            out.append((conv, key, len(source), rendered, mask))
            key += 1

        def rows_out():
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), _MASK)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "chunk", "n_turns", "formatted", "mask"])

        for batch in batches:
            for c, role, text in zip(*(column(batch, n).to_pylist() for n in ("conv_id", "role", "text"))):
                if source and (c != conv or len(source) == CHUNK_TURNS or chars + len(text) > CHUNK_CHARS):
                    chunk()
                    parts, source, chars = [], [], 0
                conv = c
                parts.append(render(role, text))
                source.append((role, text))
                chars += len(text)
            if out:
                yield rows_out()
                out = []
        if source:
            chunk()
        if out:
            yield rows_out()

    return rows.repartitionByRange(*order).sortWithinPartitions(*order[:3], "text").mapInArrow(run, FORMATTED)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def chat_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its chunks by the parser.

    A digest runs over a conversation from its first turn to its last, so the chunks of one go through
    one task, in order; they are hashed as they pass and none is held.
    """
    ready(formatted.sparkSession)
    names = [c.split()[0] for c in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def ended():
            return (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])

        for batch in batches:
            out = []
            for conv, rendered, mask in zip(*(column(batch, n).to_pylist() for n in ("conv_id", "formatted", "mask"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(ended())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(rendered):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode("utf-8"))
                for span in mask:
                    text = unescape(rendered[span["start"] : span["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode("utf-8"))
                now[5] += len(rendered)
            if out:
                yield _digest_rows(out, names)
        if now is not None:
            yield _digest_rows([ended()], names)

    return formatted.select("conv_id", "chunk", "formatted", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(run, DIGESTS)


def _digest_rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("256") else pa.int64()) for n, c in zip(names, zip(*rows))], names)


def round_trip(turns: DataFrame) -> DataFrame:
    """Format, write, read back: `chat_digests` of the written chunks. An empty table gives no row; other columns are not read."""
    return chat_digests(saved(format_chats(turns), "chats"))
