"""Secret scans through nested encodings: a worklist of decoded layers, each scanned again and mapped to the text."""

from __future__ import annotations

import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deslinde.llm.common import column, ready

# The kinds of secret and their patterns, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# A text without any of these has no assignment.
WORDS = ("passw", "secret", "token", "api")

PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|&#[xX]([0-9A-Fa-f]+);|&#([0-9]+);")
BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
# Base64 over several lines; the last one may be short.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{16,}+)*\r?\n[ \t]*[A-Za-z0-9+/_-]++={0,2}")
# A compressed stream quoted for a URL, in which letters and digits stand for themselves.
QUOTED = re.compile(r"(?:%1[fF]%8[bB]|x%(?:01|5[eE]|9[cC]|[dD][aA])|BZh[1-9]|%[fF][dD]7zXZ%00)(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()/-])*")
# First bytes of compressed streams.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
# Long runs of letters and digits in small letters, and marks of escapes: what a further encoding or a number is made of.
LONG = re.compile(rb"[a-z0-9+/_-]{16}|%[0-9a-f]{2}|\\[ux]|&#")
LONGER = re.compile(rb"[a-z0-9+/]{24}")
# What a compressed stream unpacks to is looked at in pieces of this size, each of which begins inside the one before.
PIECE = 4 << 20
OVERLAP = 1 << 16
STEP = 1 << 20

Span = tuple[int, int, int]  # start, number of the kind, end


def scan(text: str) -> list[Span]:
    """Secrets in one text, leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed chunks unpack to, member after member, up to the first byte that is none."""
    made, rest = None, b""
    try:
        for chunk in chunks:
            rest += chunk
            while rest:
                if made is None:
                    if not MAGIC.match(rest):
                        return
                    made = {31: lambda: zlib.decompressobj(31), 120: zlib.decompressobj, 66: bz2.BZ2Decompressor}.get(rest[0], lzma.LZMADecompressor)()
                out, rest = made.decompress(rest, STEP), b""
                if out:
                    yield out
                while not made.eof and not getattr(made, "needs_input", not getattr(made, "unconsumed_tail", b"")):
                    out = made.decompress(getattr(made, "unconsumed_tail", b""), STEP)
                    if out:
                        yield out
                if made.eof:
                    rest, made = made.unused_data, None
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return


def _plain(data: bytes) -> Iterator[bytes]:
    """Chunks of what is left when compression is undone layer by layer; nothing where that goes in a circle."""
    chunks, seen = iter([data]), set()
    while True:
        first = next(chunks, b"")
        if not MAGIC.match(first):
            return itertools.chain([first], chunks)
        digest = hashlib.sha256(first).digest()
        if digest in seen:
            return iter([])
        seen.add(digest)
        chunks = _inflated(itertools.chain([first], chunks))


def _pieces(chunks: Iterator[bytes], size: int) -> Iterator[bytes]:
    """Chunks joined to pieces of about ``size``, each with the end of the one before."""
    held, count, overlap = [], 0, min(OVERLAP, size // 2)
    for chunk in chunks:
        held.append(chunk)
        count += len(chunk)
        if count >= size:
            piece = b"".join(held)
            yield piece
            held, count = [piece[-overlap:]], 0
    if count:
        yield b"".join(held)


def _promising(data: bytes, run: re.Pattern[bytes]) -> bool:
    """Can a secret or a further encoding be in these bytes? ``run`` is what the latter has to hold."""
    low = data.lower()
    return b"passw" in low or b"secret" in low or b"token" in low or b"api" in low or b"akia" in low or run.search(low) is not None


def _text(data: bytes) -> str | None:
    """Bytes as text: UTF-8, UTF-16, else a character a byte; None where nothing can be in it."""
    try:
        text = data.decode("utf-8")
        if text.isprintable() or all(c.isprintable() or c in "\t\n\r\f\v" for c in text):
            return text or None
    except UnicodeDecodeError:
        text = None
    zeros = [data[k : 4096 : 2].count(0) * 4 for k in (0, 1)]
    half = min(len(data), 4096) // 2
    if data[:2] in (b"\xff\xfe", b"\xfe\xff") or max(zeros) > half and min(zeros) < half:
        big = data[:2] == b"\xfe\xff" or data[:2] != b"\xff\xfe" and zeros[0] > zeros[1]
        wide = data.decode("utf-16-be" if big else "utf-16-le", "replace")
        if _promising(wide.encode("utf-8", "replace"), LONG):
            return wide
    if not _promising(data, LONG):
        return None
    return text if text is not None else data.decode("latin-1")


# A decoded run: either characters with their places in it, or pieces of a stream that all stand for the whole run.
Decoded = list[tuple[str, int, int]] | Iterator[str] | None


def _whole(data: bytes, length: int, size: int) -> Decoded:
    """Decoded bytes that stand for a whole run: one text, or the pieces of a large one."""
    pieces = _pieces(_plain(data), size)
    first, second = next(pieces, b""), next(pieces, None)
    if second is None:
        text = _text(first)
        return [(text, 0, length)] if text else None
    return filter(None, map(_text, itertools.chain([first, second], pieces)))


def _percent(run: str, size: int) -> Decoded:
    """Characters of a run of %XX with their places in it; a byte that is no UTF-8 is a character of its own."""
    data = bytes.fromhex(run.replace("%", ""))
    if MAGIC.match(data) and (whole := _whole(data, len(run), size)):
        return whole
    out, at = [], 0
    for c in data.decode("utf-8", "surrogateescape"):
        lone = 0xDC80 <= ord(c) < 0xDD00
        n = 3 * (1 if lone else len(c.encode("utf-8")))
        out.append((chr(ord(c) - 0xDC00) if lone else c, at, at + n))
        at += n
    return out


def _escapes(run: str, size: int) -> Decoded:
    """Characters of a run of escapes with their places in it; surrogate pairs are one character, what is none is U+FFFD."""
    out: list[tuple[str, int, int]] = []
    for m in ESCAPE.finditer(run):
        code, begin = int(m[4]) if m[4] else int(m[1] or m[2] or m[3], 16), m.start()
        if out and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, begin, _ = out.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00
        out.append((chr(code) if code <= 0x10FFFF else "\ufffd", begin, m.end()))
    out = [("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c, a, b) for c, a, b in out]
    if all(ord(c) < 256 for c, _, _ in out):  # escaped bytes of a compressed stream
        data = bytes(ord(c) for c, _, _ in out)
        if MAGIC.match(data) and (whole := _whole(data, len(run), size)):
            return whole
    return out


def _quoted(run: str, size: int) -> Decoded:
    return _whole(unquote_to_bytes(run), len(run), size)


def _base64(skip: int):
    """Base64 read from the character ``skip`` on: what is glued to a word or a path begins at one of four places."""

    def decode(run: str, size: int) -> Decoded:
        body = run.encode().translate(_TO_BASE64, b"=\r\n \t")[skip:]
        odd = len(body) % 4 == 1
        body = body[: len(body) - odd]
        data = binascii.a2b_base64(body + b"=" * (-len(body) % 4))
        if skip == 0 and not odd and (whole := _whole(data, len(run), size)):
            return whole
        # behind what it is glued to, a stream begins somewhere
        for m in MAGIC.finditer(data):
            if (skip or m.start()) and (found := next(_inflated(iter([data[m.start() : m.start() + 4096]])), b"")) and len(found) > 3:
                return _whole(data[m.start() :], len(run), size)
        if skip:
            return [(data.decode("latin-1"), 0, len(run))] if _promising(data, LONGER) else None
        return None

    return decode


_TO_BASE64 = bytes.maketrans(b"-_", b"+/")
def _runs(text: str, kind: int) -> list:
    """Decodable runs of one kind: escapes, base64 at four alignments, base64 over lines, quoted streams."""
    if kind == 0:
        runs = [(m, _percent) for m in PERCENT.finditer(text)] if "%" in text else []
        if "\\" in text or "&#" in text:
            runs += [(m, _escapes) for m in ESCAPES.finditer(text)]
            runs.sort(key=lambda r: r[0].start())
        return runs
    if kind <= 4:
        return [(m, _base64(kind - 1)) for m in BASE64.finditer(text)]
    if kind == 5:
        return [(m, _base64(0)) for m in WRAPPED.finditer(text)]
    return [(m, _quoted) for m in QUOTED.finditer(text)] if "%" in text or "BZh" in text else []


KINDS_OF_RUNS = 7


def _unwrapped(text: str, starts, ends, kind: int, size: int, streams: list):
    """One layer less of one kind: the text with every decodable run replaced, and where its characters come from. None if there is none.

    Runs that unpack to more than a piece are left in place and put into ``streams`` with where they stand.
    """
    parts, froms, tos, last = [], [], [], 0
    for m, decode in _runs(text, kind):
        got = decode(m[0], size)
        if not got:
            continue
        a = m.start()
        if not isinstance(got, list):
            streams.append((got, a if starts is None else int(starts[a]), m.end() if ends is None else int(ends[m.end() - 1])))
            continue
        if starts is None:
            starts = np.arange(len(text))
            ends = starts + 1
        parts.append(text[last:a])
        froms.append(starts[last:a])
        tos.append(ends[last:a])
        for chars, x, y in got:
            parts.append(chars)
            froms.append(np.full(len(chars), starts[a + x]))
            tos.append(np.full(len(chars), ends[a + y - 1]))
        last = m.end()
    if not parts:
        return None
    return "".join([*parts, text[last:]]), np.concatenate([*froms, starts[last:]]), np.concatenate([*tos, ends[last:]])


def search(text: str, size: int = PIECE) -> tuple[list[Span], list[Span], int]:
    """(spans in the text itself, spans found below it, decoded layers).

    The worklist starts with the text. Every layer gives a child for each kind of encoding, with its runs undone (URL and
    Unicode escapes; base64 at four alignments and over lines, and compression inside; quoted streams); a layer seen before
    is not followed again, so the work ends at the fixpoint even where decoding runs in a circle. A secret in a layer is
    reported where the characters it came from stand in the text. A stream that unpacks to more than ``size`` bytes is
    unpacked step by step and looked at in overlapping pieces, each a layer; nothing of it is left out.
    """
    base = scan(text)
    seen, added, layers, work = None, set(), 0, [(text, None, None)]
    streams: list = []
    while work or streams:
        if not work:
            pieces, a, b = streams[-1]
            piece = next(pieces, None)
            if piece is None:
                streams.pop()
                continue
            layers += 1
            added.update((a, k, b) for _, k, _ in scan(piece))
            work.append((piece, np.full(len(piece), a), np.full(len(piece), b)))
        layer, starts, ends = work.pop()
        for kind in range(KINDS_OF_RUNS):
            child = _unwrapped(layer, starts, ends, kind, size, streams)
            if child is None:
                continue
            seen = seen or {hashlib.sha256(text.encode("utf-8")).digest()}
            digest = hashlib.sha256(child[0].encode("utf-8", "surrogatepass")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            layers += 1
            work.append(child)
            added.update((int(child[1][a]), k, int(child[2][b - 1])) for a, k, b in scan(child[0]))
    return base, sorted(added - set(base)), layers


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long, n_layers long"
)


def find_secrets(docs: DataFrame, piece_bytes: int = PIECE) -> DataFrame:
    """One row per document: counts by kind, digest of the spans in the text itself, and all spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind, then end. A null
    text is empty; a row without doc_id keeps a null id; repeated rows are answered each; an empty
    table gives no row; other columns are not read. Each text is scanned whole, in one narrow step.
    """
    ready(docs.sparkSession)
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, rows = column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist(), []
            for doc_id, text in zip(ids, texts):
                base, added, layers = search(text or "", piece_bytes)
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans = _joined(sorted(base + added))
                rows.append((doc_id, kinds.count(0), kinds.count(1), kinds.count(2), digest, spans, len(added), layers))
            kinds = [pa.string() if n in ("base_sha256", "spans") else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, FOUND)


MASK = "[REDACTED]"


def _masked(text: str, size: int) -> str:
    base, added, _ = search(text, size)
    out, last = [], 0
    for a, _, b in sorted(base + added):
        if b > last:
            if a >= last:
                out += [text[last:a], MASK]
            last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, piece_bytes: int = PIECE) -> DataFrame:
    """``docs``, all rows and columns, with every secret in ``text`` masked; ``n_chars``, where there is one, follows.

    Overlapping spans are masked as one. A null text stays null.
    """
    ready(docs.sparkSession)
    mask = F.pandas_udf(lambda texts: texts.map(lambda t: None if t is None else _masked(t, piece_bytes)), "string")
    out = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
