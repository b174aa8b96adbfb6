"""Word counts too large for one machine: words are numbered inside chunks of text, and looked up for a whole chunk at once."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A text is cut into words in steps of about this many bytes.
TEXT_STEP = 1 << 20


class Numbering(dict):
    """Numbers words in the order of their first appearance; number 0 is taken by ``first``."""

    def __init__(self, first: bytes):
        super().__init__({first: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def steps_of(text: bytes, gap: re.Pattern[bytes], most: int = TEXT_STEP) -> Iterator[bytes]:
    """``text`` in pieces of about ``most`` bytes, cut where ``gap`` is found; a longer word stays whole."""
    at = 0
    while len(text) - at > most:
        found = gap.search(text, at + most)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def packed_ids(ids: np.ndarray) -> bytes:
    """Numbers as two bytes each where they fit, else as four; `unpacked_ids` tells them apart by a leading byte."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"\x02" if small else b"\x04") + ids.astype(np.uint16 if small else np.uint32).tobytes()


def unpacked_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if data[0] == 2 else np.uint32, offset=1).astype(np.int64)


def counted(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, word, n): how often each word occurs, from the arrays ``words`` and ``counts`` of all chunks."""
    rows = chunks.select(*keys, F.explode(F.arrays_zip("words", "counts")).alias("_w"))
    return rows.groupBy(*keys, F.col("_w.words").alias("word")).agg(F.sum("_w.counts").alias("n"))


def numbered(words: DataFrame, keys: list[str], per_bucket: int = 4096) -> tuple[DataFrame, int]:
    """``words`` with a column ``id`` from 1, unique over ``keys``, and the number of bits that the largest id needs.

    Rows are numbered inside buckets of hashed keys, so no task sees more than a bucket; ids are dense up to
    the difference between the bucket sizes.
    """
    buckets = max(1, words.count() // per_bucket)
    rows = words.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    stride = rows.groupBy("_b").count().agg(F.max("count")).first()[0] or 1
    turn = F.row_number().over(Window.partitionBy("_b").orderBy(*keys))
    rows = rows.withColumn("id", (F.col("_b") * stride + turn).cast("int")).drop("_b")
    bits = (buckets * stride).bit_length()
    if bits > 31:
        raise ValueError(f"{buckets * stride} word numbers don't fit 31 bits; raise the least count")
    return rows, bits


def looked_up(chunks: DataFrame, words: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``chunks`` without their words but with ``known``: (pos, value) of the words of the chunk that ``words`` has.

    A join by word and one by chunk; a chunk asks once for each of its different words. ``words`` is
    unique by ``keys`` and word.
    """
    asked = chunks.select("chunk", *keys, F.posexplode("words").alias("pos", "word"))
    met = asked.join(words.select(*keys, "word", F.col(value).alias("value")), [*keys, "word"])
    known = met.groupBy("chunk").agg(F.collect_list(F.struct("pos", "value")).alias("known"))
    return chunks.drop("words", "counts").join(known, "chunk", "left")


def values_of(known: pa.Scalar, size: int) -> np.ndarray:
    """Value by number in the chunk (0 for number 0 and for words that aren't known)."""
    out = np.zeros(size, np.int64)
    if known.is_valid:
        pairs = known.values
        out[pairs.field("pos").to_numpy(zero_copy_only=False) + 1] = pairs.field("value").to_numpy(zero_copy_only=False)
    return out


# --- packed word lists --------------------------------------------------------------------------
#
# Where most words of a chunk have to be counted, its words travel as compressed lists, one for each bucket of hashed
# words, and the counts over all chunks come back in the order of the lists.


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _small(counts: np.ndarray) -> bytes:
    """Counts as a byte each, 255 pointing to a whole number behind."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _counts(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data[n:], "<i8")
    return counts


def buckets_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint16, len(words))


def packed_lists(words: list[bytes], counts: np.ndarray, place: np.ndarray) -> list[tuple[int, bytes]]:
    """(bucket, list) of the words, none of which holds a line end, with their counts, in the order of `order_of`."""
    order = order_of(place)
    edges = np.flatnonzero(np.diff(place[order].astype(np.int64), prepend=-1))
    out = []
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        mine = order[a:b]
        out.append((int(place[mine[0]]), squeezed(len(mine).to_bytes(4, "little") + _small(counts[mine]) + b"\n" + b"\n".join([words[k] for k in mine]))))
    return out


def order_of(place: np.ndarray) -> np.ndarray:
    """The places of words in the lists of all buckets, one list after the other."""
    return np.argsort(place, kind="stable")


def _unpacked_list(data: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = unsqueezed(data)
    n = int.from_bytes(raw[:4], "little")
    end = 4 + n + 8 * int((np.frombuffer(raw, np.uint8, n, 4) == 255).sum())
    return raw[end + 1 :].split(b"\n"), _counts(raw[4:end], n)


def _bucket_totals(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of one bucket: entries of each list, the word of every entry, its own count, the different words and their totals."""
    lists = [_unpacked_list(x.as_py()) for x in table["list"]]
    sizes = [len(w) for w, _ in lists]
    coded = pa.concat_arrays([pa.array(w, pa.large_binary()) for w, _ in lists]).dictionary_encode()
    word, own = coded.indices.to_numpy(), np.concatenate([c for _, c in lists])
    totals = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(totals, word, own)
    return sizes, word, own, coded.dictionary, totals


def bucket_words(lists: DataFrame, most: int) -> DataFrame:
    """(word, n) of the ``most`` most frequent words of every bucket, and in a row without a word (kinds, n): all that occur."""

    def run(table: pa.Table) -> pa.Table:
        _, _, _, words, totals = _bucket_totals(table)
        few = np.flatnonzero(totals)
        kinds, total = len(few), int(totals.sum())
        few = few[np.argsort(-totals[few], kind="stable")]
        if len(few) > most:  # with ties, so that the choice among them is not made here
            few = few[totals[few] >= totals[few[most - 1]]]
        return pa.table({
            "word": pa.array([None, *(w.as_py() for w in words.take(pa.array(few)))], pa.binary()).cast(pa.string()),
            "n": pa.array([total, *totals[few]], pa.int64()), "kinds": pa.array([kinds, *[0] * len(few)], pa.int64()),
        })

    return lists.groupBy("bucket").applyInArrow(run, "word string, n long, kinds long")


def bucket_replies(lists: DataFrame, numbers: dict[bytes, int], width: int) -> DataFrame:
    """(chunk, bucket, reply): for every list the values total * ``width`` + number (0 for words without one) in its order."""

    def run(table: pa.Table) -> pa.Table:
        sizes, word, _, words, totals = _bucket_totals(table)
        named = np.fromiter((numbers.get(w, 0) for w in words.to_pylist()), np.int64, len(words))
        values = (totals * width + named)[word].astype("<i8")
        ends = np.cumsum([0, *sizes])
        replies = [squeezed(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "reply": pa.array(replies, pa.binary())})

    return lists.groupBy("bucket").applyInArrow(run, "chunk long, bucket int, reply binary")


def replied(replies: pa.Scalar, place: np.ndarray) -> np.ndarray:
    """Values by number in the chunk, 0 for number 0."""
    out = np.zeros(len(place) + 1, np.int64)
    if len(place):
        rows = sorted((r["bucket"], r["reply"]) for r in replies.as_py())
        out[order_of(place) + 1] = np.concatenate([np.frombuffer(unsqueezed(r), "<i8") for _, r in rows])
    return out
