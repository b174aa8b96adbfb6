"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deslinde.llm.common import column, fresh, mix, pieces_of, ready, texts_of, words_of

# A tile has this many words at least; a test item this share of its words in tiles is leaked.
LEAST, COVERAGE = 5, 0.5
# Words of test items that one pass over the documents looks for; larger benchmarks take several passes.
BLOCK_WORDS = 1_000_000

TILES = "doc_id long, item_id long, item_words long, covered_words long, tiles long, coverage double"
_NAMES = [c.split()[0] for c in TILES.split(", ")]
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The Karp-Rabin hash of every run of ``width`` words, rolled over the whole text at once."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    rolled = words[:n].copy()
    for k in range(1, width):
        rolled *= _TIMES
        rolled += words[k : k + n]
    return mix(rolled)


def _longest(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """All matches of the longest length between unmarked words, as (length, place in item, place in document).

    Seeds of ``least`` words are joined by their hash; seeds one word apart on the same diagonal are
    one match, whose length is then the number of seeds in the run plus ``least`` - 1.
    """
    found = _seeds(doc, item, free_doc, free_item, least)
    if not len(found[0]):
        return []
    at_item, at_doc = found
    order = np.lexsort((at_item, at_doc - at_item))
    at_item, at_doc = at_item[order], at_doc[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(at_doc - at_item) != 0) | (np.diff(at_item) != 1)])
    lengths = np.diff(np.r_[starts, len(at_item)]) + least - 1
    best = lengths.max()
    some = starts[lengths == best]
    return sorted(zip([int(best)] * len(some), at_item[some].tolist(), at_doc[some].tolist()))


def _seeds(doc, item, free_doc, free_item, least):
    """Places in item and document of equal runs of ``least`` unmarked words."""

    def open_runs(free):
        marked = np.r_[0, np.cumsum(~free)]
        return marked[least:] == marked[:-least]

    a, b = window_hashes(item, least), window_hashes(doc, least)
    pa_, pb = np.flatnonzero(open_runs(free_item)), np.flatnonzero(open_runs(free_doc))
    a, b = a[pa_], b[pb]
    order = np.argsort(a, kind="stable")
    a, pa_ = a[order], pa_[order]
    low, high = np.searchsorted(a, b, "left"), np.searchsorted(a, b, "right")
    times = high - low
    total = int(times.sum())
    rank = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
    return pa_[np.repeat(low, times) + rank], np.repeat(pb, times)


def tile(doc: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: mark the longest matches of unmarked words, again and again.

    Of equally long matches the first in the item, then in the document, goes first; one that
    overlaps a tile just marked waits for the next turn. Returns (length, place in item, place in document).
    """
    free_doc, free_item, tiles = np.ones(len(doc), bool), np.ones(len(item), bool), []
    if len(item) < least or len(doc) < least:
        return tiles
    while True:
        matches = _longest(doc, item, free_doc, free_item, least)
        if not matches:
            return tiles
        for length, i, d in matches:
            if free_item[i : i + length].all() and free_doc[d : d + length].all():
                free_item[i : i + length] = False
                free_doc[d : d + length] = False
                tiles.append((length, i, d))


class Bench:
    """Test items of one block: their words and the seeds that lead to them."""

    def __init__(self, ids: list[int], texts: list[str], least: int):
        raw, at = texts_of(pa.array(texts, pa.string()))
        words = words_of(raw, at, alnum_only=True)
        self.least, self.ids = least, ids
        self.items = [words.hashes[words.first[k] : words.first[k + 1]] for k in range(len(ids))]
        seeds = [window_hashes(x, least) for x in self.items]
        owner = np.repeat(np.arange(len(ids)), [len(s) for s in seeds])
        every = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(every, kind="stable")
        self.seeds, self.owner = every[order], owner[order]
        bits = max(16, int(len(every) * 16).bit_length())
        self.shift = np.uint64(64 - bits)
        self.sieve = np.zeros(1 << bits, bool)
        self.sieve[(every >> self.shift).astype(np.int64)] = True

    def touched(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) of every seed that a test item has."""
        at = np.flatnonzero(self.sieve[(seeds >> self.shift).astype(np.int64)])
        low, high = np.searchsorted(self.seeds, seeds[at], "left"), np.searchsorted(self.seeds, seeds[at], "right")
        times = high - low
        rank = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), self.owner[np.repeat(low, times) + rank]

    def leaks(self, words: np.ndarray, seeds: np.ndarray, coverage: float) -> Iterator[tuple[int, int, int, int]]:
        """(item, words, covered, tiles) of the items that this document covers to ``coverage``."""
        place, item = self.touched(seeds)
        for k in np.unique(item).tolist():
            own, spots = self.items[k], place[item == k]
            # tiles lie where seeds are: words that no shared seed touches cannot be part of one
            near = np.unique((spots[:, None] + np.arange(self.least)).ravel())
            gaps = np.flatnonzero(np.diff(near) > 1) + 1
            part = np.insert(words[near], gaps, np.arange(1, len(gaps) + 1, dtype=np.uint64))  # a word of no item between them
            tiles = tile(part, own, self.least)
            covered = sum(t[0] for t in tiles)
            if covered >= coverage * len(own):
                yield k, len(own), covered, len(tiles)


def _blocks(benchmark: DataFrame, words: int) -> list[DataFrame]:
    """The benchmark in blocks of about ``words`` words, by item_id."""
    size = benchmark.select((F.sum(F.coalesce(F.length("text"), F.lit(0))) / 4).alias("n")).first()["n"] or 0
    blocks = max(1, int(-(-size // words)))
    return [benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) for k in range(blocks)] if blocks > 1 else [benchmark]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, tiles, coverage) of every document and test item it leaks.

    Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z as a-z.
    An item is leaked when tiles of ``least`` words or more cover ``coverage`` of its words, in
    any order. Only documents that share a seed with an item are tiled with it. The benchmark is
    the stated query set: a block of it (``block_words`` words, a few dozen MB) goes to the workers
    at a time, the documents are not shuffled. Null or empty texts, and items of fewer than
    ``least`` words, leak nothing; rows without an id keep a null id; repeated rows are answered each.
    """
    spark = ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    found = spark.createDataFrame([], TILES)
    for block in _blocks(items, block_words):
        rows = block.collect()  # one block, bounded by block_words
        bench = spark.sparkContext.broadcast(Bench([r["item_id"] for r in rows], [r["text"] for r in rows], least))
        found = found.unionByName(docs.mapInArrow(_search(bench, least, coverage), TILES))
    return found


def _search(bench, least: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bench.value
        for batch in batches:
            ids, rows = column(batch, "doc_id").to_pylist(), []
            raw, at = texts_of(column(batch, "text"))
            for a, b in pieces_of(at):
                w = words_of(raw[at[a] : at[b]], at[a : b + 1], alnum_only=True)
                seeds = window_hashes(w.hashes, least)
                # seeds over a border of documents are found and then left out, as each document asks for its own
                hit = np.flatnonzero(own.sieve[(seeds >> own.shift).astype(np.int64)])
                for k in np.unique(np.searchsorted(w.first, hit, "right") - 1).tolist():
                    first, last = int(w.first[k]), int(w.first[k + 1])
                    for item, size, covered, tiles in own.leaks(w.hashes[first:last], seeds[first : max(first, last - least + 1)], coverage):
                        rows.append((ids[a + k], own.ids[item], size, covered, tiles, covered / size))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if n != "coverage" else pa.float64()) for n, c in zip(_NAMES, zip(*rows))], _NAMES
                )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no test item; a row without doc_id stays."""
    key = fresh(docs, "leak_id")
    leaking = contaminated(docs, benchmark, **options).where("doc_id is not null").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(leaking, F.col("doc_id") == F.col(key), "left_anti")
