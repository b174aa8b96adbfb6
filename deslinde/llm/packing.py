"""Packing documents into training windows by multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from deslinde.llm.common import column, ready, texts_of
from deslinde.llm.tokens import VOCABULARY, shared

CAPACITY = 2048
# Windows that one differencing levels; with their tokens it bounds what a task holds.
WINDOWS = 128
# Tokens a window is planned short of its capacity, so that nearly equal windows all fit.
SLACK = 3
# The largest piece of a document that is levelled, and the small change that levels the rest.
LARGEST, CHANGE, CHANGE_SHARE = 512, (32, 16, 8, 4, 2, 1), 24
END_ID = 1

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


def level(sizes: list[int], windows: int) -> list[list[int]]:
    """Spread items over ``windows`` windows of nearly equal sums: Karmarkar-Karp multiway differencing.

    The items, largest first, start as partial partitions of one item per window. The two
    partitions with the widest spread are merged again and again, the fullest windows of one
    onto the emptiest of the other, so that their imbalances cancel. Returns the item numbers
    of each window.
    """
    order = np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    turns = -(-len(sizes) // windows)
    items = np.full(turns * windows, -1, np.int64)
    items[: len(sizes)] = order
    sums = np.append(np.asarray(sizes, np.int64), 0)[items].reshape(turns, windows)
    # one row of item numbers per partition already merged in; windows run from the fullest to the emptiest
    heap = [(-int(s[0] - s[-1]), k, s, [i]) for k, (s, i) in enumerate(zip(sums, items.reshape(turns, windows)))]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, k, a, held = heapq.heappop(heap)
        _, _, b, more = heap[0]
        both = a + b[::-1]
        by_sum = np.argsort(-both, kind="stable")
        both = both[by_sum]
        rows = [r[by_sum] for r in held] + [r[::-1][by_sum] for r in more]
        heapq.heapreplace(heap, (int(both[-1] - both[0]), k, both, rows))
    if not heap:
        return [[] for _ in range(windows)]
    return [[i for i in x if i >= 0] for x in np.array(heap[0][3]).T.tolist()]


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the sum asks for, and more whenever the fullest one exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        held = level(sizes, windows)
        if max(sum(sizes[i] for i in x) for x in held) <= capacity:
            return [x for x in held if x]
        windows += 1


class Packer:
    """Takes documents one after another; gives the rows of pieces as blocks fill up."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, windows: int = WINDOWS, slack: int = SLACK):
        self.capacity, self.windows = capacity, windows
        self.room = windows * (capacity - slack)
        self.slack = slack
        self.sequence = first_sequence
        self.held: list[tuple[int | None, int, int, bytes]] = []  # doc_id, tokens of the document, start, ids
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[pa.RecordBatch]:
        total, start = len(ids) // 4, 0
        while start < total:
            n = min(total - start, self.room - self.tokens)
            self.held.append((doc_id, total, start, ids[4 * start : 4 * (start + n)]))
            self.tokens += n
            start += n
            if self.tokens == self.room:
                yield self._block(self.room)

    def end(self) -> Iterator[pa.RecordBatch]:
        """The last block: level its whole windows; what is left over goes to sequences whose lengths are powers of two."""
        whole = self.tokens // self.capacity
        if whole:
            yield self._block(min(self.tokens, whole * (self.capacity - self.slack)))
        while self.tokens:
            size = min(1 << (self.tokens.bit_length() - 1), 1 << (self.capacity.bit_length() - 1))
            yield self._rows([self._taken(size)])

    def _taken(self, tokens: int) -> list[tuple]:
        """The first ``tokens`` tokens held, as cuts of documents."""
        out, left = [], tokens
        while left:
            doc_id, total, start, ids = self.held.pop(0)
            n = min(left, len(ids) // 4)
            out.append((doc_id, total, start, ids[: 4 * n]))
            if 4 * n < len(ids):
                self.held.insert(0, (doc_id, total, start + n, ids[4 * n :]))
            left -= n
        self.tokens -= tokens
        return out

    def _block(self, tokens: int) -> pa.RecordBatch:
        """Level the first ``tokens`` tokens: whole stretches of documents first, the last few of the block as small change."""
        cuts = self._taken(tokens)
        change = min(tokens // 8, CHANGE_SHARE * -(-tokens // self.capacity))
        pieces, seen, turn = [], 0, 0
        for doc_id, total, start, ids in cuts:
            n, at = len(ids) // 4, 0
            while at < n:
                before = tokens - change - seen
                size = min(n - at, LARGEST, self.capacity, before) if before > 0 else min(n - at, CHANGE[turn % len(CHANGE)])
                turn += before <= 0
                pieces.append((doc_id, total, start + at, ids[4 * at : 4 * (at + size)]))
                at += size
                seen += size
        held = fill([len(p[3]) // 4 for p in pieces], self.capacity)
        return self._rows([[pieces[i] for i in sorted(x)] for x in held])

    def _rows(self, sequences: list[list[tuple]]) -> pa.RecordBatch:
        rows = []
        for sequence in sequences:
            offset, last = 0, None
            for doc_id, total, start, ids in sequence:
                n = len(ids) // 4
                if last and last[0] == doc_id and last[4] == total and last[1] + last[2] == start and start:
                    last[2] += n
                    last[3] = zlib.crc32(ids, last[3])
                else:
                    last = [doc_id, start, n, zlib.crc32(ids), total, self.sequence, offset]
                    rows.append(last)
                offset += n
            self.sequence += 1
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_SCHEMA)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, windows: int = WINDOWS) -> DataFrame:
    """Cut every document's ids (its text's, then id 1) into pieces and pack these into sequences of at most ``capacity``.

    One row per piece. Each task packs the rows of its partition as they stream by, a block of
    ``windows`` windows at a time, so nothing is shuffled and memory is bounded by a block and
    one text. Sequence ids hold the partition in their high bits; a task that runs again gives
    the same rows. A null or empty text is its end id alone; a row without an id keeps a null
    id; repeated rows are packed each; an empty table gives no row; other columns are not read.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = shared(vocabulary), int(END_ID).to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << 36, capacity, windows)
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            raw, at = texts_of(column(batch, "text"))
            for k, doc_id in enumerate(ids):
                yield from packer.add(doc_id, coder.ids(raw[at[k] : at[k + 1]].tobytes()) + end)
        yield from packer.end()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, PIECES)
