"""Approximate nearest neighbours: p-stable hash tables, several buckets of each visited in order of estimated success."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deslinde.llm.common import column, mix, ready

# Index rows that one group of buckets is planned for; a bucket above HOT_ROWS is dealt over several groups.
GROUP_ROWS, HOT_ROWS, MOST_HOT = 20_000, 8_192, 100_000
# Recall is measured on so many queries against all vectors before the search; it has to reach AIM there (0.9 is asked).
SAMPLE, AIM = 256, 0.95
# Probes may grow to so many times the planned ones, then the functions get fewer.
MOST_GROWTH = 16


@dataclass(frozen=True)
class Settings:
    """``tables`` hash tables of ``functions`` p-stable functions of ``width``; ``probes`` buckets of each are visited.

    Left out, functions and probes follow the number of vectors: 0.9 * log2(rows) functions keep the
    buckets small as a table grows, with 8 probes for each and 0.6 for each pair of them at first. That alone
    loses recall with size, so `calibrated` adds probes, or takes functions away, by the recall of a sample.
    """

    tables: int = 20
    width: float = 2.5
    functions: int = 0
    probes: int = 0
    seed: int = 11

    def sized(self, rows: int) -> Settings:
        m = self.functions or max(1, round(0.9 * math.log2(max(2, rows))))
        return replace(self, functions=m, probes=self.probes or round(8 * m + 0.6 * m * m))


def probing_sequence(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of perturbations in order of expected score, the empty one first.

    A query's 2 * functions distances to the borders of its bucket are ranked; a set names ranks. The
    score of a set is the sum of the expected squares of its distances, small when a near vector is
    likely behind these borders. Sets grow from a heap by moving their last rank on or adding the next
    one; a set that would cross both borders of one function is left out.
    """
    m = functions
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = (1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2)))[::-1]
    expected = np.concatenate([near, far])
    out, heap = [()], [(float(expected[0]), (0,))]
    while heap and len(out) < probes:
        score, ranks = heapq.heappop(heap)
        if len({min(r, 2 * m - 1 - r) for r in ranks}) == len(ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            step = float(expected[last + 1])
            heapq.heappush(heap, (score - float(expected[last]) + step, (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (score + step, (*ranks, last + 1)))
    return out


class Tables:
    """The hash functions of all tables, for unit vectors of one dimension."""

    def __init__(self, settings: Settings, dimension: int):
        rng = np.random.default_rng(settings.seed)
        self.settings, (t, m) = settings, (settings.tables, settings.functions)
        self.lines = rng.normal(size=(dimension, t * m))
        self.shifts = rng.uniform(0, settings.width, t * m)
        self.times = rng.integers(1, 1 << 62, (t, m)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.names = mix(np.arange(1, t + 1, dtype=np.uint64))
        self.sequence = probing_sequence(m, settings.probes)

    def _placed(self, unit: np.ndarray):
        at = ((unit @ self.lines + self.shifts) / self.settings.width).reshape(len(unit), *self.times.shape)
        floor = np.floor(at)
        sums = (floor.astype(np.int64).view(np.uint64) * self.times).sum(axis=2, dtype=np.uint64)
        return at - floor, sums

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each vector in each table."""
        return mix(self._placed(unit)[1] + self.names)

    def probes(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables, probes): the buckets to visit, likeliest first."""
        inside, sums = self._placed(unit)
        ranked = np.argsort(np.concatenate([inside, 1 - inside], axis=2), axis=2, kind="stable")
        times = np.broadcast_to(self.times, inside.shape)
        moves = np.concatenate([np.uint64(0) - times, times], axis=2)  # a step down over the lower border, or up
        moves = np.take_along_axis(moves, ranked, axis=2)
        out = np.repeat(sums[:, :, None], len(self.sequence), axis=2)
        for k, ranks in enumerate(self.sequence):
            for r in ranks:
                out[:, :, k] += moves[:, :, r]
        return mix(out + self.names[None, :, None])


def ranks(tables: Tables, asked: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each pair of unit vectors the least number of probes by which some table's bucket of the second is visited for the first."""
    t, m = tables.times.shape
    position = {s: k + 1 for k, s in enumerate(tables.sequence)}
    out = np.full(len(asked), np.iinfo(np.int64).max)
    for a in range(0, len(asked), 256):
        at, to = (((x[a : a + 256] @ tables.lines + tables.shifts) / tables.settings.width).reshape(-1, t, m) for x in (asked, near))
        floor = np.floor(at)
        inside, moves = at - floor, np.floor(to) - floor
        place = np.argsort(np.argsort(np.concatenate([inside, 1 - inside], axis=2), axis=2, kind="stable"), axis=2)
        for row, table in np.argwhere((np.abs(moves) <= 1).all(axis=2)):
            own = moves[row, table]
            crossed = np.concatenate([np.flatnonzero(own < 0), np.flatnonzero(own > 0) + m])
            rank = position.get(tuple(sorted(place[row, table, crossed].tolist())))
            if rank is not None:
                out[a + row] = min(out[a + row], rank)
    return out


def calibrated(settings: Settings, rows: int, asked: np.ndarray, near: np.ndarray) -> Settings:
    """Settings for ``rows`` vectors by which a share of AIM of the pairs (query, true neighbour) is met, never fewer probes than planned.

    Functions or probes that are given stay as they are.
    """
    planned = settings.sized(rows)
    if settings.probes or not len(asked):
        return planned
    while True:
        most = replace(planned, probes=MOST_GROWTH * planned.probes)
        needed = np.sort(ranks(Tables(most, asked.shape[1]), asked, near))[math.ceil(AIM * len(asked)) - 1]
        if needed <= most.probes:
            return replace(planned, probes=max(planned.probes, int(needed)))
        if settings.functions or planned.functions == 1:
            return most
        planned = replace(settings, functions=planned.functions - 1).sized(rows)


def _matrix(array: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return np.asarray(array.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(array), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same for equal rows wherever they stand."""
    top = (a * b).sum(axis=1)
    return top / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector, size) of the vectors that can take part: not null, without null or non-finite components, not zero."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where("vec_id is not null and vector is not null").where(~bad & some).withColumn("size", F.size("vector"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` found vectors of largest cosine, other than its own id.

    Nearest first, equal scores by smaller vec_id; fewer than ``k`` where there are no more. Rows whose
    vector is null, zero or holds a null or non-finite component take no part, nor do rows without an
    id and vectors of another length than the most frequent one. Repeated rows count once. Of equal
    vectors only the k + 1 smallest ids are indexed, as no others can be among k answers. Empty tables
    give no row; other columns are not read. Probes follow the recall of SAMPLE queries, whose neighbours
    among all vectors are found by brute force in one pass.

    Every vector is a row under its bucket of each table. Buckets are dealt to groups, large buckets to
    several; a query goes once to each group that holds buckets it visits. A group compares its queries
    with its vectors bucket by bucket and keeps k for each query, so candidates never leave it.
    """
    spark = ready(vectors.sparkSession)
    good = usable(vectors, id_column, vector_column)
    common = good.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    answer = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], answer)
    size, rows = common["size"], common["count"]
    good = good.where(F.col("size") == size).select("vec_id", "vector")
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    index = good.dropDuplicates(["vec_id", "vector"]).withColumn("turn", turn).where(F.col("turn") <= k + 1).select("vec_id", "vector")
    asked = usable(queries, id_column, vector_column).where(F.col("size") == size).select("vec_id", "vector").dropDuplicates(["vec_id"])
    settings = calibrated(settings, rows, *([np.zeros((0, size))] * 2 if settings.probes else _true_pairs(index, asked, k, size)))

    counts = index.mapInArrow(_cells_only(settings, size), "cell long").groupBy("cell").count()
    least = max(HOT_ROWS, rows * settings.tables // MOST_HOT)
    hot = counts.where(F.col("count") > least).collect()  # fewer than MOST_HOT buckets can be that large
    shares = {r["cell"]: -(-r["count"] // least) for r in hot}
    groups = max(1, -(-rows * settings.tables // GROUP_ROWS))

    left = index.mapInArrow(_index_rows(settings, size, shares, groups), "grp int, cell long, vec_id long, vector array<double>")
    right = asked.mapInArrow(_query_rows(settings, size, shares, groups), "grp int, query_id long, vector array<double>, cells array<long>")
    found = left.groupBy("grp").cogroup(right.groupBy("grp")).applyInArrow(_compared(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _true_pairs(index: DataFrame, asked: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of SAMPLE queries, each beside those of its k nearest by brute force."""
    some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    ids = np.array([r["vec_id"] for r in some], np.int64)
    own = _unit(np.array([r["vector"] for r in some], np.float64).reshape(-1, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0, size))]
        for batch in batches:
            if not len(batch):
                continue
            vec_ids, unit = column(batch, "vec_id").to_numpy(), _unit(_matrix(column(batch, "vector")))
            score = own @ unit.T
            score[ids[:, None] == vec_ids] = -3.0
            few = np.argsort(-score, axis=1, kind="stable")[:, :k]
            more = [np.take_along_axis(score, few, axis=1), vec_ids[few], unit[few]]
            best = [np.concatenate(x, axis=1) for x in zip(best, more)]
            few = np.lexsort((best[1], -best[0]), axis=1)[:, :k]
            best = [np.take_along_axis(best[0], few, axis=1), np.take_along_axis(best[1], few, axis=1), np.take_along_axis(best[2], few[:, :, None], axis=1)]
        query, spot = np.nonzero(best[0] > -2.0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query, pa.int32()), pa.array(best[0][query, spot]), pa.array(best[1][query, spot]),
                pa.array(list(best[2][query, spot]), pa.list_(pa.float64())),
            ],
            ["query", "score", "vec_id", "vector"],
        )

    met = index.mapInArrow(run, "query int, score double, vec_id long, vector array<double>")
    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    pairs = met.withColumn("turn", turn).where(F.col("turn") <= k).select("query", "vector").collect() if len(ids) else []
    return own[[r["query"] for r in pairs]], np.array([r["vector"] for r in pairs], np.float64).reshape(-1, size)


def _cells_only(settings: Settings, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(settings, size)
        for batch in batches:
            if len(batch):
                cells = tables.cells(_unit(_matrix(column(batch, "vector"))))
                yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1).view(np.int64))], ["cell"])

    return run


def _group_of(cells: np.ndarray, share: np.ndarray, groups: int) -> np.ndarray:
    return (mix(cells.view(np.uint64) + share.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)).astype(np.int32)


def _index_rows(settings: Settings, size: int, shares: dict[int, int], groups: int):
    hot = np.array(sorted(shares), np.int64)
    times = np.array([shares[c] for c in hot.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(settings, size)
        for batch in batches:
            if not len(batch):
                continue
            cells = np.ascontiguousarray(tables.cells(_unit(_matrix(column(batch, "vector"))))).view(np.int64)
            ids = column(batch, "vec_id").to_numpy()
            share = np.zeros(cells.shape, np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, cells), len(hot) - 1)
                own = mix(ids.view(np.uint64))[:, None] % times[at].astype(np.uint64)
                share = np.where(hot[at] == cells, own.astype(np.int64), 0)
            flat = cells.reshape(-1)
            order = np.repeat(np.arange(len(ids)), cells.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_group_of(flat, share.reshape(-1), groups)), pa.array(flat), pa.array(ids[order]),
                    column(batch, "vector").take(pa.array(order)),
                ],
                ["grp", "cell", "vec_id", "vector"],
            )

    return run


def _query_rows(settings: Settings, size: int, shares: dict[int, int], groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(settings, size)
        hot = np.array(sorted(shares), np.int64)
        for whole in batches:
            for start in range(0, len(whole), 64):
                batch = whole.slice(start, 64)
                probes = tables.probes(_unit(_matrix(column(batch, "vector")))).reshape(len(batch), -1).view(np.int64)
                rows, ids, vectors = [], column(batch, "vec_id").to_pylist(), column(batch, "vector")
                for k, cells in enumerate(probes):
                    cells = np.unique(cells)
                    share = np.zeros(len(cells), np.int64)
                    for c in cells[np.isin(cells, hot)].tolist():
                        more = np.arange(1, shares[c])
                        cells, share = np.append(cells, np.full(len(more), c)), np.append(share, more)
                    grp = _group_of(cells, share, groups)
                    order = np.argsort(grp, kind="stable")
                    borders = np.flatnonzero(np.diff(grp[order])) + 1
                    for part in np.split(order, borders):
                        rows.append((int(grp[part[0]]), k, cells[part]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()), pa.array([ids[r[1]] for r in rows], pa.int64()),
                        vectors.take(pa.array([r[1] for r in rows], pa.int64())),
                        pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[2]) for r in rows)]), pa.int32()), pa.array(np.concatenate([r[2] for r in rows]))),
                    ],
                    ["grp", "query_id", "vector", "cells"],
                )

    return run


def _compared(k: int, block: int = 256):
    """Of one group of buckets: for each query its k best vectors, as (query_id, vec_id, score)."""
    names = ["query_id", "vec_id", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        if not len(left) or not len(right):
            return none
        cell, ids = left["cell"].to_numpy(), left["vec_id"].to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, ids, vectors = cell[order], ids[order], _matrix(left["vector"])[order]
        cells, starts = np.unique(cell, return_index=True)
        ends = np.append(starts[1:], len(cell))
        query_ids, asked = right["query_id"].to_numpy(), _matrix(right["vector"])
        units, own = _unit(vectors), _unit(asked)
        lists = right["cells"].combine_chunks()
        who = np.repeat(np.arange(len(query_ids)), np.diff(lists.offsets.to_numpy()))
        what = lists.flatten().to_numpy()
        at = np.minimum(np.searchsorted(cells, what), len(cells) - 1)
        met = cells[at] == what
        who, at = who[met], at[met]
        turn = np.argsort(at, kind="stable")
        who, at = who[turn], at[turn]
        floor = np.full(len(query_ids), -2.0)  # each query's k-th best so far, a bound for what can still be an answer
        kept = []
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
            if not len(part):
                continue
            a, b = starts[at[part[0]]], ends[at[part[0]]]
            for s in range(0, len(part), block):
                rows = who[part[s : s + block]]
                near = own[rows] @ units[a:b].T
                near[query_ids[rows][:, None] == ids[a:b]] = -3.0
                if b - a > k:
                    floor[rows] = np.maximum(floor[rows], np.partition(near, b - a - k, axis=1)[:, b - a - k])
                r, c = np.nonzero(near >= floor[rows][:, None] - 1e-9)
                kept.append((rows[r], c + a))
        if not kept:
            return none
        rows, spots = np.concatenate([x[0] for x in kept]), np.concatenate([x[1] for x in kept])
        fine = query_ids[rows] != ids[spots]
        rows, spots = rows[fine], spots[fine]
        score = np.concatenate([np.zeros(0), *(cosine(asked[rows[s : s + 8192]], vectors[spots[s : s + 8192]]) for s in range(0, len(rows), 8192))])
        turn = np.lexsort((ids[spots], -score, rows))
        rows, spots, score = rows[turn], spots[turn], score[turn]
        new = np.r_[True, (np.diff(rows) != 0) | (np.diff(ids[spots]) != 0)][: len(rows)]  # a vector met in several tables
        rows, spots, score = rows[new], spots[new], score[new]
        first = np.searchsorted(rows, rows, "left")
        best = np.arange(len(rows)) - first < k
        return pa.table([pa.array(query_ids[rows[best]]), pa.array(ids[spots[best]]), pa.array(score[best])], names=names)

    return run
