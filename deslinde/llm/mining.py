"""Hard negatives by threshold joins over inverted indexes whose light dimensions are left out.

Rows lie in groups of bounded size. A group's index holds, dimension by dimension, the rows that cannot be
ruled out without it: the last (light) dimensions of a row are left out where the norm of what is left out,
times the largest norm of an anchor there, stays below the threshold. Partial scores are added up along the
index; a pair is dropped when its partial score and the norms of what remains stay below the anchor's
threshold, and what survives is scored in whole numbers. A threshold starts high and is lowered only until the
anchor's windows are full, so most pairs are never finished.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde.llm.common import ready, saved

GROUP_ROWS = 1 << 14  # rows of a group
BLOCK_ROWS = 1 << 12  # anchors that travel as one row
BLOCKS = 16  # blocks of anchors that meet a group in one task
TOGETHER = 256  # anchors that are joined with a group at once
SLAB = 8  # dimensions whose products are added up at once
SHARES = (0.9, 0.7, 0.5, 0.35, 0.2, 0.1, 0.0)  # thresholds in turn, as shares of the largest score possible
MOST = 1 << 56  # no score is as large


def whole_rows(vectors: DataFrame, label: Column, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, label, vector, size): the rows that take part, components as floor(scale x), equal rows once."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vector"),
    ).where("vec_id is not null and label is not null and size(vector) > 0")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True))).withColumn("vector", F.transform("vector", lambda x: F.floor(x * float(scale))))
    return rows.distinct().withColumn("size", F.size("vector"))


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _dealt(rows: DataFrame, groups: DataFrame, lists: list[str]) -> DataFrame:
    """Rows dealt to ``groups`` of their size, each packed as one row of binary arrays."""
    lists = ["vector", *lists]

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        arrays = {"ids": table["vec_id"].to_numpy(), "labels": table["label"].to_numpy(), **{x: _flat(table, x) for x in lists}}
        return pa.table({
            "size": pa.array([key[0].as_py()], pa.int32()), "grp": pa.array([key[1].as_py()], pa.int32()),
            **{k: pa.array([v.tobytes()], pa.binary()) for k, v in arrays.items()},
        })

    dealt = rows.join(groups, "size").withColumn("grp", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.col("groups")).cast("int"))
    schema = "size int, grp int, ids binary, labels binary, " + ", ".join(f"{x} binary" for x in lists)
    return dealt.select("size", "grp", "vec_id", "label", *lists).groupBy("size", "grp").applyInArrow(pack, schema)


class Rows:
    """Ids, labels, whole vectors and, of anchors, the windows of scores."""

    def __init__(self, packed: dict):
        get = {k: np.frombuffer(v, np.int64) for k, v in packed.items() if isinstance(v, bytes)}
        self.ids, self.labels = get["ids"], get["labels"]
        self.vector = get["vector"].reshape(len(self.ids), -1)
        if "lows" in get:
            self.lows, self.highs = get["lows"].reshape(len(self.ids), -1), get["highs"].reshape(len(self.ids), -1)


def _tails(x: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on."""
    squares = np.cumsum((x.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))


class Index:
    """Inverted index over whole vectors, heavy dimensions first; ``kind`` is a type in which their products are exact."""

    def __init__(self, vectors: np.ndarray, kind: type):
        self.order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order].astype(kind))
        self.tails = _tails(self.vectors)

    def reaching(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is the anchor's ``least`` or more."""
        own, size = anchors[:, self.order].astype(self.vectors.dtype), self.vectors.shape[1]
        tails, lowest = _tails(own), least.min(initial=MOST)
        # bounds carry a slack for their own rounding
        alone = self.tails * tails.max(axis=0, initial=0)[None, :] * (1 + 1e-9) + 1e-6
        kept = np.argmax(alone < lowest, axis=1) if lowest > 1 else np.full(len(alone), size)
        rows = np.flatnonzero(kept)
        rows = rows[np.argsort(-kept[rows], kind="stable")]
        kept, lists = kept[rows], self.vectors[rows]
        partial = np.zeros((len(own), len(rows)), own.dtype)
        for d in range(0, size, SLAB):
            n = int(np.searchsorted(-kept, -d))  # the lists of these dimensions hold the first n rows
            partial[:, :n] += own[:, d : d + SLAB] @ lists[:n, d : d + SLAB].T
        added = np.minimum(-(-kept // SLAB) * SLAB, size)
        rest = tails[:, added] * self.tails[rows, added] * (1 + 1e-9) + 1e-6
        at, place = np.nonzero(partial + rest >= least[:, None])
        score = np.empty(len(at), np.int64)
        for a in range(0, len(at), 1 << 16):
            step = slice(a, a + (1 << 16))
            score[step] = np.einsum("ij,ij->i", own[at[step]], lists[place[step]]).astype(np.int64)
        good = score >= least[at]
        return at[good], rows[place[good]], score[good]


def exact_kind(x: np.ndarray, y: np.ndarray) -> type:
    """A type in which all sums of products of rows of x and y are exact."""
    most = float(_tails(x)[:, 0].max(initial=0) * _tails(y)[:, 0].max(initial=0))
    if most >= MOST:
        raise ValueError("inner products pass 56 bits; use a smaller scale")
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**52 else np.int64


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: larger scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    begins = np.flatnonzero(np.diff(group[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < k]


def fill_windows(index: Index, rows: Rows, which: np.ndarray, anchors: Rows, asked: np.ndarray, k: int, same: bool):
    """(anchor, window, row, score): the k best of the rows ``which`` in each window of the anchors ``asked``.

    ``index`` is over the rows ``which``; rows have the anchor's label (``same``) or another one, and never its id.
    """
    lows, highs = anchors.lows, anchors.highs
    want = lows <= highs
    floors, tops = np.where(want, lows, MOST).min(axis=1), np.where(want, highs, -MOST).max(axis=1)
    tops = np.minimum(tops, np.ceil(_tails(anchors.vector)[:, 0] * index.tails[:, 0].max(initial=0)) + 1)
    asked = asked[want[asked].any(axis=1)]
    for a in range(0, len(asked), TOGETHER):
        left = asked[a : a + TOGETHER]
        for share in (*SHARES, None):
            if not len(left):
                break
            least = floors[left] if share is None else np.maximum(np.ceil(tops[left] * share).astype(np.int64), floors[left])
            at, place, score = index.reaching(anchors.vector[left], least)
            row = which[place]
            fits = ((rows.labels[row] == anchors.labels[left[at]]) == same) & (rows.ids[row] != anchors.ids[left[at]])
            at, row, score = at[fits], row[fits], score[fits]
            ended, inside = np.ones(len(left), bool), []
            for w in range(lows.shape[1]):
                inside.append((score >= lows[left[at], w]) & (score <= highs[left[at], w]))
                count = np.bincount(at[inside[w]], minlength=len(left))
                ended &= (count >= k) | (least <= lows[left, w]) | ~want[left, w]
            for w, mask in enumerate(inside):
                good = np.flatnonzero(mask & ended[at])
                best = good[first_of(at[good], score[good], rows.ids[row[good]], k)]
                yield left[at[best]], np.full(len(best), w), row[best], score[best]
            left = left[~ended]


def _mined(k: int, same: bool):
    """Of one group and the blocks of anchors that meet it: (anchor_id, turn, vec_id, score)."""

    def run(group: pa.Table, blocks: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 4]
        if len(group) and len(blocks):
            rows = Rows(group.to_pylist()[0])
            for packed in blocks.to_pylist():
                anchors = Rows(packed)
                kind = exact_kind(anchors.vector, rows.vector)
                # positives are sought among the rows of one label at a time
                for label in np.unique(anchors.labels) if same else [None]:
                    asked = np.arange(len(anchors.ids)) if label is None else np.flatnonzero(anchors.labels == label)
                    which = np.arange(len(rows.ids)) if label is None else np.flatnonzero(rows.labels == label)
                    for at, turn, row, score in fill_windows(Index(rows.vector[which], kind), rows, which, anchors, asked, k, same):
                        found.append((anchors.ids[at], turn, rows.ids[row], score))
        anchor, turn, row, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({"anchor_id": pa.array(anchor), "turn": pa.array(turn, pa.int32()), "vec_id": pa.array(row), "score": pa.array(score)})

    return run


def _search(index: DataFrame, groups: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best rows of every group in every window of every anchor."""
    blocks = anchors.groupBy("size").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("groups"))
    sets = blocks.select("size", F.ceil(F.col("groups") / BLOCKS).cast("int").alias("sets"))
    right = _dealt(anchors, blocks, ["lows", "highs"]).withColumn("part", F.expr(f"cast(grp div {BLOCKS} as int)")).drop("grp")
    right = right.join(groups, "size").withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    left = index.join(sets, "size").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("sets") - 1)))
    keys = ["size", "grp", "part"]
    met = left.drop("sets").groupBy(*keys).cogroup(right.drop("groups").groupBy(*keys))
    return met.applyInArrow(_mined(k, same), "anchor_id long, turn int, vec_id long, score long")


def _raised(index: DataFrame, groups: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchors`` with lows raised to the k-th best of the first group: nothing below it can be among the k best of all."""
    found = _search(index.where("grp = 0"), groups.withColumn("groups", F.lit(1)), anchors, k, same)
    full = found.groupBy("anchor_id", "turn").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(F.col("n") >= k)
    raised = full.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("turn", "low"))).alias("raised"))
    lows = F.transform("lows", lambda low, turn: F.greatest(low, F.coalesce(F.element_at("raised", turn.cast("int")), low)))
    return anchors.join(raised, "vec_id", "left").withColumn("lows", F.when(F.col("raised").isNull(), F.col("lows")).otherwise(lows)).drop("raised")


def hard_negatives(
    vectors: DataFrame, anchor: Column | str, label: Column | str = "label", positives: int = 5, negatives: int = 3,
    shares: tuple[int, int] = (50, 95), scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    A score is the inner product of two vectors of whole numbers floor(scale x), exact; larger ones come first, ties by
    smaller id. The positives of an anchor are its ``positives`` first other rows of the same label; for each, the
    ``negatives`` first rows of another label are returned whose score lies between the two percentages ``shares`` of the
    positive's. Fewer where there are no more; none where the positive's score is negative.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part; vectors of
    different lengths are never compared. Equal rows count once; where an id has several rows, the one with the smallest
    label and vector is the anchor, and none of them is a partner of it. An empty table gives no rows; other columns are
    not read. Scores from 2^56 raise an error.

    Every row lies in one group; every block of anchors meets every group of its length in one task. The first group
    sets lower bounds for all others.
    """
    spark = ready(vectors.sparkSession)
    if isinstance(label, str):
        label = F.col(label)
    rows = saved(whole_rows(vectors, label, id_column, vector_column, scale), "rows")
    groups = rows.groupBy("size").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("groups"))
    groups = saved(groups, "groups")
    many = (groups.agg(F.max("groups")).first()[0] or 0) > 1
    index = saved(_dealt(rows, groups, []), "index")

    one = rows.where(anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector", "size")).alias("r")).select("vec_id", "r.*")
    asked = one.withColumn("lows", F.array(F.lit(-MOST))).withColumn("highs", F.array(F.lit(MOST)))
    if many:
        asked = saved(_raised(index, groups, asked, positives, True), "asked")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    found = _search(index, groups, asked, positives, True).withColumn("turn", F.row_number().over(best) - 1)
    pairs = saved(
        found.where(F.col("turn") < positives).select("anchor_id", "turn", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "pairs",
    )

    def floor_of(x: Column) -> Column:
        return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))

    score = F.col("positive_score")
    windows = pairs.select(
        F.col("anchor_id").alias("vec_id"), "turn", (-floor_of(-score * shares[0])).alias("low"), floor_of(score * shares[1]).alias("high"),
    )
    listed = windows.groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct("turn", F.struct("low", "high")))).alias("w"))
    turns = F.sequence(F.lit(0), F.lit(positives - 1))
    asked = (
        one.join(listed, "vec_id")
        .withColumn("lows", F.transform(turns, lambda t: F.coalesce(F.element_at("w", t)["low"], F.lit(1).cast("long"))))
        .withColumn("highs", F.transform(turns, lambda t: F.coalesce(F.element_at("w", t)["high"], F.lit(0).cast("long")))).drop("w")
    )
    if many:
        asked = saved(_raised(index, groups, asked, negatives, False), "windows")
    order = Window.partitionBy("anchor_id", "turn").orderBy(F.desc("score"), "vec_id")
    found = _search(index, groups, asked, negatives, False).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.join(pairs, ["anchor_id", "turn"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
