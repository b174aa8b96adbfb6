"""Near-duplicate documents: a multi-index Hamming join of MinHash signatures, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde.llm.common import column, fresh, mix, pieces_of, ready, saved, texts_of, words_of
from deslinde.operators.graph import connected_components

# A signature: CHUNKS chunks of SYMBOLS MinHash symbols of 16 bits. Two signatures that differ in at most
# CHUNKS * (ERRORS + 1) - 1 symbols have, by the pigeonhole principle, a chunk with at most ERRORS differing
# symbols; all choices of ERRORS symbols to leave out of a chunk are keys, so the pair meets under one of them.
CHUNKS, SYMBOLS, ERRORS = 12, 6, 1
N = CHUNKS * SYMBOLS
RADIUS = CHUNKS * (ERRORS + 1) - 1
# Pairs that meet but differ in more symbols than this are not confirmed on their sets. At a similarity of 0.8,
# 72 symbols differ in 14.4 +- 3.4: this is 4.6 deviations above. For other thresholds it moves in proportion.
DEVIATIONS = 4.6
LONGS = [f"s{k}" for k in range(N // 4)]  # four symbols each
# Orders in which a bucket's members take turns as its lead: xor with these keeps numbers apart and shuffles them.
TURNS = (0x5DEECE66D1CE4E5B, 0x2127599BF4325C37, 0x6A09E667F3BCC908)

_RNG = np.random.default_rng(20240601)
_TIMES = _RNG.integers(0, 1 << 63, N, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, N, np.uint64)
_KEEP = [(c, kept) for c in range(CHUNKS) for kept in combinations(range(SYMBOLS), SYMBOLS - ERRORS)]
_KEY_TIMES = _RNG.integers(0, 1 << 63, (len(_KEEP), SYMBOLS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """The set of hashed runs of ``words`` words; of fewer words the whole sequence is the one run; of none, empty."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    runs = hashes[: n - width + 1].copy()
    for k in range(1, width):
        runs *= np.uint64(0x9E3779B97F4A7C15)
        runs ^= hashes[k : n - width + 1 + k]
        runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mix(runs + np.uint64(width)))


def signature(grams: np.ndarray) -> np.ndarray:
    """The 16-bit symbols: of each hash function's smallest value over the set."""
    low = np.full(N, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(grams), 2048):
        np.minimum(low, (grams[a : a + 2048, None] * _TIMES + _PLUS).min(axis=0), out=low)
    return (mix(low) >> np.uint64(48)).astype(np.uint16)


def _each_set(batches: Iterator[pa.RecordBatch], words: int):
    """(doc_ids, sets) of each batch, in steps of bounded bytes."""
    for batch in batches:
        ids = column(batch, "doc_id")
        raw, at = texts_of(column(batch, "text"))
        for a, b in pieces_of(at):
            w = words_of(raw[at[a] : at[b]], at[a : b + 1])
            yield ids.slice(a, b - a), [shingles(w.hashes[w.first[k] : w.first[k + 1]], words) for k in range(b - a)]


def sign(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, c1, c2, s0..): set size, a 128-bit digest of the set, and its signature. An empty set has no digest."""

    def run(batches):
        for ids, sets in _each_set(batches, words):
            full = pa.array([not len(g) for g in sets])
            c1 = np.array([int(g.sum(dtype=np.uint64)) for g in sets], np.uint64)
            c2 = np.array([int(mix(g + np.uint64(1)).sum(dtype=np.uint64)) for g in sets], np.uint64)
            signed = np.array([signature(g) for g in sets], np.uint16).view(np.int64)
            columns = [c1.view(np.int64), c2.view(np.int64), *signed.T]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(g) for g in sets], pa.int64()), *(pa.array(np.ascontiguousarray(c), pa.int64(), mask=np.array(full)) for c in columns)],
                ["doc_id", "n_shingles", "c1", "c2", *LONGS],
            )

    longs = ", ".join(f"{c} long" for c in ["doc_id", "n_shingles", "c1", "c2", *LONGS])
    return docs.select("doc_id", "text").mapInArrow(run, longs)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, grams): the whole set of each document, as a sorted array."""

    def run(batches):
        for ids, sets in _each_set(batches, words):
            ends = np.cumsum([0, *map(len, sets)])
            grams = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams))], ["node", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, grams array<long>")


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, node): for every chunk and every choice of symbols left out, the hash of the chunk's other symbols."""

    def run(batches):
        for batch in batches:
            longs = np.stack([column(batch, c).to_numpy(zero_copy_only=False) for c in LONGS], axis=1)
            symbols = np.ascontiguousarray(longs).view(np.uint16).astype(np.uint64).reshape(len(longs), CHUNKS, SYMBOLS)
            keys = np.empty((len(longs), len(_KEEP)), np.uint64)
            for k, (c, kept) in enumerate(_KEEP):
                keys[:, k] = mix(sum(symbols[:, c, p] * _KEY_TIMES[k, p] for p in kept) + np.uint64(k + 1))
            nodes = np.repeat(column(batch, "node").to_numpy(zero_copy_only=False), len(_KEEP))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(nodes)], ["key", "node"])

    return classes.select("node", *LONGS).mapInArrow(run, "key long, node long")


def differing(a: str, b: str) -> Column:
    """Symbols in which two signatures differ: in each long, the 16-bit lanes whose xor is not zero."""
    total = F.lit(0)
    for c in LONGS:
        x = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        for shift in (8, 4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))
    return total


def _most_differing(percent: int) -> int:
    share = 1 - percent / 100
    return int(N * share + DEVIATIONS * (N * share * (1 - share)) ** 0.5)


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, other columns) those whose set sizes and signatures allow a link, with the symbols that differ."""
    signs = classes.select("node", "n_shingles", *LONGS)
    both = pairs.join(signs.withColumnRenamed("node", "a").alias("x"), "a").join(signs.withColumnRenamed("node", "b").alias("y"), "b")
    sizes = F.least("x.n_shingles", "y.n_shingles") * 100 >= F.greatest("x.n_shingles", "y.n_shingles") * percent
    return both.where(sizes).select(*pairs.columns, differing("x", "y").alias("off")).where(F.col("off") <= _most_differing(percent))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    same = F.size(F.array_intersect("ga", "gb"))
    return (
        pairs.select("a", "b").join(one, "a").join(two, "b")
        .select("a", "b", same.alias("same"), (F.size("ga") + F.size("gb") - same).alias("all"))
        .where(F.col("same") * 100 >= F.col("all") * percent).select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _with_labels(rows: DataFrame, labels: DataFrame, at: str, name: str) -> DataFrame:
    """Add the component of the node in column ``at``; a node without links is its own."""
    got = labels.select(F.col("id").alias(at), F.col("label").alias("__label"))
    return rows.join(got, at, "left").withColumn(name, F.coalesce("__label", at)).drop("__label")


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, label): connected components of the classes under the similarity threshold.

    First each member of a bucket is compared with the bucket's lead alone, and of its leads only
    with the nearest signature. Pairs that met in buckets of two alone and are still apart are then
    compared too, and larger buckets that still hold several components take other leads in turn.
    What still shares a bucket with another component after that goes through an exact search by
    rare shingles, which leaves no pair untested that could change a component. Groups of any size thus
    settle with about as many comparisons as members, while nothing is capped.
    """
    keys = index_keys(classes)
    buckets = keys.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("size")).where("size > 1")
    members = saved(keys.join(buckets, "key"), "members")  # key, node, lead, size

    met = members.where("node <> lead").groupBy(F.col("node").alias("a"), F.col("lead").alias("b")).agg(F.max("size").alias("size"))
    near = saved(_near(met, classes, percent), "near")
    first = saved(near.groupBy("a").agg(F.min_by("b", F.struct("off", "b")).alias("b")), "first")
    needed = near.select("a").unionByName(near.select(F.col("b").alias("a"))).unionByName(
        members.where("size > 2").select(F.col("node").alias("a"))
    ).distinct().withColumnRenamed("a", "doc_id")
    sets = saved(shingle_sets(docs.join(needed, "doc_id", "left_semi"), words).dropDuplicates(["node"]), "sets")

    edges = saved(_confirmed(first, sets, percent), "edges")
    labels = saved(connected_components(edges), "labels")
    # a pair that never met in a larger bucket has no other lead to be linked through
    two = _with_labels(_with_labels(near.where("size = 2").select("a", "b"), labels, "a", "label"), labels, "b", "other")
    two = two.where("label <> other").select("a", "b").join(first, ["a", "b"], "left_anti")
    inner = members.where("size > 2").select("key", "node")
    inner = _mixed(inner, labels)
    pairs = None
    for turn in TURNS:
        lead = inner.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(F.lit(turn))).bitwiseXOR(F.lit(turn)).alias("b"))
        asked = inner.join(lead, "key").where("node <> b").select(F.col("node").alias("a"), "b", "label").distinct()
        pairs = asked if pairs is None else pairs.unionByName(asked)
    pairs = _with_labels(pairs, labels, "b", "other").where("label <> other").select("a", "b").distinct()
    pairs = _near(pairs, classes, percent).select("a", "b").unionByName(two)
    labels = _joined(labels, saved(_confirmed(pairs, sets, percent), "more"))

    rest = _mixed(inner.select("key", "node"), labels).select("node", "label").distinct()
    return _joined(labels, saved(_confirmed(_by_rare_shingles(rest, sets, percent), sets, percent), "last"))


def _joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label) after more links: only the components they touch are worked on again."""
    if edges.isEmpty():
        return labels
    ends = _with_labels(_with_labels(edges, labels, "u", "lu"), labels, "v", "lv")
    over = saved(connected_components(ends.select(F.col("lu").alias("u"), F.col("lv").alias("v"))), "over")
    fresh = edges.select(F.col("u").alias("id")).union(edges.select("v")).distinct().join(labels, "id", "left_anti")
    every = labels.unionByName(fresh.withColumn("label", F.col("id")))
    to = over.select(F.col("id").alias("label"), F.col("label").alias("low"))
    return saved(every.join(to, "label", "left").select("id", F.coalesce("low", "label").alias("label")), "labels")


def _by_rare_shingles(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the nodes in ``rest`` (node, label) with other labels that may be similar enough; none that is is left out.

    The exact way for what the leads have not settled. With every set in order of how rare its shingles
    are among these sets, two similar sets have their first common shingle early in both: at such places
    that what follows can still make up the overlap the threshold asks for (prefix and position filters).
    Members of one component that have a shingle in common are first met together, by the best place
    any of them has, and one by one only where that can succeed, so a group that is one component
    already costs no pairs.
    """
    sized = rest.join(sets, "node").select("node", "label", F.size("grams").alias("n"), "grams")
    posts = sized.select("node", F.explode("grams").alias("gram"))
    often = posts.groupBy("gram").agg(F.count("*").alias("often")).where("often > 1")
    shared = posts.join(often, "gram")
    own = shared.groupBy("node").agg(F.count("*").alias("shared"))  # the others are nowhere else and stand before these
    sizes = sized.select("node", "label", "n").join(own, "node").where(F.expr(f"(n - shared) * 100 <= n * {100 - percent}"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "gram")) - 1
    placed = shared.join(sizes, "node").select("node", "label", "n", "gram", (F.col("n") - F.col("shared") + place).alias("at"))
    early = saved(placed.where(f"at * 100 <= n * {100 - percent}"), "early")

    # the smaller set of a pair (of equal ones that of the smaller node) needs to be looked up under fewer shingles
    x = early.select("gram", F.col("node").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("at").alias("ia"))
    y = early.where(f"(n - at) * {100 + percent} >= n * {2 * percent}").select("gram", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("at").alias("ib"))
    can = F.expr(
        f"la <> lb and nb <= na and nb * 100 >= na * {percent} and least(na - ia, nb - ib) * {100 + percent} >= (na + nb) * {percent}"
    )
    groups = y.groupBy("gram", "lb", "nb").agg(F.min("ib").alias("ib"))
    hopeful = x.join(groups, "gram").where(can).drop("ib")
    met = hopeful.join(y, ["gram", "lb", "nb"]).where(can)
    return met.where("nb < na or b < a").select("a", "b").distinct()


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label): the buckets whose members are in more than one component."""
    marked = saved(_with_labels(rows, labels, "node", "label"), "marked")
    several = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return marked.join(several, "key", "left_semi").select("key", "node", "label")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Links documents whose shingle sets have 100 * intersection >= ``percent`` * union. Words are
    parted by ASCII white space, A-Z count as a-z. component_id is the smallest doc_id reachable,
    kept tells that it is the row's own. Documents with equal sets are one class, which takes part
    once. Null or empty texts, or texts without words, are linked with nothing. A row without
    doc_id is linked with nothing, has no component_id and is kept. Rows with the same doc_id
    count as one document. An empty table gives no row; other columns are not read.
    """
    spark = ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = saved(sign(docs, words), "signed")
    linkable = signed.where("doc_id is not null and c1 is not null")
    classes = saved(
        linkable.groupBy("c1", "c2").agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ["n_shingles", *LONGS])), "classes"
    )
    labels = links(docs, classes, words, percent)
    spots = _with_labels(classes.select("c1", "c2", "node"), labels, "node", "component_id").select("c1", "c2", "component_id")
    own = linkable.select("doc_id", "n_shingles", "c1", "c2").join(spots, ["c1", "c2"]).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("doc_id is null or c1 is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return own.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without the near copies: of each component the smallest doc_id stays.

    Of rows with the same doc_id one stays, as they are one document; rows without a doc_id stay.
    """
    found = near_duplicates(docs, words, percent).where("kept and doc_id is not null")
    key, rows = fresh(docs, "stay_id"), fresh(docs, "stay_rows")
    stay = found.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(rows))
    got = docs.join(stay, F.col("doc_id") == F.col(key)).drop(key)
    one = got.where(F.col(rows) == 1).unionByName(got.where(F.col(rows) > 1).dropDuplicates(["doc_id"])).drop(rows)
    return one.unionByName(docs.where("doc_id is null"))
