"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deslinde.llm.common import column, pieces_of, ready, saved, texts_of

UNKNOWN = "und"
# Subwords are byte n-grams of these lengths, hashed to this many rows of the embedding table.
LENGTHS, BUCKETS, DIM = (2, 3, 4), 1 << 14, 16
# Documents of each language that are looked at for training: the bound of what is fitted.
SAMPLE_PER_LANGUAGE = 400
# An answer whose calibrated probability is below this is rejected: it is likelier wrong than right.
LEAST = 0.5
STEP = 1 << 18

_BYTE = np.arange(256)
_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
# What the model sees: small letters, bytes of other alphabets, and one sign for all that parts words.
_SEEN = np.where(_BYTE >= 128, _BYTE, np.where(_LETTER, _BYTE | 32, 32)).astype(np.uint32)


def subwords(raw: np.ndarray, length: int) -> np.ndarray:
    """The bucket of every run of ``length`` bytes."""
    x = _SEEN[raw]
    h = x[: len(x) - length + 1].copy()
    for k in range(1, length):
        h *= np.uint32(0x01000193)
        h ^= x[k : len(x) - length + 1 + k]
    h *= np.uint32(0x9E3779B1)
    return (h >> np.uint32(32 - (BUCKETS - 1).bit_length())).astype(np.intp)


@dataclass
class Model:
    """``table`` holds, for every bucket, its embedding times the softmax weights: what a subword adds to each language."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the rows whose bytes are ``raw``; even ones for rows too short for a subword."""
        sums, counts = np.zeros((len(at) - 1, len(self.languages))), np.zeros(len(at) - 1)
        for n in LENGTHS:
            if len(raw) < n:
                continue
            total = np.zeros((len(raw) - n + 2, len(self.languages)))
            np.cumsum(self.table[subwords(raw, n)], axis=0, out=total[1:])
            first = np.minimum(at[:-1], len(total) - 1)
            last = np.maximum(at[1:] - n + 1, first)
            sums += total[last] - total[first]
            counts += last - first
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias * (counts > 0)[:, None]) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of each text, packed: at most one entry a bucket however long the text."""
    for batch in batches:
        raw, at = texts_of(column(batch, "text"))
        packed = []
        for a, b in zip(at[:-1], at[1:]):
            counts = np.zeros(BUCKETS, np.int64)
            for s in range(int(a), int(b), STEP):
                for n in LENGTHS:
                    part = raw[s : min(int(b), s + STEP + n - 1)]
                    if len(part) >= n:
                        counts += np.bincount(subwords(part, n), minlength=BUCKETS)
            used = np.flatnonzero(counts)
            packed.append(used.astype("<u2").tobytes() + (counts[used] / max(1, counts.sum())).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([column(batch, "lang"), pa.array(packed, pa.binary())], ["lang", "packed"])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of training: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` labelled documents of each language, none of them held out, by the hash of their ids."""
    may = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    counts = may.groupBy("lang").agg(F.count("*").alias("n"))
    place = (F.xxhash64("doc_id", F.lit("language")).bitwiseAND(F.lit((1 << 40) - 1))) / F.lit(float(1 << 40))
    ids = may.select("doc_id", "lang").join(counts, "lang").where(place * F.col("n") < per_language).select("doc_id").distinct()
    # a written table of a few thousand ids: Spark knows how small it is and leaves the texts where they are
    return may.join(saved(ids, "sample"), "doc_id", "left_semi")


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], answers: np.ndarray, kinds: int, epochs: int, rate: float, seed: int):
    """Stochastic gradient descent, a document a step; the rate falls to zero."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, kinds), np.float32), np.zeros(kinds, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            now = rate * (1 - done / steps)
            done += 1
            used, share = rows[k]
            if not len(used):
                continue
            mean = share @ embed[used]
            odds = mean @ weights + bias
            odds = np.exp(odds - odds.max())
            gap = odds / odds.sum()
            gap[answers[k]] -= 1
            back = weights @ gap
            weights -= now * np.outer(mean, gap)
            bias -= now * 0.1 * gap
            embed[used] -= (now * len(used) ** 0.5) * share[:, None] * back
    return embed, weights, bias


def _temperature(logits: np.ndarray, answers: np.ndarray) -> float:
    """The divisor of the logits under which held-back answers are likeliest."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 61):
        z = logits / t
        z -= z.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), answers]))
        best = min(best, (loss, float(t)))
    return best[1]


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, epochs: int = 8, rate: float = 0.6, seed: int = 7) -> Model:
    """Fit on a bounded sample of ``docs`` (doc_id, lang, text) that leaves the held-out quarter alone.

    A fifth of the sample is held back to calibrate: it sets the temperature, under which the
    probabilities are those with which its answers are right. Without labelled documents the model
    knows no language.
    """
    ready(docs.sparkSession)
    taken = sample(docs, per_language).orderBy("doc_id").select("lang", "text").mapInArrow(_counted, "lang string, packed binary")
    rows, names = [], []
    for batch in taken.toArrow().to_batches():  # per_language documents of each language, at most 96 KB each
        for lang, packed in zip(*batch.columns):
            view = packed.as_buffer()  # the counts stay where Arrow has put them
            n = view.size // 6
            rows.append((np.frombuffer(view, "<u2", n), np.frombuffer(view, "<f4", n, 2 * n)))
            names.append(lang.as_py())
    languages = sorted(set(names))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    order = np.array([languages.index(x) for x in names])
    turn = np.random.default_rng(seed).permutation(len(rows))
    back, own = turn[: len(rows) // 5], turn[len(rows) // 5 :]
    embed, weights, bias = _fit([rows[k] for k in own], order[own], len(languages), epochs, rate, seed)
    table = (embed @ weights).astype(np.float32)
    if not len(back):
        return Model(languages, table, bias, 1.0, LEAST)
    logits = np.array([share @ table[used] + bias for used, share in (rows[k] for k in back)], np.float64)
    return Model(languages, table, bias, _temperature(logits, order[back]), LEAST)


def _has_letter(raw: np.ndarray, at: np.ndarray, texts: pa.Array, a: int) -> np.ndarray:
    seen = np.r_[0, np.cumsum(_LETTER[raw])]
    known = seen[at[1:]] > seen[at[:-1]]
    for k in np.flatnonzero(~known):  # no ASCII letter: look at the characters
        known[k] = any(map(str.isalpha, texts[a + int(k)].as_py() or ""))
    return known


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of ``docs`` (doc_id, text); whole texts, in one narrow step.

    score is the calibrated probability of the language; rejected tells that it is under the model's
    threshold. A null text, or one without a letter, is `und` with score 0 and rejected; a text that
    has a letter always gets a learned language (the likeliest by the bias alone if it is shorter
    than a subword). A row without doc_id keeps a null id and is not held out. Repeated rows are
    answered each; an empty table gives no row; other columns are not read.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # one row of numbers a bucket: its size is fixed
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = column(batch, "text")
            raw, at = texts_of(texts)
            names, scores = [], []
            for a, b in pieces_of(at, STEP):
                some, borders = raw[at[a] : at[b]], at[a : b + 1] - at[a]
                known = _has_letter(some, borders, texts, a) & bool(own.languages)
                odds = own.scores(some, borders) if own.languages else np.zeros((b - a, 1))
                best = odds.argmax(axis=1)
                names += [own.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
                scores += np.where(known, odds.max(axis=1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"), column(batch, "held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                    pa.array([n == UNKNOWN or s < own.threshold for n, s in zip(names, scores)], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return ids.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the model does not reject; decided on each row's own text."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def keep(texts):
        raw, at = texts_of(array := pa.array(texts, pa.string(), from_pandas=True))
        own, out = shared.value, []
        for a, b in pieces_of(at, STEP):
            some, borders = raw[at[a] : at[b]], at[a : b + 1] - at[a]
            sure = own.scores(some, borders).max(axis=1) >= own.threshold if own.languages else np.zeros(b - a, bool)
            out += (sure & _has_letter(some, borders, array, a)).tolist()
        return pd.Series(out, dtype=bool)

    import pandas as pd

    return docs.where(F.pandas_udf(keep, "boolean")("text"))
