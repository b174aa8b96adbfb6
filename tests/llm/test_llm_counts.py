"""Phrases, hard negatives and language-model scores against plain versions, with odd input."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deslinde.llm import lexicon, lm, mining, phrases
from deslinde.llm.gru import Gru, class_borders

DOCS = "doc_id long, text string, lang string, source string, n_chars long, chunk long, word string, ids string, pos int"


def frame(spark, rows):
    """Documents beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, "s", 0, 1, "w", "x", 2) for i, t, g in rows], DOCS)


def odd_docs(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Él", "ÉL", "naïve", "日本語", "a\x00b", "x\x1cy"]
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t\n..!?", None), (4, "The END. the end; THE\tEnd", None), (None, "w1 w2 w3", "en")]
    for k in range(n):
        text = "".join(rng.choice(words[: rng.choice([3, 18])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(rng.randrange(60)))
        rows.append((10 + k, text, rng.choice(["en", "en", "de", None])))
    rows += [(500, "w1 w2 w3 w4 " * 40, "en")] * 3  # repeated rows, one phrase in a third of everything
    return rows


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_collocations(rows, least, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        totals[lang] += 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            w = [x for x in re.split("[ \t]", piece) if x]
            totals[lang] += len(w)
            for n in range(1, 5):
                for k in range(len(w) - n + 1):
                    counts[lang][tuple(w[k : k + n])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.defaultdict(int)
        for p, a in cand.items():
            for n in range(2, len(p)):
                for k in range(len(p) - n + 1):
                    inside[p[k : k + n]] = max(inside[p[k : k + n]], a)
        rows_ = []
        for p, a in cand.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("chunk_words, top", [(40, 7), (1 << 18, 2000)])
def test_collocations_equal_plain_ones(spark, chunk_words, top, monkeypatch):
    """Also across the borders of chunks inside a text, and with several slices of n-grams."""
    rows = odd_docs()
    monkeypatch.setattr(phrases, "SLICE_ENTRIES", 200)
    found = phrases.frequent_phrases
    monkeypatch.setattr(phrases, "frequent_phrases", lambda docs, least: found(docs, least, chunk_words))
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows).repartition(3), least=3, top=top).collect())
    assert got == plain_collocations(rows, 3, top) and len(got) > 5


def test_collocations_of_nothing(spark):
    empty = frame(spark, [])
    assert phrases.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_a_very_long_text_is_cut_without_loss(spark):
    text = "alpha beta gamma. " * 120_000 + "x" * 3_000_000
    got = {r.phrase: (r.a, r.n) for r in phrases.collocations(frame(spark, [(1, text, "en")])).collect()}
    assert got == {"alpha beta gamma": (120_000, 360_001)}


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31])
def test_packing_turns_back(n, bits):
    rng = np.random.default_rng(bits)
    words = [rng.integers(1, 1 << bits, 500) if bits > 1 else np.ones(500, np.int64) for _ in range(n)]
    packing = phrases.Packing(n, bits)
    left, right = packing.pack(words)
    assert int(left.max()) >> packing.half == 0 and int(right.max()) >> packing.half == 0
    assert all((a == b).all() for a, b in zip(packing.unpack(left, right), words))


@pytest.mark.parametrize("half, leading", [(3, 0), (17, 4), (34, 7), (62, 11), (4, 4)])
def test_filters_hold_every_pair_and_count(half, leading):
    rng = np.random.default_rng(half)
    first = int(rng.integers(0, 1 << leading))
    left = rng.integers(0, 1 << (half - leading), 300).astype(np.uint64) | np.uint64(first << (half - leading))
    pairs = np.unique(np.stack([left, rng.integers(0, 1 << min(half, 20), 300).astype(np.uint64)], axis=1), axis=0)
    counts = rng.choice([1, 1, 1, 2, 200, 257, 258, 1 << 40], len(pairs))
    data = phrases.to_filter(pairs[:, 0], pairs[:, 1], counts, half, leading)
    back = phrases.from_filter(data, first, half, leading)
    assert (back[0] == pairs[:, 0]).all() and (back[1] == pairs[:, 1]).all() and (back[2] == counts).all()


def test_steps_keep_words_whole():
    text = b"ab cd\xffefghijkl m" * 9
    steps = list(lexicon.steps_of(text, phrases._GAP, 7))
    assert b"".join(steps) == text and all(s[:1] in (b" ", b"\xff") for s in steps[1:])


# --- hard negatives -----------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<double>, label int, size int, grp int, turn int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, 2, 3, "s") for i, v, g in rows], VECTORS)


def plain_negatives(rows, every, positives, negatives):
    good = {}
    for i, v, g in rows:
        if i is None or g is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.setdefault((i, g, tuple(math.floor(256 * x) for x in v)))
    good = sorted(good)
    first = {}
    for i, g, v in good:
        first.setdefault(i, (i, g, v))
    out = []
    for i, g, v in first.values():
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, h) for j, h, w in good if j != i and len(w) == len(v)]
        pos = sorted((s, j) for s, j, h in scored if h == g)[:positives]
        for ps, p in pos:
            inside = sorted((s, j) for s, j, h in scored if h != g and 50 * -ps <= 100 * -s <= 95 * -ps)[:negatives]
            out += [(i, p, k, j, -ps, -s) for k, (s, j) in enumerate(inside, 1)]
    return sorted(out)


def odd_vectors(seed=1):
    rng = random.Random(seed)
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None, 2.0], 1), (4, [float("nan")] * 3, 1), (5, [float("inf")] * 3, 1), (None, [1.0] * 3, 1), (6, [1.0] * 3, None), (7, [0.0] * 3, 2)]
    base = [rng.gauss(0, 1) for _ in range(3)]
    for k in range(10, 130):
        v = [x + rng.gauss(0, 0.4) for x in base]
        rows.append((k, v, rng.randrange(3)))
    rows += [(130 + k, [1.0, 0.5, 0.25], k % 2) for k in range(60)]  # one vector in a third of the rows
    rows += [(10, [5.0, 5.0, 5.0], 2), rows[-1], rows[-1]]  # an id with two vectors, repeated rows
    return rows + [(900 + k, [rng.gauss(0, 1) for _ in range(5)], k % 2) for k in range(20)]  # another length


@pytest.mark.parametrize("rows_per_group", [1 << 14, 30])
def test_hard_negatives_equal_plain_ones(spark, rows_per_group, monkeypatch):
    monkeypatch.setattr(mining, "GROUP_ROWS", rows_per_group)
    monkeypatch.setattr(mining, "BLOCK_ROWS", min(rows_per_group, 16))
    rows = odd_vectors()
    got = mining.hard_negatives(vectors(spark, rows), "vec_id % 5 = 0", positives=3, negatives=2)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == plain_negatives(rows, 5, 3, 2) and len(got) > 50


def test_hard_negatives_of_nothing_and_of_too_large_numbers(spark):
    assert mining.hard_negatives(vectors(spark, []), "vec_id % 5 = 0").count() == 0
    huge = [(5, [1e9] * 4, 1), (6, [1e9] * 4, 1)]
    with pytest.raises(Exception, match="56 bits"):
        mining.hard_negatives(vectors(spark, huge), "vec_id % 5 = 0").collect()


@pytest.mark.parametrize("size", [1, 5, 64])
def test_an_index_finds_all_that_reach_a_threshold(size):
    rng = np.random.default_rng(size)
    scale = rng.choice([1, 10, 300], size)
    rows, asked = (np.floor(rng.normal(0, 1, (n, size)) * scale).astype(np.int64) for n in (300, 20))
    every = asked @ rows.T
    index = mining.Index(rows, mining.exact_kind(rows, asked))
    for least in (every.max(axis=1), np.quantile(every, 0.9, axis=1).astype(np.int64), np.zeros(20, np.int64), np.full(20, -mining.MOST)):
        at, row, score = index.reaching(asked, least)
        assert {(a, r, s) for a, r, s in zip(at.tolist(), row.tolist(), score.tolist())} == {(a, r, every[a, r]) for a, r in zip(*np.nonzero(every >= least[:, None]))}


# --- language model -----------------------------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    model, end = Gru(np.array([0, 1, 3, 7]), 5), 0
    flat = rng.normal(0, 0.5, model.size).astype(np.float32)
    x, y = rng.integers(0, 7, (4, 3)), rng.integers(0, 7, (4, 3))

    def loss(f):
        p = model.views(f)
        states = model.states(p, x, np.zeros((3, 5), np.float32), end)
        return -model.log_probabilities(p, states.reshape(-1, 5), y.reshape(-1))[0].sum()

    p, kept = model.views(flat), []
    states = model.states(p, x, np.zeros((3, 5), np.float32), end, kept)
    grads = {k: np.zeros(s, np.float32) for k, s in model.shapes.items() if k != "reads"}
    _, back = model.log_probabilities(p, states.reshape(-1, 5), y.reshape(-1), grads)
    model.backward(p, grads, x, back.reshape(states.shape), kept, end)
    full = np.zeros(model.size, np.float32)
    for name, view in model.views(full).items():
        view[grads["rows"] if name == "reads" else slice(None)] = grads[name]
    for k in range(0, model.size, 7):
        step = np.zeros(model.size, np.float32)
        step[k] = 1e-2
        assert (loss(flat + step) - loss(flat - step)) / 2e-2 == pytest.approx(float(full[k]), abs=5e-3 + 5e-3 * abs(float(full[k])))


def test_scores_are_those_of_each_document_alone_and_sum_to_one():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 500, 40))[::-1].astype(float)
    model = Gru(class_borders(counts, 6), 8)
    flat = rng.normal(0, 0.4, model.size).astype(np.float32)
    docs = [np.append(rng.integers(1, 40, n), 0) for n in (0, 1, 300, 7, 45, 45, 2)]
    begins = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    p = model.views(flat)
    want = []
    for d in docs:
        state = np.zeros((1, 8), np.float32)
        total, before = 0.0, 0
        for word in d:
            h = model.states(p, np.array([[before]]), state, 0)[0]
            every = model.log_probabilities(p, np.repeat(h, 40, axis=0), np.arange(40))[0]
            assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
            total, before = total + every[word], word
        want.append(total)
    for lanes, window in ((1, 4), (3, 16), (512, 5)):
        got = model.score(flat, np.concatenate(docs), begins, 0, lanes, window)
        assert got == pytest.approx(np.array(want), rel=1e-4, abs=1e-4)


def plain_base(rows, held):
    counts, kept = collections.Counter(), []
    for doc, text, _ in rows:
        tokens = [*re.findall("[^ \t\n\x0b\x0c\r]+", lowered(text)), "\n"]
        kept.append((doc, held(doc), tokens))
        if not held(doc):
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    return sorted((d or -1, h, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for d, h, t in kept)


def is_held(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 7 == 2


HELD = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 = 2"


@pytest.mark.parametrize("chunk_words", [50, 1 << 18])
def test_base_scores_equal_plain_ones(spark, chunk_words):
    rows = odd_docs()
    got = lm.document_scores(frame(spark, rows).repartition(3), HELD, lm.Settings(words=9), chunk_words=chunk_words).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain_base(rows, is_held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_of_nothing(spark):
    assert lm.document_scores(frame(spark, []), HELD).count() == 0
    only = lm.document_scores(frame(spark, [(k, "a b", "en") for k in range(60) if is_held(k)]), HELD).collect()
    assert only and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in only)


def test_the_model_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = lm.document_scores(docs, HELD).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] / sums[2] > sums[1] / sums[2] + 0.05


def test_a_very_long_text_is_scored_whole(spark):
    got = lm.document_scores(frame(spark, [(1, "alpha beta " * 400_000, "en"), (2, "alpha beta", "en")]), F.lit(False)).collect()
    long = next(r for r in got if r.doc_id == 1)
    assert long.n_tokens == 800_001 and long.score > 0.5 * long.base_score
