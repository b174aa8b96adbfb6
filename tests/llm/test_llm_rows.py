"""Near copies, benchmark leaks, nearest vectors, archives, shards and the pipeline against plain versions."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deslinde.llm import ann, decontam, langid, neardup, sharding, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, component_id string, key long, label long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "n", "c", 1, 2) for i, t in rows], SCHEMA)


def plain_set(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[k:] for k in range(words)))) if len(w) >= words else frozenset({tuple(w)} if w else ())


def plain_components(rows, words, percent):
    sets = {i: plain_set(t, words) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(rng, n, words, changes):
    """A base text and copies with a few words changed: similarities on both sides of the threshold."""
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        yield " ".join(own)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    texts = [None, "", "  \n", "one", "ONE", "one two", "Two one", "é É", "e e", "e e e"]
    for n, words, changes in ((60, 60, 8), (40, 200, 20), (25, 12, 2), (30, 90, 4), (3, 5, 1)):
        texts += variants(rng, n, words, changes)
    texts += [" ".join(f"r{rng.randrange(9999)}" for _ in range(40)) for _ in range(60)]
    texts += ["same words here again and again"] * 12
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80), (1, 60)])
def test_components_are_those_of_all_pairs(spark, copies, words, percent):
    got = {r["doc_id"]: r for r in neardup.near_duplicates(frame(spark, copies).repartition(3), words, percent).collect()}
    for i, (n, low) in plain_components(copies, words, percent).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, low, i == low), i
    assert len(got) == len(copies)


def test_given_documents_have_the_components_of_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs, 2, 80).collect()}
    for i, (n, low) in plain_components([(r["doc_id"], r["text"]) for r in docs.collect()], 2, 80).items():
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (n, low)


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, None)]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in neardup.near_duplicates(frame(spark, rows)).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    kept = neardup.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 3]
    none = frame(spark, rows).where("false")
    assert neardup.near_duplicates(none).count() == 0 and neardup.keep_one(none).count() == 0


def test_hubs_whose_partners_share_only_buckets_of_two(spark):
    rows = []
    for seed in (58, 78, 111, 119, 152, 299, 383, 501):  # chains one - hub - two at 0.802 that meet in no bucket of three
        rng = random.Random(seed)
        hub = [f"w{rng.randrange(10**6)}" for _ in range(201)]
        one, two = list(hub), list(hub)
        for k in range(11):
            one[4 + 9 * k], two[104 + 8 * k] = f"x{k}", f"y{k}"
        rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate((one, two, hub))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame(spark, rows), 2, 80).collect()}
    keys = [(r["key"], r["node"] // 3) for r in neardup.index_keys(neardup.sign(frame(spark, rows), 2).withColumnRenamed("doc_id", "node")).collect()]
    assert max(collections.Counter(keys).values()) == 2
    assert got == {i: low for i, (_, low) in plain_components(rows, 2, 80).items()} == {i: i - i % 3 for i, _ in rows}


def test_signatures_meet_within_the_radius():
    rng = np.random.default_rng(3)
    for _ in range(300):
        off = set(rng.choice(neardup.N, neardup.RADIUS, replace=False).tolist())
        chunks = [sum(c * neardup.SYMBOLS + p in off for p in range(neardup.SYMBOLS)) for c in range(neardup.CHUNKS)]
        assert min(chunks) <= neardup.ERRORS


def plain_tiles(doc, item, least):
    free_doc, free_item, out = [True] * len(doc), [True] * len(item), []
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and free_item[i + n] and free_doc[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best >= least:
                    found.append((n, i, d))
        if not found:
            return out
        for n, i, d in sorted(found):
            if all(free_item[i : i + n]) and all(free_doc[d : d + n]):
                free_item[i : i + n] = [False] * n
                free_doc[d : d + n] = [False] * n
                out.append((n, i, d))


def test_tiles_are_those_of_the_plain_algorithm():
    rng = random.Random(3)
    for _ in range(400):
        size = rng.choice([2, 3, 6, 30])
        item, doc = ([rng.randrange(size) for _ in range(rng.randrange(n))] for n in (30, 60))
        if item and rng.random() < 0.6:
            a = rng.randrange(len(item))
            doc[5:5] = item[a:]
            doc += item[:a]
        least = rng.choice([2, 3, 5])
        assert decontam.tile(np.array(doc, np.uint64), np.array(item, np.uint64), least) == plain_tiles(doc, item, least)


def plain_words(text):
    return "".join(c if c >= "\x80" or c.isalnum() else " " for c in text or "").encode().lower().decode().split()


def plain_leaks(docs, items, least, coverage):
    for i, text in docs:
        words = plain_words(text)
        for j, test in items:
            own = plain_words(test)
            tiles = plain_tiles(words, own, least) if len(own) >= least and set(own) & set(words) else []
            if tiles and sum(t[0] for t in tiles) >= coverage * len(own):
                yield i, j, len(own), sum(t[0] for t in tiles), len(tiles)


def test_leaks_in_any_order_and_shape(spark):
    rng = random.Random(8)
    items = [(k, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randrange(3, 40)))) for k in range(25)] + [(99, None), (98, ""), (97, "a b"), (None, "n1 n2 n3 n4 n5 n6")]
    docs = [(0, None), (1, ""), (2, "clean words only here and more of them"), (3, "N1, n2; n3 n4-n5 n6!"), (None, "n1 n2 n3 n4 n5 n6")]
    for k, (_, text) in enumerate(items[:25]):
        w = text.split()
        half = len(w) // 2
        for shape in (w, w[half:] + ["x"] + w[:half], w[:half], w[: len(w) // 3], [w[0].upper() + "."] + w[1:]):
            docs.append((len(docs) + 10, " ".join(f"f{rng.randrange(99)}" for _ in range(20)) + " " + ", ".join(shape) + " tail" * 9))
    docs.append(docs[-1])
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    wanted = collections.Counter(plain_leaks(docs, [x for x in items if x[1] is not None], 5, 0.5))
    for block in (decontam.BLOCK_WORDS, 60):
        got = decontam.contaminated(frame(spark, docs), bench, block_words=block).collect()
        assert collections.Counter((r["doc_id"], r["item_id"], r["item_words"], r["covered_words"], r["tiles"]) for r in got) == wanted
    leaking = {i for i, *_ in wanted} - {None}
    kept = decontam.clean(frame(spark, docs), bench)
    assert kept.columns == frame(spark, docs).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted((i or 0) for i, _ in docs if i not in leaking)
    assert decontam.contaminated(frame(spark, docs), bench.where("false")).count() == 0
    assert decontam.contaminated(frame(spark, []), bench).count() == 0


def test_leaks_of_the_given_documents(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"], r["covered_words"]) for r in decontam.contaminated(docs, bench).collect()}
    some = [(r["doc_id"], r["text"]) for r in docs.where(F.length("text") < 3000).collect()]
    ids = {i for i, _ in some}
    seeds = {tuple(w[k : k + 5]) for _, t in bench.collect() for w in [plain_words(t)] for k in range(len(w) - 4)}
    some = [(i, t) for i, t in some for w in [plain_words(t)] if any(tuple(w[k : k + 5]) in seeds for k in range(len(w) - 4))]
    wanted = {(i, j, c) for i, j, _, c, _ in plain_leaks(some, [tuple(r) for r in bench.collect()], 5, 0.5)}
    assert {x for x in got if x[0] in ids} == wanted and wanted


def test_probing_sequence_rises_and_is_whole():
    sets = ann.probing_sequence(4, 10**6)
    assert len(sets) == len(set(sets)) == 3**4
    assert sets[0] == () and sets[1] == (0,)
    assert all(len({min(r, 7 - r) for r in s}) == len(s) for s in sets)


def vector_rows(seed=2, n=1500, d=16):
    rng = np.random.default_rng(seed)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(n, d)))]
    rows += [(n + k, rows[100][1]) for k in range(40)]  # one vector very often
    rows += [(n + 100 + k, (np.array(rows[200][1]) + rng.normal(size=d) * 1e-3).tolist()) for k in range(200)]
    return rows


def test_nearest_vectors(spark):
    rows = vector_rows()
    odd = [(9000, None), (9050, [0.0] * 16), (9100, [float("nan")] * 16), (9150, [None] + [1.0] * 15), (9200, [1.0, 2.0]), (9250, [float("inf")] * 16), (None, [1.0] * 16), rows[3]]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, grp int")
    queries = table.where("vec_id % 50 = 0")
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(np.float64)
    hit = total = 0
    for hot, group in ((ann.HOT_ROWS, ann.GROUP_ROWS), (20, 500)):
        old, ann.HOT_ROWS, ann.GROUP_ROWS = (ann.HOT_ROWS, ann.GROUP_ROWS), hot, group
        got = collections.defaultdict(list)
        for r in ann.nearest(table, queries).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(r)
        ann.HOT_ROWS, ann.GROUP_ROWS = old
        assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
        for q, own in got.items():
            at = int(np.flatnonzero(ids == q)[0])
            score = ann.cosine(np.broadcast_to(vectors[at], vectors.shape), vectors)
            score[at] = -9
            best = np.lexsort((ids, -score))[:5]
            assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and q not in {r["vec_id"] for r in own}
            for r in own:
                assert abs(r["score"] - score[ids == r["vec_id"]][0]) < 1e-14
            assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
            hit += len(set(ids[best].tolist()) & {r["vec_id"] for r in own})
            total += 5
    assert hit >= 0.95 * total
    many = [r["vec_id"] for r in ann.nearest(table, table.where("vec_id = 100")).orderBy("rank").collect()]
    assert many == [1500, 1501, 1502, 1503, 1504]
    assert ann.nearest(table.where("false"), queries).count() == 0 and ann.nearest(table, queries.where("false")).count() == 0


def test_probes_follow_the_recall_of_a_sample(spark):
    rng = np.random.default_rng(6)
    unit = ann._unit(rng.normal(size=(20_000, 64)))
    score = unit[:100] @ unit.T
    score[np.arange(100), np.arange(100)] = -3
    true = np.argsort(-score, axis=1)[:, :5]
    asked, near = np.repeat(unit[:100], 5, axis=0), unit[true.reshape(-1)]
    planned = ann.Settings().sized(1 << 22)  # the functions of a table far larger than this one
    got = ann.calibrated(ann.Settings(), 1 << 22, asked, near)
    for settings, enough in ((planned, False), (got, True)):
        tables = ann.Tables(settings, 64)
        visited, cells = tables.probes(asked), tables.cells(near)
        met = (visited == cells[:, :, None]).any(axis=(1, 2))
        assert (met == (ann.ranks(tables, asked, near) <= settings.probes)).all()
        assert (met.mean() >= ann.AIM) == enough
    few = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(unit[:300])], "vec_id long, vector array<double>")
    a, b = ann._true_pairs(few, few.where("vec_id < 20"), 5, 64)
    whole = unit[:20] @ unit[:300].T
    whole[np.arange(20), np.arange(20)] = -3
    assert np.allclose(np.sort((a * b).sum(axis=1)), np.sort(np.sort(whole, axis=1)[:, -5:].reshape(-1)))


def test_nearest_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.1])], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(few, few.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert ann.nearest(few.where("vec_id = 0"), few).where("query_id = 0").count() == 0


def test_arc_versions_and_declared_lengths():
    for version in (1, 2):
        head = {"URL": "http://a/x y", "IP-address": "1.2.3.4", "Archive-date": "20200102030405", "Content-type": "text/html"}
        bodies = [b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nfake\nhttp://b 1.1.1.1 20200101000000 text/html 3\nabc", b"", b"raw \x00 bytes\n\n"]
        content = warc.arc_header(version, "t.arc", "20200101000000")
        content += b"".join(warc.arc_line(version, head, len(b)) + b + b"\n" for b in bodies)
        got = list(warc.parse_arc(content))
        assert [b for _, b in got] == bodies and got[0][0]["URL"] == "http://a/x%20y"
        for bad in (content[:-4], content.replace(b"URL IP", b"URK IP"), content[len(warc.arc_header(version, "t.arc", "20200101000000")) :], b"x"):
            with pytest.raises(ValueError):
                list(warc.parse_arc(bad))
    assert list(warc.parse_arc(b"")) == []
    assert warc.iso_date("20200102030405") == "2020-01-02T03:04:05Z" and warc.iso_date("2020") == "2020-01-01T00:00:00Z"


def test_pages_through_arc_and_warc(spark, tmp_path):
    rows = [(1, "u", "a"), (2, "u", "a"), (3, None, "é\r\n\r\nWARC/1.1\r\n"), (4, "u u", None), (5, "u", ""), (None, "u", "a"), (7, "u", "b"), (7, "u", "b"), (6, "u", "b"), (None, "u", "only")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.archive_pages(pages, str(tmp_path / "w")).collect()
    wanted = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        lead = max(ids) if ids else None
        first = page == lead
        wanted.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else lead))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert warc.archive_pages(pages.where("false")).count() == 0
    records = [h for r in spark.read.text(str(tmp_path / "w"), wholetext=True).collect() for h, _ in warc.parse_warc(r["value"].encode())]
    assert len(records) == len(rows) and all(h["warc-date"] == "2024-01-01T00:00:00Z" for h in records)
    assert len({h["warc-record-id"] for h in records}) == len(set(rows))


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(4)
    for _ in range(60):
        n, m = rng.randrange(1, 6), rng.randrange(1, 7)
        sizes = [rng.randrange(0, 50) for _ in range(n)]
        whole = sum(sizes)
        room = [whole * (j + 1) // m - whole * j // m for j in range(m)]
        sent = sharding.flow(sizes, room)
        assert [sum(r) for r in sent] == sizes and [sum(c) for c in zip(*sent)] == room
        assert sum(sent[i][i] for i in range(min(n, m))) == sum(min(sizes[i], room[i]) for i in range(min(n, m)))
    assert sharding.flow([4, 4], [4, 4], [[5, 1], [1, 5]]) == [[0, 4], [4, 0]]
    costs = [[3, 1, 7], [2, 4, 1]]
    best = min(3 * a + (4 - a - c) + 7 * c + 2 * (3 - a) + 4 * (3 - (4 - a - c)) + (2 - c) for a in range(4) for c in range(3) if 0 <= 4 - a - c <= 3 and (3 - a) + (3 - (4 - a - c)) + (2 - c) == 4)
    sent = sharding.flow([4, 4], [3, 3, 2], costs)
    assert sum(sent[i][j] * costs[i][j] for i in range(2) for j in range(3)) == best
    with pytest.raises(ValueError):
        sharding.flow([2], [1])


def test_shards_of_equal_bytes(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(None, "no id", None, None, None), (None, None, None, None, None), (-5, None, None, "src0", None), (-5, None, None, "src0", None)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("shard", F.lit("x"))
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(6))
    blocks, sharding.BLOCK_ROWS = sharding.BLOCK_ROWS, 20
    got = sharding.reshard(rows, old, 6, 4, str(tmp_path / "s")).collect()
    sharding.BLOCK_ROWS = blocks
    wanted = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in rows.collect())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == wanted
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r)
    for own in slots.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sums = [sum(r["size"] for r in own) for own in slots.values()]
    assert len(sums) == 4 and max(sums) - min(sums) <= 2 * max(r["size"] for r in got)
    assert all(r["shard"] == r["old_shard"] for r in got if not r["rewritten"]) and any(not r["rewritten"] for r in got)
    written = spark.read.parquet(str(tmp_path / "s"))
    assert written.count() == sum(r["rewritten"] for r in got)
    assert sharding.reshard(rows.where("false"), old, 6, 4).count() == 0


def test_pipeline_stages(spark, sf, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("__rows", F.lit(1)).withColumn("label", F.lit("x"))
    odd = [(-1, None, "en", "s", 0, 1, "x"), (-2, "", "en", "s", 0, 1, "x"), (-3, "123 !", "en", "s", 5, 1, "x"), (None, "the words of this text have no id", "en", "s", 9, 1, "x")]
    docs = spark.createDataFrame(odd, docs.schema).unionByName(docs)
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k == 0:
            bad = {r["doc_id"] for r in langid.predict(before, langid.train(before)).where("rejected").collect()}
            assert {-1, -2, -3} <= bad and after.count() == before.count() - len(bad)
        if k == 1:
            parts = plain_components([(r["doc_id"], r["text"]) for r in before.collect() if r["doc_id"] is not None], 5, 80)
            assert {r["doc_id"] for r in after.collect()} - {None} == {i for i, (_, low) in parts.items() if i == low}
        if k == 2:
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            leaks = decontam.contaminated(before, bench).select("doc_id").distinct()
            assert after.count() == before.count() - leaks.count() < before.count()
        if k == 3:
            assert after.count() == before.count()
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in before.collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0
    assert corpus_pipeline.run(spark, sf).count() > 0
