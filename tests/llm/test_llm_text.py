"""Token ids, packing, counts, secrets, languages and chats against plain versions."""

import base64
import bz2
import collections
import gzip
import hashlib
import lzma
import re
import urllib.parse
import zlib
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from deslinde.llm import chat, langid, packing, secrets, tokencount, tokens

ODD = [
    "Ça va? L'été d'I'm don't's İstanbul ΣΑΣ ét́ café—naïve <|endoftext|> a\x1cb c 12ab'34 ß ẞ ÀÉ§ x²y ﬁne\x85z",
    "", " \n ", "'S 'LL x'Re\tIt'S.", "word,word;WORD (word) 　 日本語 ``x``", "\x0b\x0c\x1d", "Kelvin Å", "...!?", "a" * 3000,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, length string, held_out string"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", *ODD, "same text", "same text", "x " * 4000]
    rows = [(k, t, None if k % 3 else "en", None, 0, "extra", None, "no") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", None, None, None, None, None, None), rows[-1]], SCHEMA)


@pytest.fixture(scope="module")
def whole(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def plain_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(plain_ids, "t"):
        plain_ids.t = Tokenizer.from_file(tokens.vocabulary_path())
        plain_ids.t.encode_special_tokens = True
    return plain_ids.t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("most", [3, 1000])
def test_stored_words_give_the_tokenizers_ids(whole, most):
    coder = tokens.WordTokens(most_words=most)
    texts = ODD + [r["text"] for r in whole.limit(60).collect()]
    for text in texts:
        assert np.frombuffer(coder.ids(text.encode()), "<u4").tolist() == plain_ids(text)
        assert coder.count(text.encode()) == len(plain_ids(text))


def test_levelled_windows_are_nearly_equal():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 300).tolist() + [1] * 40
    windows = packing.level(sizes, 16)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 4
    assert packing.level([], 3) == [[], [], []]


def test_windows_rise_when_the_capacity_is_exceeded():
    assert len(packing.fill([6, 6, 6], 10)) == 3
    assert len(packing.fill([5, 5, 5, 5], 10)) == 2


def check_pieces(rows, source, capacity):
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= capacity
    for doc_id, wanted in source.items():
        for text in set(wanted):
            ids = np.array([*plain_ids(text), 1], "<u4")
            own = [r for r in texts[doc_id] if r["doc_tokens"] == len(ids)]
            cover = np.zeros(len(ids), int)
            for r in own:
                part = ids[r["start"] : r["start"] + r["length"]]
                assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
                cover[r["start"] : r["start"] + r["length"]] += 1
            assert (cover == wanted.count(text)).all()
    sums = [sum(r["length"] for r in own) for own in sequences.values()]
    return sum(0 if s & (s - 1) == 0 else capacity - s for s in sums) / sum(sums)


def test_packing_places_every_id_once(docs):
    source = collections.defaultdict(list)
    for r in docs.collect():
        source[r["doc_id"]].append(r["text"])
    for parts in (1, 3):
        check_pieces(packing.pack(docs.repartition(parts), capacity=64, windows=8).collect(), source, 64)
    assert packing.pack(docs.where("false")).count() == 0


def test_packing_leaves_little_padding(whole):
    source = {r["doc_id"]: [r["text"]] for r in whole.collect()}
    assert check_pieces(packing.pack(whole).collect(), source, packing.CAPACITY) < 0.02


def test_length_table_against_plain_sums(docs, spark):
    lengths = sorted(len(plain_ids(r["text"])) for r in docs.collect())
    rows = tokencount.length_table(tokencount.encoded_lengths(docs), run=4).collect()
    assert sorted(r["length"] for r in rows) == sorted(set(lengths))
    for r in rows:
        own = r["length"]
        assert (r["docs"], r["tokens"]) == (lengths.count(own), own * lengths.count(own))
        assert r["docs_to"] == sum(x <= own for x in lengths) and r["tokens_to"] == sum(x for x in lengths if x <= own)
        assert r["docs_over"] == sum(x > own for x in lengths) and r["tokens_over"] == sum(x for x in lengths if x > own)
        assert r["truncated"] == sum(min(x, own) for x in lengths)
    table = tokencount.count_tokens(docs)
    asked = spark.createDataFrame([(0,), (1,), (7,), (5000,), (10**9,), (None,), (7,)], "limit long")
    got = {r["limit"]: r for r in tokencount.at_limits(table, asked).collect()}
    assert set(got) == {0, 1, 7, 5000, 10**9}
    for limit, r in got.items():
        assert r["truncated"] == sum(min(x, limit) for x in lengths) and r["docs_over"] == sum(x > limit for x in lengths)
    for r in tokencount.quantiles(table, [0.1, 0.5, 1.0]).collect():
        assert r["length"] == min(x for x in lengths if sum(y <= x for y in lengths) >= r["share"] * len(lengths))
    empty = tokencount.count_tokens(docs.where("false"))
    assert empty.count() == 0 and tokencount.quantiles(empty, [0.5]).count() == 0


SECRET = "password = hunter2hunter2"


def escapes(text):
    return "".join(f"\\u{ord(c):04x}" for c in text)


def percents(text):
    return "".join(f"%{b:02X}" for b in text.encode())


def b64(data):
    return base64.b64encode(data.encode() if isinstance(data, str) else data).decode()


@pytest.mark.parametrize("wrapped", [
    escapes(SECRET), percents(SECRET), b64(SECRET), b64(gzip.compress(SECRET.encode())), b64(zlib.compress(SECRET.encode())),
    b64(bz2.compress(SECRET.encode())), percents(b64(SECRET)), b64(percents(SECRET)), b64(gzip.compress(b64(gzip.compress(escapes(SECRET).encode())).encode())),
    "".join(f"&#{ord(c)};" for c in SECRET), "".join(f"%{b:02X}" for b in gzip.compress(SECRET.encode())), b64(b64(b64(b64(b64(SECRET))))),
])
def test_secret_under_layers_is_mapped_to_its_place(wrapped):
    text = f"é before {wrapped} after"
    base, added, layers = secrets.search(text)
    start, end = 9, 9 + len(wrapped)
    assert not base and layers >= 1 and len(added) == 1
    assert start <= added[0][0] and added[0][2] <= end and added[0][2] > end - 6


def test_partly_encoded_secret_and_its_span():
    text = "x pass%77ord=abcdefgh%31 y"
    assert secrets.search(text)[1] == [(2, 0, 24)]
    pair = "token=\\ud83d\\ude00 secret: \\u0061bcdefgh1"
    assert (20 - 20, 0) and secrets.search(pair)[1] == [(19, 0, len(pair))]


def test_circles_broken_streams_and_bombs_end():
    assert secrets.search("%2525252525252541")[2] >= 3
    bomb = b64(gzip.compress(b"a " * 100_000))
    assert secrets.search(bomb, size=1000)[1] == []
    for text in ("%FF%FE%1F%8B", b64(gzip.compress(b"abc")[:-3]), "\\ud83d alone", "%", "\\u12", "x " * 40, b64("x " * 20)):
        secrets.search(text)


KEY = SECRET.encode()
NOISE = bytes(range(200, 256))


@pytest.mark.parametrize("hidden", [
    b64(gzip.compress(b"hello there") + gzip.compress(KEY)), b64(bz2.compress(b"x") + bz2.compress(KEY)),  # a second member
    b64(SECRET.encode("utf-16")), b64(SECRET.encode("utf-16-be")), b64(b"\0\1" + KEY + b"\0\xff"),  # no clean UTF-8
    base64.encodebytes(SECRET.encode() * 5).decode().strip(), base64.encodebytes(gzip.compress(NOISE * 3 + KEY)).decode().strip(),  # over lines
    "data/" + b64(SECRET), "word" + b64(SECRET), "w-" + b64(SECRET), "a/b" + b64(zlib.compress(KEY)), "data/" + b64(lzma.compress(KEY)),  # glued
    "%FE%FF" + percents(SECRET) + "%FE", "\\ud800" + escapes(SECRET) + "\\udc00",
    quote(gzip.compress(KEY * 3)), quote(zlib.compress(KEY * 3)), quote(bz2.compress(KEY)), quote(lzma.compress(KEY)),
])
def test_no_layer_is_dropped(hidden):
    """A span inside the run, and nothing left once it is masked."""
    text = f"before {hidden} after"
    base, added, _ = secrets.search(text)
    assert not base and added and all(7 <= a < b <= 7 + len(hidden) for a, _, b in added)
    assert secrets._masked(text, secrets.PIECE).startswith("before ") and not secrets.search(secrets._masked(text, secrets.PIECE))[1]


@pytest.mark.parametrize("size", [1 << 10, secrets.PIECE])
def test_large_streams_are_looked_at_to_the_end(size):
    body = b"a few words. " * (30 if size == 1 << 10 else 700) * 1000
    wrapped = b64(gzip.compress(gzip.compress(body + KEY) if size > 1 << 10 else body + KEY))
    assert secrets.search("x " + wrapped, size)[1] == [(2, 0, 2 + len(wrapped))]


def plain_spans(text):
    out = []
    for m in re.finditer("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(out)


def test_secret_rows_and_masks(spark, whole):
    extra = ["Token='abcdefgh' api_KEY:12345678 ſecret=12345678 passwd=short", "AKIA" + "Z" * 12 + " é AKIAZ", "0" * 31 + " " + "f" * 33, None, "", percents(SECRET)]
    rows = spark.createDataFrame([(-k - 1, t, None, None, 5) for k, t in enumerate(extra)], whole.schema).unionByName(whole)
    got = {r["doc_id"]: r for r in secrets.find_secrets(rows).collect()}
    source = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    assert set(got) == set(source)
    for doc_id, text in source.items():
        spans, r = plain_spans(text), got[doc_id]
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    masked = secrets.redact(rows)
    assert masked.columns == rows.columns and masked.count() == rows.count()
    for r in masked.collect():
        if source[r["doc_id"]] and r["text"]:
            assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
            if not got[r["doc_id"]]["spans"]:
                assert r["text"] == source[r["doc_id"]]
    assert masked.where("doc_id = -4").first()["text"] is None


def test_languages_held_out_and_odd_rows(spark, whole, docs):
    model = langid.train(whole, per_language=60)
    got = {r["doc_id"]: r for r in langid.predict(whole, model).collect()}
    held = [r for r in whole.collect() if got[r["doc_id"]]["held_out"]]
    for r in whole.collect():
        assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert not langid.sample(whole, 10**9).join(whole.where(langid.held_out()), "doc_id").count()
    odd = langid.predict(docs, model).collect()
    assert len(odd) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in odd:
        letters = any(map(str.isalpha, texts[r["doc_id"]] or ""))
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["rejected"] or letters
    kept = {r["doc_id"] for r in langid.accepted(docs, model).collect()}
    assert kept == {r["doc_id"] for r in odd if not r["rejected"]}
    assert langid.accepted(docs, model).columns == docs.columns
    none = langid.train(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"} and langid.accepted(docs, none).count() == 0


def test_temperature_makes_probabilities_true():
    rng = np.random.default_rng(6)
    logits = rng.normal(size=(4000, 3)) * 2
    odds = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    answers = np.array([rng.choice(3, p=p) for p in odds])
    assert 2.6 < langid._temperature(logits * 3, answers) < 3.5


HARD = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|im_start|> <|im_end", "<|im_start|>", "", "\n", "a<|im_end|>\n", "|im_end|>", "<|im_other|>"]


@pytest.mark.parametrize("role", ["user", "assistant", "", "two\nlines", "<|im_end|>", "back\\slash\\n", "<\\|im_start|>"])
@pytest.mark.parametrize("text", HARD)
def test_a_turn_parses_to_itself(role, text):
    assert chat.unescape(chat.escape(text)) == text
    out = chat.render(role, text)
    assert [(r, t) for r, t, _, _ in chat.parse(out + out)] == [(role, text)] * 2
    if not chat._CONTROL.search(text) and role == "user":
        assert out == f"<|im_start|>user\n{text}<|im_end|>\n"


@pytest.mark.parametrize("broken", ["x", "<|im_start|>user", "<|im_start|>user\nx", "<|im_start|>u\nx<|im_end|>", "<|im_start|>a\n<|im_start|>b\n<|im_end|>\n"])
def test_what_is_not_of_the_grammar_is_refused(broken):
    with pytest.raises(chat.Broken):
        chat.parse(broken)


def test_chat_digests_against_plain_ones(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", HARD[0]), (1, 2, "assistant", "é"), (1, 2, "assistant", "é"), (2, None, None, None), (None, 3, "user", "x")]
    rows += [(3, k, "assistant" if k % 2 else "user", HARD[k % len(HARD)] * (k % 5)) for k in range(300)]
    rows += [(4, 0, "assistant", "y" * (chat.CHUNK_CHARS + 5)), (4, 1, "user", "z")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    for parts in (1, 4):
        got = {r["conv_id"]: r for r in chat.round_trip(turns.repartition(parts)).collect()}
        assert set(got) == {1, 2, 3, 4, None}
        for conv in got:
            own = sorted((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
            loss = "".join(t for _, role, t in own if role == "assistant")
            r = got[conv]
            assert r["n_turns"] == len(own)
            assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in own).encode()).hexdigest()
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
            assert r["formatted_chars"] == sum(len(chat.render(a, t)) for _, a, t in own)
    assert chat.round_trip(turns.where("false")).count() == 0
    assert chat.format_chats(turns.where("conv_id = 3")).agg(F.count("*")).first()[0] >= 5


def test_chat_rows_that_tie_keep_the_order_of_their_texts(spark):
    texts = [f"{k:05d}" * (1 + k % 3) for k in range(2000)]
    turns = spark.createDataFrame([(1, None, "assistant", t) for t in texts], "conv_id long, turn long, role string, text string")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    got = chat.round_trip(turns.repartition(5)).collect()
    spark.conf.set(key, old)
    assert [r["loss_sha256"] for r in got] == [hashlib.sha256("".join(sorted(texts)).encode()).hexdigest()]
