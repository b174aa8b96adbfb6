"""One query per corpus operator, over its whole table, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde.llm import ann, chat, decontam, langid, lm, mining, neardup, packing, phrases, secrets, sharding, tokencount, warc
from deslinde.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@_query("op5_packing")
def _packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@_query("op10_token_counts")
def _token_counts(spark, sf_dir):
    """Totals, suffix sums and truncated totals at every encoded length of the documents."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


@_query("op6_near_duplicates")
def _near_duplicates(spark, sf_dir):
    """Component of every document under a Jaccard similarity of 0.8 of two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@_query("op9_benchmark_leaks")
def _benchmark_leaks(spark, sf_dir):
    """Documents whose tiles cover half of a test item or more."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op3_secrets")
def _secrets(spark, sf_dir):
    """Secrets of all documents, in the texts and in what is encoded in them."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@_query("op4_languages")
def _languages(spark, sf_dir):
    """Predicted language of all documents."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@_query("op1_nearest_vectors")
def _nearest_vectors(spark, sf_dir):
    """The five nearest vectors of every fiftieth one, by cosine."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@_query(
    "op2_archive_pages",
    """
    WITH hashed AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
    ), digested AS (
        SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            CAST((CAST('0x' || substr(hex, CAST((i // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS BIGINT) + 1, 1)),
            'string_agg', '') AS payload_digest
        FROM hashed
    ), led AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS lead FROM digested)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> lead THEN lead END AS refers_to
    FROM led
    """,
)
def _archive_pages(spark, sf_dir):
    """All pages as ARC, then WARC, read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@_query("op7_reshard")
def _reshard(spark, sf_dir):
    """All documents from 24 shards by source to 40 of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(24))
    return sharding.reshard(docs, old, old_shards=24, new_shards=40)


@_query(
    "op8_chat_format",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    )
    SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(role) + length(text) + 24 + len(regexp_extract_all(text, '<\\*\|im_(start|end)\|>'))) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
    """,
)
def _chat_format(spark, sf_dir):
    """All conversations formatted and read back, and one whose texts hold the control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(turns.unionByName(more))


@_query(
    "op11_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
    occurring AS (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
        FROM worded, (VALUES (1), (2), (3), (4)) sizes(size)
    ), counted AS (SELECT lang, size, phrase, count(*) AS a FROM occurring GROUP BY ALL HAVING count(*) >= 30),
    split AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1),
    cut AS (
        SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM split, (VALUES (1), (2), (3)) cuts(k) WHERE k < size
    ), scored AS (
        SELECT c.lang, c.size, c.phrase, c.a, h.a AS l, t.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (h.a + t.a) AS BIGINT) AS score
        FROM cut c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(2000000 AS HUGEINT) * c.a // (h.a + t.a), c.k) = 1
    ), inside AS (
        SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM split, (VALUES (2), (3)) inner_sizes(m) WHERE m < size
    ), longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
    kept AS (
        SELECT s.* FROM scored s LEFT JOIN longer x USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * s.a
    ), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """,
)
def _collocations(spark, sf_dir):
    """The 2000 phrases of each language that keep together best."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@_query(
    "op12_hard_negatives",
    """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS score
        FROM rows a JOIN rows b ON b.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
    ), positive AS (
        SELECT anchor_id, vec_id AS positive_id, score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
           n.vec_id AS negative_id, CAST(p.score AS BIGINT) AS positive_score, CAST(n.score AS BIGINT) AS negative_score
    FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3
    """,
)
def _hard_negatives(spark, sf_dir):
    """Three negatives between half and 95 % of each positive's score, for every fiftieth vector; a seventh of the labels is shifted."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", label)


@_query("op13_lm_scores")
def _lm_scores(spark, sf_dir):
    """Log probability of every document by unigrams and by the recurrent model, a seventh of them held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return lm.document_scores(table(spark, sf_dir, "documents"), held_out)
