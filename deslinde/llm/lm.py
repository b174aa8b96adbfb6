"""Log probabilities of whole documents: a unigram base with exact counts, and a recurrent language model on top of it.

The model knows the most frequent words; all others share one entry, and what a word is given there is its share
of the counts of these others, with one more for each and one for all that were never seen. The probabilities of
all texts so add up to one, and every count of the corpus takes part.

Training covers all training documents. It runs in a few rounds, each over chunks of its own: every task starts
from the same parameters and makes one pass over its chunks, and parameters are averaged by trained tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deslinde.llm import lexicon
from deslinde.llm.common import column, discard, ready, saved
from deslinde.llm.gru import Gru, class_borders

_LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_GAP = re.compile(rb"[ \t-\r]")
END = b"\n"  # white space, so no word
CHUNK_WORDS = 1 << 18
SCORE_WORDS = 1 << 21  # words that are scored together, beside the chunk that passes it
CHUNKS = "chunk long, doc_ids array<long>, held array<boolean>, lengths array<long>, place binary, ids binary, bucket int, list binary"
NUMBERS = 1 << 12  # a looked-up value is count * NUMBERS + number in the model, 0 for the other words


@dataclass(frozen=True)
class Settings:
    words: int = 2048  # words that the model knows, fewer than NUMBERS
    classes: int = 48
    hidden: int = 16
    window: int = 16  # steps that a gradient goes back
    lanes: int = 512
    rate: float = 0.05
    shares: tuple[float, ...] = (1 / 16, 1 / 4, 1.0)  # of the chunks that have been read after each round


def _chunked(limit: int, buckets: int):
    """Whole documents in chunks of at least ``limit`` words, the last one fewer: a row of word numbers, with an end after
    each document, and a row for each bucket with the chunk's different words there and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        numbers, ids, docs = lexicon.Numbering(END), [], []

        def rows() -> pa.RecordBatch:
            nonlocal numbers, ids, docs, made
            made += 1
            every, lengths = np.concatenate(ids), [d[2] for d in docs]
            training = np.repeat([not d[1] for d in docs], lengths)
            counts = np.bincount(every[training], minlength=len(numbers))[1:]
            words = list(numbers)[1:]
            place = lexicon.buckets_of(words, buckets)
            lists = lexicon.packed_lists(words, counts, place)
            none = [None] * len(lists)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | made] * (1 + len(lists)), pa.int64()), pa.array([[d[0] for d in docs], *none], pa.list_(pa.int64())),
                    pa.array([[d[1] for d in docs], *none], pa.list_(pa.bool_())), pa.array([lengths, *none], pa.list_(pa.int64())),
                    pa.array([lexicon.squeezed(place.tobytes()), *none], pa.binary()), pa.array([lexicon.squeezed(lexicon.packed_ids(every)), *none], pa.binary()),
                    pa.array([None, *(k for k, _ in lists)], pa.int32()), pa.array([None, *(x for _, x in lists)], pa.binary()),
                ],
                ["chunk", "doc_ids", "held", "lengths", "place", "ids", "bucket", "list"],
            )
            numbers, ids, docs = lexicon.Numbering(END), [], []
            return out

        held = 0
        for batch in batches:
            for text, doc, out_of in zip(column(batch, "text"), column(batch, "doc_id").to_pylist(), column(batch, "held").to_pylist()):
                raw, n = (text.as_buffer().to_pybytes().translate(_LOW) if text.is_valid else b""), 1
                for step in lexicon.steps_of(raw, _GAP):
                    ids.append(numbers.of(step.split()))
                    n += len(ids[-1])
                ids.append(np.zeros(1, np.int32))
                docs.append((doc, out_of, n))
                held += n
                if held >= limit:
                    yield rows()
                    held = 0
        if docs:
            yield rows()

    return run


@dataclass(frozen=True)
class Corpus:
    """What a chunk's task needs of the whole corpus: a few numbers, whatever the size of the corpus."""

    tokens: int  # training tokens
    kinds: int  # different ones
    ends: int
    other_tokens: int  # of the words that the model doesn't know
    other_kinds: int
    end: int  # number of the end in the model
    other: int  # number of the other words


class Chunk:
    """Counts and model numbers of the tokens of one chunk."""

    def __init__(self, batch: pa.RecordBatch, k: int, corpus: Corpus):
        ids = lexicon.unpacked_ids(lexicon.unsqueezed(column(batch, "ids")[k].as_py()))
        values = lexicon.replied(column(batch, "replies")[k], np.frombuffer(lexicon.unsqueezed(column(batch, "place")[k].as_py()), np.uint16))
        counts, number = values // NUMBERS, values % NUMBERS - 1
        number[number < 0] = corpus.other
        counts[0], number[0] = corpus.ends, corpus.end
        self.counts, self.stream = counts[ids], number.astype(np.int16)[ids]
        self.lengths = column(batch, "lengths")[k].values.to_numpy()
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.held = np.array(column(batch, "held")[k].as_py(), bool)


def _trained(model: Gru, flat: np.ndarray, corpus: Corpus, settings: Settings):
    """One pass over the task's chunks from the parameters ``flat``: (part, weight, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = flat.copy(), 0
        for batch in batches:
            for k in range(len(batch)):
                chunk = Chunk(batch, k, corpus)
                stream = chunk.stream[np.repeat(~chunk.held, chunk.lengths)]
                model.train(own[0], own[1], stream, corpus.end, settings.lanes, settings.window, settings.rate)
                weight += len(stream)
        if weight:
            yield _sent(TaskContext.get().partitionId(), weight, own)

    return run


def _sent(part: int, weight: float, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([float(weight)]), pa.array([values.astype(np.float32).tobytes()], pa.binary())],
        ["part", "weight", "parameters"],
    )


def _averaged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted average of the parameters of a group of tasks; they come one by one and are not held."""
    weight, sums = 0.0, 0.0
    for batch in batches:
        for w, x in zip(column(batch, "weight").to_pylist(), column(batch, "parameters")):
            weight, sums = weight + w, sums + w * np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
    yield _sent(key[0].as_py(), weight, sums / weight)


def train(chunks: DataFrame, model: Gru, start: np.ndarray, corpus: Corpus, settings: Settings) -> np.ndarray:
    """Parameters after a pass over the training documents of all chunks."""
    schema, now, before = "part long, weight double, parameters binary", np.stack([start, np.full(model.size, 1e-3, np.float32)]), 0.0
    place = F.pmod(F.xxhash64("chunk"), F.lit(1 << 20)) / (1 << 20)
    for share in settings.shares:
        mine = chunks.where((place >= before) & (place < share))
        sent = mine.mapInArrow(_trained(model, now, corpus, settings), schema)
        # 32 tasks at a time, then 32 of these, so that no task takes in more than a share of all
        for step in (32, 32):
            sent = sent.withColumn("part", F.expr(f"part div {step}")).groupBy("part").applyInArrow(_averaged, schema)
        last = sent.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInArrow(_averaged, schema).first()
        if last is not None:
            now = np.frombuffer(last["parameters"], np.float32).reshape(2, -1).copy()
        before = share
    return now[0]


def _score_rows(model: Gru, flat: np.ndarray, corpus: Corpus, settings: Settings, chunks: list[tuple[Chunk, pa.Array]]) -> pa.RecordBatch:
    """Scores of the documents of some chunks, whose lanes run side by side: long documents of each wait for one another only once."""
    stream, counts, held, lengths = (np.concatenate([getattr(c, x) for c, _ in chunks]) for x in ("stream", "counts", "held", "lengths"))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    base = np.log10((counts + 1) / (corpus.tokens + 1 * (corpus.kinds + 1)))
    inside = np.log10((counts + 1) / (corpus.other_tokens + corpus.other_kinds + 1))
    own = model.score(flat, stream, begins, corpus.end, settings.lanes, settings.window) / np.log(10)
    own += np.add.reduceat(np.where(stream == corpus.other, inside, 0.0), begins[:-1])
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([ids for _, ids in chunks]), pa.array(held), pa.array(lengths), pa.array(np.add.reduceat((counts > 0).astype(np.int64), begins[:-1])),
            pa.array(np.full(len(held), corpus.tokens)), pa.array(np.add.reduceat(base, begins[:-1])), pa.array(own),
        ],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def _scored(model: Gru, flat: np.ndarray, corpus: Corpus, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, tokens = [], 0
        for batch in batches:
            for k in range(len(batch)):
                waiting.append((Chunk(batch, k, corpus), column(batch, "doc_ids")[k].values))
                tokens += len(waiting[-1][0].stream)
                if tokens >= SCORE_WORDS:
                    yield _score_rows(model, flat, corpus, settings, waiting)
                    waiting, tokens = [], 0
        if waiting:
            yield _score_rows(model, flat, corpus, settings, waiting)

    return run


def document_scores(
    docs: DataFrame, held_out: Column | str, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text",
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from the documents where ``held_out`` is not true. Tokens are words between ASCII white space, A-Z as a-z, and an
    end. ``n_known`` counts those that occur in training documents, of which there are ``train_tokens``; ``base_score`` sums
    log10((c + 1) / (N + V + 1)), ``score`` is the model's log10 probability. A null text is empty and scores its end alone,
    a null id or a null ``held_out`` stays or counts as false, repeated rows are scored and learned from each time; an empty
    table gives no rows; other columns are not read. A text may have any length: it is read in steps, its state goes on from
    window to window, and only its word numbers, four bytes each, are held whole.

    Settings bound the model (its parameters pass the driver, about a megabyte); counts are joined and have no bound.
    """
    spark = ready(docs.sparkSession)
    held = F.expr(held_out) if isinstance(held_out, str) else held_out
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    buckets = min(1 << 16, max(64, 4 * rows.rdd.getNumPartitions()))
    chunks = saved(rows.mapInArrow(_chunked(chunk_words, buckets), CHUNKS), "chunks")
    lists = chunks.where("bucket is not null").select("chunk", "bucket", "list")
    words = saved(lexicon.bucket_words(lists, settings.words), "words", tidy=True)
    ends = chunks.where("held is not null").select(F.explode("held").alias("held")).where(~F.col("held")).count()
    kinds, total = words.where("word is null").agg(F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = words.where("word is not null").orderBy(F.desc("n"), "word").limit(settings.words).collect()
    known = sum(r["n"] for r in top)
    # model numbers by falling count; the end and the entry of all other words are among them
    entries = sorted([(-r["n"], r["word"]) for r in top] + [(-ends, END.decode()), (known - total, "")])
    number = {word: k for k, (_, word) in enumerate(entries)}
    corpus = Corpus(total + ends, kinds + (ends > 0), ends, total - known, kinds - len(top), number[END.decode()], number[""])
    counts = np.array([-n for n, _ in entries], np.float64)
    model = Gru(class_borders(counts, settings.classes), settings.hidden)

    numbers = {w.encode(): k + 1 for w, k in number.items() if w.strip()}
    replies = lexicon.bucket_replies(lists, numbers, NUMBERS).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies"))
    texts = chunks.where("ids is not null").drop("bucket", "list")
    asked = saved(texts.join(replies, "chunk", "left"), "asked", tidy=True)
    discard(chunks)
    flat = train(asked, model, model.start(counts), corpus, settings)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return asked.mapInArrow(_scored(model, flat, corpus, settings), schema)
