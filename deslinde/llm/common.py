"""Helpers that several corpus operators share: session settings, Arrow columns, hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from deslinde.session import configure, cut, scratch_path

__all__ = ["ready", "cut", "saved", "discard", "table", "fresh", "column", "texts_of", "pieces_of", "Words", "words_of", "mix"]

SETTINGS = {
    # an Arrow batch of documents is held whole in a Python worker, beside what is computed from it
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # the driver keeps the text of every plan and of every change to it at run time; an iteration has hundreds
    "spark.sql.maxPlanStringLength": "20000",
}
# Bytes of text that one vectorised step looks at together; a longer text is a step of its own.
STEP_BYTES = 1 << 19


def ready(spark: SparkSession) -> SparkSession:
    """The library's session settings, small Arrow batches and short plan texts."""
    configure(spark)
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files go as soon as the execution that made them ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from the written rows.

    ``tidy`` removes the shuffle files of the write at once, where nothing else is computed from ``df``.

    Unlike a checkpoint, a written table is columnar and has a known size, so Spark
    can prune its columns and choose join strategies by measured bytes.
    """
    path = scratch_path(df.sparkSession, name)
    spark = df.sparkSession
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, str(tidy).lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a table of `saved` that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row begins (one entry more than rows); a null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces_of(at: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) of at most ``most`` bytes together, a longer row alone."""
    a, n = 0, len(at) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E6D62D06F6A9A9B)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=4)
def _byte_values(alnum_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """For every byte: its value in a word's hash (capitals as small letters), and whether it parts words."""
    byte = np.arange(256)
    parts = np.isin(byte, [0x20, *range(0x09, 0x0E)])
    if alnum_only:
        letters = ((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)
        parts = ~(letters | ((byte >= 48) & (byte <= 57)) | (byte >= 128))
    low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    values = mix(low.astype(np.uint64) + np.uint64(0x51ED27))
    return np.where(parts, np.uint64(0), values), parts


_BASE, _INVERSE = np.uint64(0x2545F4914F6CDD1D), np.uint64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in ((0, _BASE), (1, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """Words of some rows: a 64-bit hash, start and end byte of each, and each row's first word (one entry more than rows)."""

    __slots__ = ("hashes", "starts", "ends", "first")

    def __init__(self, hashes, starts, ends, first):
        self.hashes, self.starts, self.ends, self.first = hashes, starts, ends, first


def words_of(raw: np.ndarray, at: np.ndarray, alnum_only: bool = False) -> Words:
    """Hash the words of the rows whose bytes are ``raw`` with borders ``at`` (both as from `texts_of`).

    A-Z count as a-z. Words are parted by ASCII white space, or with ``alnum_only`` by all
    ASCII bytes but letters and digits. Equal words have equal hashes in any row, task or run.
    """
    values, parts = _byte_values(alnum_only)
    n, at = len(raw), at - at[0]
    gap = parts[raw]
    word = ~gap
    begins = word.copy()
    begins[1:] &= gap[:-1]
    inner = at[(at > 0) & (at < n)]
    begins[inner] = word[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, starts, np.zeros(len(at), np.int64))
    ends = word.copy()
    ends[:-1] &= gap[1:]
    ends[inner - 1] = word[inner - 1]
    power, inverse = _powers(n)
    sums = np.add.reduceat(values[raw] * power, starts) * inverse[starts]
    stops = np.flatnonzero(ends) + 1
    return Words(mix(sums + (stops - starts).astype(np.uint64)), starts, stops, np.searchsorted(starts, at))
