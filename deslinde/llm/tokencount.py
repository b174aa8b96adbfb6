"""Exact token counts for every context limit, from one histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deslinde.llm.common import column, ready, saved, texts_of
from deslinde.llm.tokens import VOCABULARY, shared

# Lengths that one window task sums; longer histograms are summed in as many tasks as they have such runs.
RUN = 512


def encoded_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(length, docs): documents by tokens of their whole text. A null or empty text has length 0; repeated rows count each.

    Each Arrow batch is counted before it leaves the worker, and Spark's partial aggregation
    adds up the rest, so the shuffle carries a row per length and task at most.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared(vocabulary)
        for batch in batches:
            raw, at = texts_of(column(batch, "text"))
            lengths = pa.array([coder.count(raw[at[k] : at[k + 1]].tobytes()) for k in range(len(at) - 1)], pa.int64())
            counts = lengths.value_counts()
            yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["length", "docs"])

    return docs.select("text").mapInArrow(run, "length long, docs long").groupBy("length").agg(F.sum("docs").alias("docs"))


def length_table(histogram: DataFrame, run: int = RUN) -> DataFrame:
    """One row per encoded length, with what holds for a context limit of that many tokens.

    docs, tokens: of this length; docs_to, tokens_to: of this length or less; docs_over, tokens_over:
    longer ones (suffix sums); truncated: tokens left when every document is cut at the limit. The
    sums run within runs of ``run`` lengths, to which the totals of the other runs are added, so no
    task sees the whole histogram. An empty table gives no row.
    """
    rows = histogram.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), F.expr(f"length div {run}").alias("run_no"))
    runs = rows.groupBy("run_no").agg(F.sum("docs").alias("run_docs"), F.sum("tokens").alias("run_tokens"))
    later = Window.orderBy("run_no").rowsBetween(1, Window.unboundedFollowing)
    earlier = Window.orderBy("run_no").rowsBetween(Window.unboundedPreceding, -1)
    of_runs = runs.select(  # a row per run: a document of a million tokens makes it 2,000 rows
        "run_no",
        *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_{n}") for c in ("run_docs", "run_tokens") for n, w in (("to", earlier), ("over", later))),
    )
    own = Window.partitionBy("run_no").orderBy("length")
    back = own.rowsBetween(Window.unboundedPreceding, 0)
    ahead = own.rowsBetween(1, Window.unboundedFollowing)
    out = rows.join(of_runs, "run_no")
    for c in ("docs", "tokens"):
        out = out.withColumn(f"{c}_to", F.sum(c).over(back) + F.col(f"run_{c}_to"))
        out = out.withColumn(f"{c}_over", F.coalesce(F.sum(c).over(ahead), F.lit(0)) + F.col(f"run_{c}_over"))
    names = ["length", "docs", "tokens", "docs_to", "tokens_to", "docs_over", "tokens_over"]
    return out.select(*names, (F.col("tokens_to") + F.col("length") * F.col("docs_over")).alias("truncated"))


def at_limits(lengths: DataFrame, limits: DataFrame) -> DataFrame:
    """For any ``limit`` (long): documents and tokens within it, documents over it, and the tokens left when cut at it.

    The answer for a limit between two lengths is that of the longest length not over it; limits
    below every length keep ``limit`` tokens of each document. Null and repeated limits are left out.
    """
    wanted = limits.select(F.col("limit").cast("long")).where("limit is not null").distinct()
    total = (F.col("docs_to") + F.col("docs_over")).alias("total")
    last = lengths.select(F.col("length").alias("limit"), "docs_to", "tokens_to", total, F.lit(False).alias("asked"))
    none = [F.lit(None).cast("long").alias(c) for c in ("docs_to", "tokens_to", "total")]
    # a row per distinct length and limit: bounded by the longest document, not by their number
    filled = last.unionByName(wanted.select("limit", *none, F.lit(True).alias("asked")))
    before = Window.orderBy("limit", "asked").rowsBetween(Window.unboundedPreceding, 0)
    known = {c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(0)) for c in ("docs_to", "tokens_to")}
    known["total"] = F.coalesce(F.max("total").over(Window.partitionBy(F.lit(0))), F.lit(0))
    over = F.col("total") - F.col("docs_to")
    return filled.withColumns(known).where("asked").select(
        "limit", "docs_to", "tokens_to", over.alias("docs_over"), (F.col("tokens_to") + F.col("limit") * over).alias("truncated")
    )


def quantiles(lengths: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents does not exceed; none of an empty table."""
    total = F.col("docs_to") + F.col("docs_over")
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    rows = lengths.select("length", "docs_to", total.alias("total"), asked)
    return rows.where("docs_to >= share * total").groupBy("share").agg(F.min("length").alias("length"))


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """`length_table` of the documents; the histogram is written first, as the sums read it several times.

    Nulls: a null text has no token; other columns are not read and may have any name or value.
    """
    return length_table(saved(encoded_lengths(docs, vocabulary), "lengths"))
