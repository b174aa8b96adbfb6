"""Ordered scans whose groups may be of any size.

A window over (worker, time) hands a worker's whole history to one task. Here the rows
are range-partitioned over (key, order), so a busy key is spread over as many partitions
as it fills; windows run inside a partition and a small table with one row per
(partition, key) carries the state over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.session import cut

CHUNK = "_chunk"
BEFORE = (Window.unboundedPreceding, -1)


def chunked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in range partitions of (keys, order), numbered and written, so that every
    later reader sees the same boundaries. ``order`` should be total."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(n, *keys, *order).withColumn(CHUNK, F.spark_partition_id()))


def with_carry(rows: DataFrame, keys: list[str], state: Column, merge) -> DataFrame:
    """Join to every row the state its key had at the end of the partitions before.

    ``state`` summarises one (partition, key); ``merge`` turns a column of summaries into
    a window aggregate over the earlier ones. The summary has one row per partition.
    """
    ends = rows.groupBy(*keys, CHUNK).agg(state.alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(*BEFORE)
    carried = ends.select(*keys, CHUNK, merge(F.col("_s")).over(earlier).alias("_carry"))
    return rows.join(carried, [*keys, CHUNK])


def failure_runs(events: DataFrame, at_least: int = C.FAILURE_RUN) -> DataFrame:
    """Runs of consecutive failures per worker: (worker, first_ts, last_ts, failures).

    ``events`` holds (worker, ts, event_id, ok); a success ends a run.
    """
    keys, order = ["worker"], ["ts", "event_id"]
    rows = chunked(events.select(*keys, *order, "ok"), keys, order)
    rows = with_carry(rows, keys, F.count_if("ok"), F.sum)
    here = Window.partitionBy(CHUNK, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = F.coalesce("_carry", F.lit(0)) + F.count_if("ok").over(here)
    return (
        rows.withColumn("island", island).where("not ok").groupBy("worker", "island")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("failures"))
        .where(F.col("failures") >= at_least).drop("island")
    )


def counter_increases(progress: DataFrame) -> DataFrame:
    """Rows (worker, ts, event_id, counter) whose counter is above everything before it."""
    keys, order = ["worker"], ["ts", "event_id"]
    rows = chunked(progress.select(*keys, *order, "counter"), keys, order)
    rows = with_carry(rows, keys, F.max("counter"), F.max)
    here = Window.partitionBy(CHUNK, *keys).orderBy(*order).rowsBetween(*BEFORE)
    before = F.greatest("_carry", F.max("counter").over(here), F.lit(0))
    grown = rows.withColumn("_before", before).where(F.col("counter") > F.col("_before"))
    return grown.drop("_before", "_carry")


def stall_gaps(progress: DataFrame, seconds: int = C.STALL_SECONDS, until: datetime | None = None) -> DataFrame:
    """Stretches of more than ``seconds`` in which a worker's counter did not grow: (worker, counter, stalled_from, stalled_to, closed).

    A worker begins at its first event with a counter of 0, so the wait before its first step counts as well. A stall that no
    step ends goes on to the worker's last event, or to ``until`` where that is given, with ``closed`` false.
    """
    keys, order = ["worker"], ["ts", "event_id"]
    ups = cut(counter_increases(progress))
    # the next increase: the first one of the later partitions, or the one after it here
    starts = ups.groupBy(*keys, CHUNK).agg(F.min("ts").alias("_s"))
    later = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(1, Window.unboundedFollowing)
    follow = starts.select(*keys, CHUNK, F.min("_s").over(later).alias("_next_start"))
    here = Window.partitionBy(CHUNK, *keys).orderBy(*order)
    stepped = ups.withColumn("_lead", F.lead("ts").over(here)).join(follow, [*keys, CHUNK])
    stepped = stepped.select(*keys, "counter", "ts", F.coalesce("_lead", "_next_start").alias("_next"))
    spans = progress.groupBy(*keys).agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    waits = spans.join(starts.groupBy(*keys).agg(F.min("_s").alias("_next")), keys, "left")
    waits = waits.select(*keys, F.lit(0).cast(ups.schema["counter"].dataType).alias("counter"), F.col("_first").alias("ts"), "_next")
    end = F.col("_last") if until is None else F.lit(until).cast(progress.schema["ts"].dataType)
    gaps = stepped.unionByName(waits).join(spans.drop("_first"), keys).select(
        *keys, "counter", F.col("ts").alias("stalled_from"), F.coalesce("_next", end).alias("stalled_to"), F.col("_next").isNotNull().alias("closed"),
    )
    longest = F.make_dt_interval(secs=F.lit(float(seconds)))
    return gaps.where(F.col("stalled_to") - F.col("stalled_from") > longest)
