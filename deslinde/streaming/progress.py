"""Progress of running workers: stalls and rates over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde import constants as C

# How late an event may come; a window is closed by events that much younger than its end.
LATE = "10 minutes"


def _timed(events: DataFrame, late: str) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def busy_sessions(events: DataFrame, seconds: int = C.STALL_SECONDS, late: str = LATE) -> DataFrame:
    """Stretches in which a worker's counter kept growing; each ends with a stall of ``seconds``.

    ``events`` holds (worker, ts, ok); an event that is not ok does not move the counter.
    """
    gap = F.session_window("ts", f"{seconds} seconds")
    out = _timed(events.where("ok"), late).groupBy("worker", gap.alias("s")).agg(F.count("*").alias("steps"))
    return out.select(
        "worker", F.col("s.start").alias("busy_from"),
        (F.col("s.end") - F.expr(f"interval {seconds} seconds")).alias("stalled_from"), "steps",
    )


def rates(events: DataFrame, every: str = "1 hour", late: str = LATE) -> DataFrame:
    """Good and failed steps per window of event time, with the rate per second."""
    w = F.window("ts", every)
    out = _timed(events, late).groupBy(w.alias("w")).agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail")
    )
    length = F.unix_seconds("w.end") - F.unix_seconds("w.start")
    return out.select(F.col("w.start").alias("from_ts"), "ok", "fail", F.round(F.col("ok") / length, 6).alias("rate"))


def run_to_table(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there, append its closed results to ``path`` and read them."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def finished_rates(events: DataFrame, closed: DataFrame, every: str = "1 hour") -> DataFrame:
    """The closed windows and, of a stream that has ended, those no later event has closed.

    Windows close in order of time, so the open ones begin after the last closed one; only their
    events are read again.
    """
    last = closed.agg(F.max("from_ts").alias("t")).first()["t"]
    w = F.window(F.col("ts").cast("timestamp"), every)
    rest = events.withColumn("w", w)
    rest = rest if last is None else rest.where(F.col("w.start") > F.lit(last))
    length = F.unix_seconds("w.end") - F.unix_seconds("w.start")
    open_ones = rest.groupBy("w").agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail")).select(
        F.col("w.start").alias("from_ts"), "ok", "fail", F.round(F.col("ok") / length, 6).alias("rate")
    )
    return closed.unionByName(open_ones)


def finished_sessions(events: DataFrame, closed: DataFrame, seconds: int = C.STALL_SECONDS) -> DataFrame:
    """The closed stretches and, of a stream that has ended, each worker's steps after its last closed one."""
    last = closed.groupBy("worker").agg(F.max("stalled_from").alias("_last"))
    rest = events.where("ok").withColumn("ts", F.col("ts").cast("timestamp")).join(last, "worker", "left")
    gap = F.session_window("ts", f"{seconds} seconds")
    open_ones = rest.where("_last is null or ts > _last").groupBy("worker", gap.alias("s")).agg(F.count("*").alias("steps"))
    return closed.unionByName(open_ones.select(
        "worker", F.col("s.start").alias("busy_from"),
        (F.col("s.end") - F.expr(f"interval {seconds} seconds")).alias("stalled_from"), "steps",
    ))
