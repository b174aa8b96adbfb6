"""Keyed state: late and shuffled events, batches run twice, unreadable lines; products and their manifests."""

import json
import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from deslinde.operators import ordered
from deslinde.session import scratch_path
from deslinde.sources import checked, publish
from deslinde.streaming import keyed, progress, stalls

EVENTS = "worker bigint, ts timestamp, event_id bigint, counter bigint"
START = datetime(2025, 7, 1)


def events(seed=4, n=400):
    rng = random.Random(seed)
    rows, counter = [], {}
    for k in range(n):
        worker = rng.randrange(6)
        if worker and rng.random() < 0.6:
            counter[worker] = counter.get(worker, 0) + 1
        rows.append((worker, START + timedelta(seconds=rng.randrange(4000)), k, counter.get(worker, 0)))
    return sorted(rows, key=lambda r: (r[1], r[2]))  # worker 0 never rises


def run_stream(spark, batches, late):
    """Each list of events as a file that arrives after the ones before."""
    stalls.with_rocksdb(spark)
    source, target, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    dropped = 0
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = stalls.watch_stalls(spark.readStream.schema(EVENTS).parquet(source), 60, late)
        query = stream.writeStream.format("parquet").option("checkpointLocation", mark).option("path", target).trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += stalls.late_rows(query)
    return {(r.worker, r.counter, r.stalled_from) for r in spark.read.schema(stream.schema).parquet(target).collect() if r.worker is not None}, dropped


def test_stalls_of_a_shuffled_stream_are_those_of_a_batch(spark):
    rows = events()
    rng = random.Random(1)
    last = max(r[1] for r in rows)
    mixed = rows[:]
    rng.shuffle(mixed)
    end = (None, last + timedelta(hours=2, milliseconds=1), -1, 0)
    got, dropped = run_stream(spark, [mixed[:150], mixed[150:], [end]], "2 hours")
    batch = ordered.stall_gaps(spark.createDataFrame(rows, EVENTS), 60, until=last).collect()
    assert got == {(r.worker, r.counter, r.stalled_from) for r in batch} and dropped == 0
    assert any(w == 0 and c == 0 for w, c, _ in got)


def test_rows_later_than_the_watermark_are_counted_and_change_nothing(spark):
    rows = events(seed=9)
    last = max(r[1] for r in rows)
    too_late = [(1, START, 10_000 + k, 999) for k in range(7)]
    got, dropped = run_stream(spark, [rows, [(None, last + timedelta(minutes=1, milliseconds=1), -1, 0)], too_late], "1 minute")
    batch = ordered.stall_gaps(spark.createDataFrame(rows, EVENTS), 60, until=last).collect()
    assert dropped == 7 and got == {(r.worker, r.counter, r.stalled_from) for r in batch}


def test_a_wait_that_the_closing_mark_makes_a_stall_is_none(spark, tmp_path):
    """Spans with parts of a second: waits of up to 60 s at the last event give no alarm, a microsecond more does."""
    from conformance.registry import QUERIES
    import __spark_entry__  # noqa: F401

    last = START + timedelta(seconds=500, microseconds=700_300)
    since = {1: timedelta(seconds=59.8), 2: timedelta(seconds=60), 3: timedelta(seconds=60, microseconds=1), 4: timedelta(0)}
    rows = [(2000 + w, last - back, w, "click") for w, back in since.items()] + [(1, START, 4, "click"), (2010, START, 5, "click")]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.worker, r.counter) for r in QUERIES["stream_stall_alarms"](spark, str(tmp_path)).collect()}
    assert got == {(3, 1), (4, 0), (5, 1)}


def lines(keys, attempt, good=True):
    body = '{"data":{"existePredio":1}}' if good else "{}"
    return [json.dumps({"comuna": c, "manzana": m, "predio": p, "attempt": attempt, "status": 200, "body": body}) for c, m, p in keys]


def test_a_batch_that_runs_twice_adds_nothing(spark):
    source, target, mark = (scratch_path(spark, n) for n in ("inbox", "answers", "mark"))
    keys = [(1 + k % 3, "00001", f"{k:05d}") for k in range(40)]

    def take(texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(source)
        keyed.ingest_keyed(spark, source, target, mark, shares=4).awaitTermination()

    take(lines(keys[:30], 1) + lines(keys[5:10], 0) + lines(keys[:3], 2, good=False) + ["no json", '{"comuna": 1}'])
    take(lines(keys, 3) + [""])
    # as after a loss between the write and the commit: the last batch has to run again
    local = mark.removeprefix("file:")
    done = sorted((f for f in os.listdir(f"{local}/commits") if f.isdigit()), key=int)
    os.remove(f"{local}/commits/{done[-1]}")
    crc = f"{local}/commits/.{done[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    keyed.ingest_keyed(spark, source, target, mark, shares=4).awaitTermination()
    got = sorted((r.comuna, r.manzana, r.predio, r.attempt) for r in keyed.kept(spark, target).collect())
    first = {k: 0 if 5 <= n < 10 else 1 if n < 30 else 3 for n, k in enumerate(keys)}
    assert got == sorted((*k, a) for k, a in first.items())
    assert sorted(r.reason for r in keyed.rejected(spark, target).collect()) == ["no key", "not json", "not json"]


class Calls:
    """A map state that counts what is asked of it."""

    def __init__(self):
        self.held, self.n = {}, 0

    def containsKey(self, at):
        self.n += 1
        return at in self.held

    def getValue(self, at):
        self.n += 1
        return self.held[at]

    def updateValue(self, at, value):
        self.n += 1
        self.held[at] = value


class Clock:
    at = 0

    def getCurrentProcessingTimeInMs(self):
        return self.at


def test_a_block_is_read_and_written_once(spark):
    """200 keys of two blocks, in chunks: six calls at most; each key passes once, and again after its own time."""
    keys = [(1, f"{m}", f"{p:05d}") for m in "ab" for p in range(100)]
    rows = pd.DataFrame([("kept", *k, attempt, 200, f"b{attempt}", None, 0) for k in keys for attempt in (2, 1)], columns=["kind", *keyed.KEY, "attempt", "status", "body", "reason", "share"])
    for ttl in (None, 1000):
        state, clock, first = Calls(), Clock(), keyed.FirstGood(ttl)
        first.init(type("Handle", (), {"getMapState": lambda *_: state})())
        take = lambda part: pd.concat([pd.DataFrame(columns=["attempt"]), *first.handleInputRows((0,), iter([part[:77], part[77:]]), clock)])
        assert list(take(rows[:300]).attempt) == [1] * 150 and state.n <= 6
        clock.at = 600
        state.n = 0
        assert len(take(rows)) == 50 and state.n <= 6
        clock.at = 1100
        assert len(take(rows)) == (150 if ttl else 0)


def test_lines_are_read_once_a_batch(spark):
    """Kept and rejected lines come out of one scan."""
    path = scratch_path(spark, "inbox")
    spark.createDataFrame([("x",), *[(t,) for t in lines([(1, "a", "b")], 1)]], "value string").coalesce(1).write.text(path)
    rows = keyed.answer_rows(spark.read.text(path), 4)
    assert {r.kind: r.reason for r in rows.collect()} == {"kept": None, "rejected": "not json"}
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_one_scan_gives_rows_rejects_and_counts(spark):
    path = scratch_path(spark, "lines")
    text = ["1,-33.5,-70.6", "2,-33.5", "3,-33.5,-70.6,x", "4,95,-70.6", '5,"-33,5",-70.6', ""]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    rows = checked.read_csv_checked(spark, path, ["id", "lat", "lon"], header=False)
    split = checked.split_checked(rows, scratch_path(spark, "split"))
    assert {r.id: r._lat for r in split.good.collect()} == {"1": -33.5, "4": None, "5": None}
    assert {r._line: r._reason for r in split.rejected.collect()} == {"2,-33.5": "too few fields", "3,-33.5,-70.6,x": "too many fields"}
    assert split.counts["good"] == 3 and split.counts["too few fields"] == 1 and split.counts["too many fields"] == 1
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_failed_run_leaves_the_product_before(spark):
    folder = scratch_path(spark, "published")
    order = {"rows": ["comuna", "n"]}
    rows = lambda k: spark.range(300).select((F.col("id") % 3).cast("int").alias("comuna"), F.col("id").alias("n"), F.lit(k).alias("run"))
    with pytest.raises(ValueError):
        publish.read_published(spark, folder, "rows")
    first = publish.publish(spark, {"rows": rows(1)}, folder, order)
    with pytest.raises(Exception, match="lost"):
        publish.publish(spark, {"rows": rows(2).withColumn("n", F.expr("if(n = 250, raise_error('lost'), n)"))}, folder, order)
    assert [r.run for r in publish.read_published(spark, folder, "rows").select("run").distinct().collect()] == [1]
    for k in (3, 4):
        last = publish.publish(spark, {"rows": rows(k)}, folder, order)
    files = publish.manifest(spark, folder).collect()
    assert {f.output for f in files} == {"rows"} and len(files) == 3 and all(last in f.path and f.length > 0 for f in files)
    assert first in publish.retire(spark, folder, keep=1)
    assert publish.read_published(spark, folder, "rows").select("run").first().run == 4
    assert publish.retire(spark, folder, keep=1) == []


@pytest.mark.parametrize("name", ["stream_ingest", "stream_ingest_keyed"])
def test_the_inbox_is_small_beside_its_lines(spark, sf, tmp_path, monkeypatch, name):
    """Lines wait in compressed files, and none is lost."""
    from conformance.queries import streams

    monkeypatch.setattr(streams, "scratch_path", lambda spark, part: f"{tmp_path}/{part}")
    assert getattr(streams, name)(spark, sf).count() > 0
    lines = spark.read.text(f"{tmp_path}/inbox").selectExpr("sum(octet_length(value)) as bytes").first().bytes
    files = sum(p.stat().st_size for p in (tmp_path / "inbox").glob("part-*"))
    assert 0 < files < lines / 4
