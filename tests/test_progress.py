"""Batch metrics and progress over many batches."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from tidegate.config import Layout
from tidegate.operators.merge import MergeStats
from tidegate.storage import children
from tidegate.streaming import metrics, progress
from tidegate.streaming.runner import ONCE, Drain, run_for, run_stream, trigger_of


def stats(n: int) -> MergeStats:
    return MergeStats(n, 0, 0, n)


def all_rows(spark, folder):
    return sorted((r.target, r.batch_id, r.rows_in) for r in metrics.read(spark, folder).collect())


def test_metrics_roll_up(spark, folder):
    place = Layout(folder).metrics()
    want = []
    for batch in range(8):
        for target in ("a", "b"):
            metrics.record(spark, place, target, batch, stats(batch))
            want.append((target, batch, batch))
        metrics.roll_up(spark, place, "a", size=2)
    assert all_rows(spark, place) == sorted(want)
    assert len(children(spark, f"{place}/target=a")) <= 2
    assert len(children(spark, f"{place}/target=b")) == 8
    for level in (1, 2):  # two of a level become one of the next
        assert len(children(spark, f"{place}_rolled/target=a/level={level}")) < 2
    latest = metrics.latest(spark, place)
    assert len(latest.inputFiles()) == 2
    assert sorted((r.target, r.batch_id) for r in latest.collect()) == [("a", 7), ("b", 7)]


def test_metrics_rolled_twice_count_once(spark, folder):
    """The roll-up was written but the batches' own folders were not deleted; and a batch is replayed."""
    place = Layout(folder).metrics()
    for batch in range(5):
        metrics.record(spark, place, "a", batch, stats(batch))
    kept = metrics.delete_path
    metrics.delete_path = lambda *args: False
    try:
        metrics.roll_up(spark, place, "a", size=3)
    finally:
        metrics.delete_path = kept
    assert all_rows(spark, place) == [("a", b, b) for b in range(5)]
    metrics.record(spark, place, "a", 3, stats(33))
    assert all_rows(spark, place)[3] == ("a", 3, 33)


def test_no_metrics(spark, folder):
    assert metrics.read(spark, folder).count() == 0
    assert metrics.latest(spark, folder).count() == 0
    assert progress.read(spark, f"{folder}/none").count() == 0


def test_progress_is_one_file_per_query_and_day(spark, folder):
    kept = progress.ProgressLog()
    spark.streams.addListener(kept)
    try:
        for run in range(3):
            spark.range(run * 10, run * 10 + 7).write.mode("append").parquet(f"{folder}/in")
            for name in ("one", None):  # a query without a name is nobody's target
                stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
                query = run_stream(stream, lambda df, batch: df.count(), f"{folder}/checkpoint-{name}", ONCE, name=name)
                run_for(query)
                assert kept.wait(query.runId)
            assert kept.flush(spark, f"{folder}/progress") == 1
    finally:
        spark.streams.removeListener(kept)
    rows = progress.read(spark, f"{folder}/progress")
    assert sorted((r.query, r.batch_id, r.rows_in) for r in rows.collect()) == [("one", b, 7) for b in range(3)]
    days = children(spark, f"{folder}/progress/query=one")
    assert sum(len(children(spark, f"{folder}/progress/query=one/{d}")) for d in days) == len(days) <= 2
    total = progress.by_day(progress.read(spark, f"{folder}/progress", days=2)).agg(F.sum("batches"), F.sum("rows_in")).first()
    assert tuple(total) == (3, 21)


def test_progress_row_of_a_source_that_lags():
    row = progress._row({
        "name": "bus", "runId": "r", "batchId": 4, "timestamp": "2024-01-02T03:04:05.678Z", "numInputRows": 5,
        "processedRowsPerSecond": 2.5, "durationMs": {"triggerExecution": 9, "queryPlanning": 2, "latestOffset": 1, "getBatch": 3},
        "eventTime": {"watermark": "2024-01-02T00:00:00.000Z"},
        "sources": [{"endOffset": {"t": {"0": 7}}, "metrics": {"maxOffsetsBehindLatest": "12", "avgOffsetsBehindLatest": "6.0"}}],
    })
    assert (row.day, row.batch_ms, row.source_ms, row.behind, row.watermark) == ("2024-01-02", 9, 4, 12, "2024-01-02T00:00:00.000Z")
    assert progress._row({"name": None, "numInputRows": 5}) is None
    assert progress._row({"name": "bus", "numInputRows": 0}) is None


@pytest.mark.parametrize("seconds", [0.7, 1.6, 2.5])
def test_time_boxed_run_ends_between_batches(spark, folder, seconds):
    """Under load, with a batch always at work, each batch that began is finished and committed."""
    spark.range(0, 60, 1, 60).write.parquet(f"{folder}/in")
    began, ended = [], []

    def on_batch(df, batch_id):
        began.append(batch_id)
        time.sleep(0.4)
        df.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
        ended.append(batch_id)

    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run_for(run_stream(stream, on_batch, f"{folder}/checkpoint", trigger_of(0)), seconds)
    commits = sorted(int(c) for c in children(spark, f"{folder}/checkpoint/commits"))
    assert began == ended == commits
    # The next run takes up what is left; every record comes once.
    run_for(run_stream(stream, on_batch, f"{folder}/checkpoint", ONCE))
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").select("id").collect()) == list(range(60))


def test_drain_does_not_wait_for_ever(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    begun, go = threading.Event(), threading.Event()

    def on_batch(df, batch_id):
        begun.set()
        go.wait(20)

    drain = Drain()
    stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
    writer = stream.writeStream.foreachBatch(drain.guard(on_batch)).option("checkpointLocation", f"{folder}/checkpoint")
    query = writer.start()
    assert begun.wait(20)
    threading.Timer(1.5, go.set).start()
    assert not drain.stop(query, 0.5)
    assert not query.isActive
