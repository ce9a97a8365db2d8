"""Sketches of deliveries: merged on reading, within their errors, each batch once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators.bronze import to_bronze
from tidegate.sources.replay import bus_stream
from tidegate.storage import children
from tidegate.streaming import summaries
from tidegate.streaming.ingest import start_bronze
from tidegate.streaming.runner import ONCE, run_for

SF = "/root/testdata/sf0.001"
LOADED = "2024-09-01 00:00:00"
RANKS = (0.1, 0.5, 0.9, 0.99)


def delay():
    return F.unix_micros("enqueuedTime") - F.unix_micros("deviceEnqueuedTime")


@pytest.fixture(scope="module")
def received(spark):
    df = to_bronze(fx.line_raw(spark, SF), LOADED)
    spread = (F.pmod(F.xxhash64("body"), F.lit(1_000_003)) * 1000 + F.unix_micros("deviceEnqueuedTime")).cast("long")
    df = df.withColumn("enqueuedTime", F.timestamp_micros(spread)).cache()
    yield df
    df.unpersist()


def parts(df, n):
    return [df.where(F.pmod(F.xxhash64("body"), F.lit(n)) == k) for k in range(n)]


def shown(spark, folder):
    return {r.templateName: (r.deliveries, r.devices, r.delays) for r in summaries.read(spark, folder, RANKS).collect()}


def alike(found, before) -> bool:
    """The same deliveries; estimates of devices depend a little on the order of merging."""
    close = all(abs(found[k][1] - before[k][1]) <= 0.02 * before[k][1] for k in before)
    return close and {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in before.items()}


def test_within_the_stated_errors(spark, received, folder):
    for k, part in enumerate(parts(received, 5)):
        summaries.record(part, folder, k)
    found = shown(spark, folder)
    exact = received.groupBy("templateName").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("deviceId").alias("d"))
    rows = exact.collect()
    assert len(rows) == 3 and found.keys() == {r.templateName for r in rows}
    for r in rows:
        n, devices, delays = found[r.templateName]
        assert n == r.n and abs(devices - r.d) <= 0.05 * r.d
        own = sorted(x.t for x in received.where(F.col("templateName") == r.templateName).select(delay().alias("t")).collect())
        for rank, value in zip(RANKS, delays):
            below, upto = (sum(t < value for t in own) / n, sum(t <= value for t in own) / n)
            assert below - 0.01 <= rank <= upto + 0.01


def test_reading_does_not_scan_messages(spark, received, folder):
    for k, part in enumerate(parts(received, 3)):
        summaries.record(part, folder, k)
    files = summaries.read(spark, folder).inputFiles()
    assert len(files) == 3 and all("batch_id=" in f for f in files)


def test_a_repeated_batch_replaces_its_own(spark, received, folder):
    first, second = parts(received, 2)
    summaries.record(first, folder, 0)
    summaries.record(second, folder, 1)
    before = shown(spark, folder)
    summaries.record(second, folder, 1)
    assert {k: v[:2] for k, v in shown(spark, folder).items()} == {k: v[:2] for k, v in before.items()}


@pytest.mark.parametrize("cut", [False, True])
def test_roll_up(spark, received, folder, monkeypatch, cut):
    for k, part in enumerate(parts(received, 6)):
        summaries.record(part, folder, k)
        if k == 3:
            summaries.roll_up(spark, folder)
    before = shown(spark, folder)
    if cut:  # the merged file is there, what it replaces too
        with monkeypatch.context() as m:
            m.setattr(summaries, "delete_path", lambda *_: None)
            assert summaries.roll_up(spark, folder) == 2
        assert alike(shown(spark, folder), before)
        assert summaries.roll_up(spark, folder) == 0
    else:
        assert summaries.roll_up(spark, folder) == 2
        assert sorted(children(spark, folder)) == ["batch_id=5", "upto=4"]
    assert alike(shown(spark, folder), before)
    summaries.record(parts(received, 6)[0], folder, 6)
    assert sum(v[0] for v in shown(spark, folder).values()) > sum(v[0] for v in before.values())


def test_a_file_that_was_not_completed_is_not_read(spark, received, folder):
    summaries.record(received, folder, 0)
    before = shown(spark, folder)
    summaries.summarize(received).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/upto=0")
    assert shown(spark, folder) == before


def test_nulls_and_nothing(spark, received, folder):
    assert shown(spark, folder) == {}
    empty = received.where("false")
    summaries.record(empty, folder, 0)
    assert shown(spark, folder) == {}
    blank = received.limit(4).withColumns({c: F.lit(None).cast(received.schema[c].dataType) for c in ("templateName", "deviceId", "enqueuedTime")})
    summaries.record(blank, folder, 1)
    assert shown(spark, folder) == {None: (4, 0, None)}


def test_stream(spark, folder):
    layout = Layout(folder)
    raw = fx.event_raw(spark, SF)
    for k, part in enumerate(parts(raw.where("body is not null"), 2)):
        part.write.mode("append").parquet(f"{folder}/raw")
        stream = bus_stream(spark, f"{folder}/raw")
        run_for(start_bronze(stream, layout, trigger=ONCE, load_time=LOADED, summarize=True))
    exact = to_bronze(raw, LOADED).where("body is not null").groupBy("templateName").count().collect()
    found = {r.templateName: r.deliveries for r in summaries.read(spark, layout.summaries("bronze")).collect()}
    assert found == {r.templateName: r["count"] for r in exact}
