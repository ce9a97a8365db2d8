from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import fixtures as fx
from tidegate import jobs, schemas
from tidegate.config import Layout, RunConfig
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import BRONZE_MERGE, SILVER_MERGE, merge_insert
from tidegate.operators.quarantine import quarantine
from tidegate.operators.silver import to_silver
from tidegate.plans.rebuild import bronze_of, rebuild_silver
from tidegate.sources.replay import (
    between_positions,
    bus_batch,
    bus_stream,
    first_start,
    instant,
    kafka_options,
    look_back,
)
from tidegate.sources.templates import template
from tidegate.storage import write_batch_folder
from tidegate.streaming import metrics
from tidegate.streaming.ingest import (
    bronze_sink,
    bronze_target,
    silver_sink,
    silver_target,
    start_bronze,
    start_silver,
    start_silver_single,
)
from tidegate.streaming.runner import ONCE, run_for, run_stream, timeout_seconds, trigger_of

SF = "/root/testdata/sf0.001"
LOADED = "2024-09-01 00:00:00"


def rows(df, *drop) -> Counter:
    names = sorted(set(df.columns) - set(drop))
    return Counter(map(tuple, df.select(*names).collect()))


@pytest.fixture(scope="module")
def raw(spark):
    df = fx.event_raw(spark, SF).cache()
    yield df
    df.unpersist()


def write_files(raw, folder: str, files: int) -> str:
    place = f"{folder}/raw"
    raw.repartition(files).write.mode("append").parquet(place)
    return place


def test_trigger():
    assert trigger_of("") == trigger_of("0") == trigger_of(0) == trigger_of(None) == {"processingTime": "0 seconds"}
    assert trigger_of("5") == trigger_of(5) == {"processingTime": "5 minutes"}
    assert trigger_of(0.5) == {"processingTime": "30 seconds"}
    with pytest.raises(ValueError):
        trigger_of(-1)


def test_timeout():
    assert timeout_seconds(15) == timeout_seconds("15") == 900
    assert timeout_seconds(0) is timeout_seconds("0") is timeout_seconds("soon") is timeout_seconds(None) is None
    with pytest.raises(ValueError):
        timeout_seconds(-1)


def test_positions(spark):
    now = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    assert look_back(60, now) == dt.datetime(2024, 1, 1, 23, tzinfo=dt.timezone.utc)
    assert look_back(0).tzinfo is dt.timezone.utc
    at = [instant(now), instant(now.replace(tzinfo=None)), instant("2024-01-02T00:00:00Z")]
    assert len(set(spark.range(1).select(*[a.cast("string") for a in at]).first())) == 1
    df = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2024-01-04', interval 1 day)) enqueuedTime")
    assert between_positions(df, now, "2024-01-03T00:00:00Z").count() == 2
    options = kafka_options("h:9092", "t", now, now + dt.timedelta(seconds=1))
    assert options["startingTimestamp"] == "1704153600000"
    assert options["endingTimestamp"] == "1704153601000"
    assert kafka_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t"}


def test_first_start_is_kept(spark, folder):
    before = look_back(60)
    start = first_start(spark, f"{folder}/start", 60)
    assert before <= dt.datetime.fromisoformat(start) <= look_back(60)
    assert first_start(spark, f"{folder}/start", 1) == start
    row = spark.range(1).select(instant(start).alias("t")).first()
    assert row.t.timestamp() == dt.datetime.fromisoformat(start).timestamp()


@pytest.mark.parametrize("files", [1, 3, 10])
def test_stream_equals_batch(spark, folder, raw, files):
    layout = Layout(folder)
    stream = bus_stream(spark, write_files(raw, folder, files), max_files=1)
    run_for(start_bronze(stream, layout, trigger=ONCE))
    got = bronze_target(layout).read(spark)
    # Which copy came first depends on the split, so the enqueued time may differ.
    assert rows(got, "loadDatetime", "enqueuedTime") == rows(bronze_of(raw), "loadDatetime", "enqueuedTime")
    assert metrics.read(spark, layout.metrics()).count() == files
    bodiless = spark.read.parquet(f"{layout.quarantine('bronze')}/*")
    assert bodiless.count() == raw.where("body is null").count()


def test_every_message_is_in_one_place(spark, folder, raw):
    """Distinct messages = silver rows + rejects, for each way to fan out."""
    layout = Layout(folder)
    templates = fx.event_templates()
    del templates["purchase"]
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    bronze = bronze_target(layout).read(spark)
    rejected = spark.read.parquet(f"{layout.quarantine('silver')}/*")
    assert rows(rejected.select("rowhash")) == rows(quarantine(bronze, templates).select("rowhash"))
    places = Counter(r.rowhash for r in rejected.select("rowhash").collect())
    for t in templates.values():
        silver = silver_target(layout, t).read(spark)
        assert rows(silver) == rows(to_silver(bronze, t))
        places.update(r.rowhash for r in silver.select("rowhash").collect())
    assert places == Counter(r.rowhash for r in bronze.select("rowhash").collect())

    apart = Layout(folder + "/apart")
    for t in templates.values():
        rebuild_silver(spark, layout, t, into=apart)
        assert rows(silver_target(apart, t).read(spark)) == rows(silver_target(layout, t).read(spark))


def test_restart_after_a_crash_inside_a_batch(spark, folder, raw):
    """The sink fails after it wrote; the same checkpoint then repeats the batch."""
    layout = Layout(folder)
    place = write_files(raw, folder, 3)
    sink, calls = bronze_sink(layout), []

    def crash_in_second(batch, batch_id):
        sink(batch, batch_id)
        calls.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    stream = to_bronze(bus_stream(spark, place, max_files=1), LOADED)
    query = run_stream(stream, crash_in_second, layout.checkpoint("bronze"), ONCE)
    with pytest.raises(Exception, match="executor lost"):
        run_for(query)
    assert calls == [0, 1]
    run_for(run_stream(stream, sink, layout.checkpoint("bronze"), ONCE))
    got = bronze_target(layout).read(spark)
    assert rows(got, "enqueuedTime") == rows(bronze_of(raw, LOADED), "enqueuedTime")
    repeated = metrics.read(spark, layout.metrics()).where("batch_id = 1").first()
    assert repeated.inserted == 0 and repeated.matched_keys > 0


def test_single_stream_stopped_inside_a_batch(spark, folder, raw):
    """Stopping waits for the batch at work, so a restart never meets a second writer."""
    layout, templates = Layout(folder), fx.event_templates()
    for part in raw.randomSplit([1.0, 1.0, 1.0], seed=5):
        merge_insert(to_bronze(part, LOADED), bronze_target(layout))
    started = start_silver_single(spark, layout, templates, trigger=trigger_of(0), max_files=3)
    ran = run_for(started, 1.5)
    assert ran < 60 and not started.isActive
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE, max_files=3))
    bronze = bronze_target(layout).read(spark)
    for t in templates.values():
        assert rows(silver_target(layout, t).read(spark)) == rows(to_silver(bronze, t))


def test_silver_is_strict_over_compat_bronze(spark, folder, raw):
    """Copies that compat bronze holds do not reach silver, for each way to fan out."""
    layout, templates = Layout(folder), fx.event_templates()
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout), BRONZE_MERGE.with_mode("compat"))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    apart = Layout(folder + "/apart")
    for t in templates.values():
        rebuild_silver(spark, layout, t, into=apart)
        want = rows(to_silver(bronze_of(raw, LOADED), t))
        assert rows(silver_target(layout, t).read(spark)) == want
        assert rows(silver_target(apart, t).read(spark)) == want


def test_lost_commit_is_repeated_without_effect(spark, folder, raw):
    layout = Layout(folder)
    place = write_files(raw, folder, 2)
    run_for(start_bronze(bus_stream(spark, place, max_files=1), layout, trigger=ONCE, load_time=LOADED))
    before = rows(bronze_target(layout).read(spark))
    commits = Path(layout.checkpoint("bronze")) / "commits"
    for file in [commits / "1", commits / ".1.crc"]:
        if file.exists():
            file.rename(f"{folder}/{file.name}-lost")
    run_for(start_bronze(bus_stream(spark, place, max_files=1), layout, trigger=ONCE, load_time=LOADED))
    assert rows(bronze_target(layout).read(spark)) == before


def test_compat_stream_inserts_bodiless_rows(spark, folder, raw):
    layout = Layout(folder)
    stream = bus_stream(spark, write_files(raw, folder, 1))
    run_for(start_bronze(stream, layout, "compat", ONCE))
    assert bronze_target(layout).read(spark).count() == raw.count()
    assert not Path(layout.quarantine("bronze")).exists()


def test_further_bus_columns(spark, folder, raw):
    """Copies that differ in them are still copies; the first one's are kept."""
    schema = T.StructType(
        [*schemas.RAW, T.StructField("offset", T.LongType()), T.StructField("properties", T.MapType(T.StringType(), T.StringType()))]
    )
    numbered = raw.withColumn("offset", F.monotonically_increasing_id()).withColumn(
        "properties", F.create_map(F.lit("sent"), F.col("enqueuedTime").cast("string"))
    )
    place = write_files(numbered, folder, 2)
    layout = Layout(folder)
    for _ in range(2):
        run_for(start_bronze(bus_stream(spark, place, schema=schema, max_files=1, max_bytes=10**9), layout, trigger=ONCE))
    fields = [f for f in schema if f.name in ("offset", "properties")]
    got = bronze_target(layout, fields).read(spark)
    assert got.count() == got.select("rowhash").distinct().count() == bronze_of(raw).count()
    assert got.where("properties['sent'] <> cast(enqueuedTime as string) or offset is null").count() == 0
    assert bronze_target(layout).read(spark).columns == bronze_of(raw).select(*schemas.BRONZE.names).columns


def test_run_stream_checks(spark, folder, raw):
    with pytest.raises(ValueError, match="streaming"):
        run_stream(raw, print, f"{folder}/c")
    stream = bus_stream(spark, write_files(raw, folder, 1))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_stream(stream, print, f"{folder}/c")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_failing_template_does_not_stop_the_others(spark, folder, raw):
    """Its target holds a column of another type, so only its own query fails."""
    database = "fan_out_" + Path(folder).name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    layout = Layout(folder, silver_table=f"{database}.silver")
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout))
    rebuild_silver(spark, layout, template("view", {"k": "double", "value": "double"}))
    templates = {a: fx.event_templates()[a] for a in ("view", "click")}
    with pytest.raises(RuntimeError, match="1 of the silver streams failed: view"):
        start_silver(spark, layout, templates, trigger=ONCE).wait()
    bronze = bronze_target(layout).read(spark)
    click = templates["click"]
    assert rows(silver_target(layout, click).read(spark)) == rows(to_silver(bronze, click))
    with pytest.raises(ValueError, match="both map"):
        start_silver(spark, layout, {"a b": click, "a_B": click})
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_fan_out_without_bronze_reports_every_asset(spark, folder):
    started = start_silver(spark, Layout(folder), fx.line_templates(), trigger=ONCE)
    assert set(started.errors) == set(fx.LINE_ASSETS)
    with pytest.raises(RuntimeError, match="3 of the silver streams"):
        started.wait()


@pytest.mark.parametrize("as_table", [False, True])
def test_template_that_grows(spark, folder, raw, as_table):
    database = "grows_" + Path(folder).name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    layout = Layout(folder, silver_table=f"{database}.silver" if as_table else None)
    late = between_positions(raw, start="2024-01-16")
    merge_insert(to_bronze(between_positions(raw, end="2024-01-16"), LOADED), bronze_target(layout))
    small = template("view", {"value": "double"})
    start_silver(spark, layout, {"view": small}, trigger=ONCE).wait()
    before = silver_target(layout, small).read(spark).count()
    merge_insert(to_bronze(late, LOADED), bronze_target(layout))
    grown = template("view", {"value": "double", "k": "integer"})
    start_silver(spark, layout, {"view": grown}, trigger=ONCE).wait()
    got = silver_target(layout, grown).read(spark)
    assert got.where("k is null").count() >= before > 0
    assert got.where("k is not null").count() > 0
    assert got.count() == to_silver(bronze_target(layout).read(spark), grown).count()
    if as_table:  # a field that is gone from the template stays, as null
        merge_insert(
            to_silver(to_bronze(late, LOADED).withColumn("rowhash", F.concat("rowhash", F.lit("x"))), small),
            silver_target(layout, small),
            SILVER_MERGE,
        )
        assert "k" in spark.table(f"{database}.silver_view").columns
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_batch_folder_is_replaced(spark, folder):
    write_batch_folder(spark.range(3).toDF("x"), folder, 7)
    write_batch_folder(spark.range(2).toDF("x"), folder, 7)
    assert spark.read.parquet(f"{folder}/*").count() == 2


def test_jobs(spark, folder, raw):
    """Both jobs and the reset, as called from the command line."""
    now = dt.datetime.now(dt.timezone.utc)
    recent = raw.withColumn("enqueuedTime", F.lit(now))
    old = raw.limit(5).withColumn("enqueuedTime", F.lit(now - dt.timedelta(hours=3)))
    write_files(recent.unionAll(old.withColumn("body", F.lit("old"))), folder, 1)
    Path(folder, "view.json").write_text(
        json.dumps([{"contents": [{"name": "value", "schema": "double"}, {"name": "k", "schema": "integer"}]}])
    )
    Path(folder, "assets.json").write_text(json.dumps({"view": "view.json", "bad": "nowhere.json"}))
    root = f"{folder}/lake"
    run = ["--root", root, "--minutes", "0.1", "--trigger", "0"]
    jobs.main(["bronze", "--source", f"{folder}/raw", "--lookback", "60", *run])
    messages = bronze_of(raw).count()
    bronze = bus_batch(spark, f"{root}/bronze")
    assert bronze.where("body = 'old'").count() == 0
    assert bronze.count() == messages
    silver = ["silver", "--templates", f"{folder}/assets.json", "--template-folder", folder, *run]
    with pytest.raises(ValueError, match="template bad: missing contents"):
        jobs.main(silver)
    layout = Layout(root)
    view = fx.event_templates()["view"]
    want = to_silver(bronze_target(layout).read(spark), view)
    assert rows(silver_target(layout, view).read(spark)) == rows(want)
    # A record enqueued after the first start is read however late the next run is.
    later = raw.limit(1).withColumn("body", F.lit('{"deviceId":"9-later"}')).withColumn("enqueuedTime", F.lit(now))
    write_files(later, folder, 1)
    jobs.main(["bronze", "--source", f"{folder}/raw", "--lookback", "0", *run])
    assert bus_batch(spark, f"{root}/bronze").count() == messages + 1
    listed = jobs.main(["reset", "--root", root, "--layer", "silver"])
    assert listed.dry_run and Path(root, "silver").exists()
    done = jobs.main(["reset", "--root", root, "--layer", "silver", "--yes"])
    assert done.paths == listed.paths and not Path(root, "silver").exists()
    assert Path(root, "bronze").exists()


def test_run_config():
    with pytest.raises(ValueError):
        RunConfig(Layout("/x"), job_minutes=-1)
    with pytest.raises(ValueError):
        RunConfig(Layout("/x"), mode="x")


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_single_stream_keeps_no_bodies(spark, folder, raw, mode, monkeypatch):
    """A kept batch would be a second copy of bronze on the executors' disks: it is read again instead."""
    kept, keep = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df.columns) or keep(df, *a))
    layout, templates = Layout(folder), fx.event_templates()
    bronze = to_bronze(raw, LOADED)
    doubled = bronze.unionByName(bronze.where("templateName = 'view'").limit(5))
    silver_sink(layout, templates, mode)(doubled, 0)
    silver_sink(layout, templates, mode)(bronze, 1)
    assert not [c for c in kept if "body" in c]
    rejected = quarantine(doubled, templates).count()
    found = {r.target: (r.rows_in, r.quarantined) for r in metrics.read(spark, layout.metrics()).where("batch_id = 0").collect()}
    assert found["quarantine"] == (doubled.count(), rejected)
    silver = silver_target(layout, templates["view"]).read(spark)
    want = to_silver(bronze if mode == "strict" else doubled, templates["view"])
    want = want.dropDuplicates(["rowhash"]) if mode == "strict" else want
    assert silver.count() == want.count()
