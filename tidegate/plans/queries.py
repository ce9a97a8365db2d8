"""Registered queries: each operator over the whole of the given tables.

Times are shown as text, so that engines with other time types compare equal.
The load time is fixed or left out, as it differs between runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import fixtures as fx
from tidegate import schemas
from tidegate.config import Layout
from tidegate.functions import local_time, row_hash, station_id, utc_date, utc_time
from tidegate.maintenance import list_tables, reset_layer
from tidegate.operators import reports
from tidegate.operators.bronze import to_bronze
from tidegate.operators.compact import compact, files
from tidegate.operators.merge import BRONZE_MERGE, MergeSpec, merge_insert
from tidegate.operators.quarantine import quarantine
from tidegate.operators.silver import of_template, parse_envelope, silver_of_all, to_silver
from tidegate.plans.rebuild import bronze_of, rebuild_silver
from tidegate.sources.replay import between_positions, bronze_stream, bus_batch, bus_stream
from tidegate.sources.templates import Template, compile_templates, template_fields
from tidegate.storage import Target, children, scratch_folder
from tidegate.streaming import metrics, progress, rejects, summaries
from tidegate.streaming.ingest import (
    append_sink,
    bronze_target,
    silver_target,
    start_bronze,
    start_silver,
    start_silver_single,
)
from tidegate.streaming.runner import ONCE, run_for, run_stream, timeout_seconds, trigger_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOADED = "2024-09-01 00:00:00"
MID_MONTH = "2024-01-16 00:00:00"
START = "2024-01-10 00:00:00"
END = "2024-01-20 12:00:00"

# One template is left out on purpose, so that orphans occur.
KNOWN_ASSETS = ("click", "error", "signup", "view")


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = in_utc
        return in_utc

    return register


def text_of(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def show(df: DataFrame, drop: Iterable[str] = ()) -> DataFrame:
    """Times and dates as text, without the columns in ``drop``."""
    columns = []
    for f in df.schema:
        if f.name in drop:
            continue
        kind = f.dataType.typeName()
        if kind == "timestamp":
            columns.append(text_of(F.col(f.name)).alias(f.name))
        elif kind == "date":
            columns.append(F.col(f.name).cast("string").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_of(fx.event_raw(spark, sf_dir), LOADED)


def new_layout(spark: SparkSession, label: str) -> Layout:
    return Layout(scratch_folder(spark, label))


def deliver(spark: SparkSession, layout: Layout, raw: DataFrame, mode: str = "strict") -> None:
    """Put bus records in the replay folder and let the bronze stream catch up."""
    raw.write.mode("append").parquet(f"{layout.root}/raw")
    stream = bus_stream(spark, f"{layout.root}/raw")
    run_for(start_bronze(stream, layout, mode, ONCE, LOADED))


def two_deliveries(spark: SparkSession, sf_dir: str, layout: Layout, mode: str = "strict") -> None:
    """The first half of the month, then everything (so the first half once more)."""
    raw = fx.event_raw(spark, sf_dir)
    deliver(spark, layout, between_positions(raw, end=MID_MONTH), mode)
    deliver(spark, layout, raw, mode)


def copies_by_hash(df: DataFrame) -> DataFrame:
    return df.groupBy("rowhash").agg(F.count(F.lit(1)).alias("copies"))


def read_silver(spark: SparkSession, layout: Layout, templates: Iterable[Template]) -> DataFrame:
    """Columns common to all silver datasets, of all templates together."""
    common = [f.name for f in (*schemas.SILVER_HEAD, *schemas.SILVER_TAIL)]
    parts = [silver_target(layout, t).read(spark).select(*common) for t in templates]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


# -- sources ---------------------------------------------------------------------


@query("s1_source_replay")
def s1_source_replay(spark, sf_dir):
    layout = new_layout(spark, "s1")
    fx.event_raw(spark, sf_dir).write.parquet(f"{layout.root}/raw")
    stream = bus_stream(spark, f"{layout.root}/raw", max_files=1)
    run_for(run_stream(stream, append_sink(f"{layout.root}/kept"), layout.checkpoint("kept"), ONCE))
    return show(bus_batch(spark, f"{layout.root}/kept/*"))


@query("s2_start_position")
def s2_start_position(spark, sf_dir):
    layout = new_layout(spark, "s2")
    fx.event_raw(spark, sf_dir).write.parquet(f"{layout.root}/raw")
    stream = bus_stream(spark, f"{layout.root}/raw", start=START)
    run_for(run_stream(stream, append_sink(f"{layout.root}/kept"), layout.checkpoint("kept"), ONCE))
    return show(bus_batch(spark, f"{layout.root}/kept/*"))


@query("s3_end_position")
def s3_end_position(spark, sf_dir):
    return show(between_positions(fx.event_raw(spark, sf_dir), start=START, end=END))


@query("s3_end_position_stream")
def s3_end_position_stream(spark, sf_dir):
    """A stream that ends at a position: what lies behind it is read past, also when a later run finds it."""
    layout = new_layout(spark, "s3")
    raw = fx.event_raw(spark, sf_dir)
    for part in (raw.where(F.col("enqueuedTime") < MID_MONTH), raw.where(F.col("enqueuedTime") >= MID_MONTH)):
        part.write.mode("append").parquet(f"{layout.root}/raw")
        stream = bus_stream(spark, f"{layout.root}/raw", start=START, end=END)
        run_for(run_stream(stream, append_sink(f"{layout.root}/kept"), layout.checkpoint("kept"), ONCE))
    return show(bus_batch(spark, f"{layout.root}/kept/*"))


@query("k4_compaction")
def k4_compaction(spark, sf_dir):
    """Bronze of eight batches, packed: its rows, and the files of each month, which one bin holds here."""
    layout = new_layout(spark, "k4")
    target = bronze_target(layout)
    bronze = to_bronze(fx.event_raw(spark, sf_dir), LOADED)
    for k in range(8):
        merge_insert(bronze.where(F.pmod(F.xxhash64("body"), F.lit(8)) == k), target)
    compact(spark, target)
    slot = target.partition_by
    counted = files(spark, target).groupBy(*slot).agg(F.count(F.lit(1)).alias("files"))
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in slot]
    both = target.read(spark).alias("x").join(F.broadcast(counted).alias("y"), same)  # one row per month
    return both.select(*[F.col(f"x.{c}").alias(c) for c in slot], "x.rowhash", "x.templateName", "y.files")


@query("s4_bronze_as_stream")
def s4_bronze_as_stream(spark, sf_dir):
    layout = new_layout(spark, "s4")
    merge_insert(to_bronze(fx.event_raw(spark, sf_dir), LOADED), bronze_target(layout))
    stream = bronze_stream(spark, bronze_target(layout))
    run_for(run_stream(stream, append_sink(f"{layout.root}/kept"), layout.checkpoint("kept"), ONCE))
    kept = spark.read.schema(schemas.BRONZE).parquet(f"{layout.root}/kept/*")
    return show(kept, drop=["loadDatetime"])


def _template_files(spark: SparkSession, sf_dir: str, label: str) -> dict[str, str]:
    """Template files written from the telemetry seen per event type, then compiled.

    Each file first lists every field as float and then, in a second object, with
    its real type, which has to win.  The properties as a whole are text, a type
    telemetry cannot have.
    """
    root = scratch_folder(spark, label)
    events = fx.table(spark, sf_dir, "events")
    names = F.array_append(F.json_object_keys("props"), "value")
    kinds = F.create_map(F.lit("value"), F.lit("double"), F.lit("props"), F.lit("string"))
    seen = (
        events.select("event_type", F.explode(F.array_append(names, "props")).alias("name"))
        .distinct()
        .withColumn("schema", F.coalesce(kinds[F.col("name")], F.lit("integer")))
    )
    field = F.struct("name", "schema")
    as_float = F.struct("name", F.lit("float").alias("schema"))
    objects = F.array(
        F.struct(F.sort_array(F.collect_list(as_float)).alias("contents")),
        F.struct(F.sort_array(F.collect_list(field)).alias("contents")),
    )
    files = seen.groupBy("event_type").agg(F.to_json(objects).alias("value"))
    files.write.partitionBy("event_type").text(root)
    places = spark.read.text(root).select("event_type", "_metadata.file_path").distinct()
    return {r.event_type: r.file_path for r in places.collect()}


@query("s5_template_fields")
def s5_template_fields(spark, sf_dir):
    return template_fields(spark, _template_files(spark, sf_dir, "s5")).select("asset", "name", "type", "error")


@query("d7_compiled_templates")
def d7_compiled_templates(spark, sf_dir):
    """Columns of the silver datasets as compiled from files: those found in the events, with new fields proposed.

    Files with a type that telemetry cannot have are reported, one row each.
    """
    bad = _template_files(spark, sf_dir, "d7")
    templates = list(fx.event_templates().values())
    files = reports.propose(reports.typed_drift(event_bronze(spark, sf_dir), templates), templates)
    root = scratch_folder(spark, "d7p")
    rows = [(asset, json.dumps(content)) for asset, content in files.items()]
    spark.createDataFrame(rows, "asset string, value string").write.partitionBy("asset").text(root)
    places = spark.read.text(root).select("asset", "_metadata.file_path").distinct().collect()
    good = {f"new {r.asset}": r.file_path for r in places}
    compiled, errors = compile_templates(spark, bad | good)
    columns = [
        (asset, at, name, column, kind.simpleString(), None)
        for asset, t in compiled.items()
        for at, (name, column, kind) in enumerate(t.columns)
    ]
    columns += [(asset, None, None, None, None, error) for asset, error in errors.items()]
    return spark.createDataFrame(columns, "asset string, position int, name string, column string, type string, error string")


# -- scalar functions and projections -----------------------------------------------


@query("f1_f2_header_parse")
def f1_f2_header_parse(spark, sf_dir):
    raw = fx.event_raw(spark, sf_dir).withColumn("body", F.col("body").cast("binary"))
    return show(
        to_bronze(raw, LOADED).select(
            "body", "enqueuedTime", "deviceId", "templateName", "templateId", "deviceEnqueuedTime"
        )
    )


@query("f4_rowhash")
def f4_rowhash(spark, sf_dir):
    return fx.event_raw(spark, sf_dir).select("body", row_hash(F.col("body")).alias("rowhash"))


@query("f4_rowhash_whole_texts")
def f4_rowhash_whole_texts(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    return documents.select("doc_id", row_hash(F.col("text")).alias("rowhash"))


@query("f5_partition_columns")
def f5_partition_columns(spark, sf_dir):
    bronze = to_bronze(fx.line_raw(spark, sf_dir), LOADED)
    return bronze.select("rowhash", "yearDevice", "monthDevice")


@query("f6_load_time")
def f6_load_time(spark, sf_dir):
    return show(event_bronze(spark, sf_dir).select("rowhash", "loadDatetime"))


@query("f7_f9_device_time")
def f7_f9_device_time(spark, sf_dir):
    sent = utc_time(F.get_json_object("body", "$.enqueuedTime"))
    bronze = event_bronze(spark, sf_dir)
    return show(
        bronze.select("rowhash", sent.alias("sent")).withColumn("sent_date", utc_date(F.col("sent")))
    )


@query("f8_pacific_time")
def f8_pacific_time(spark, sf_dir):
    bronze = event_bronze(spark, sf_dir)
    return show(
        bronze.select(
            "rowhash",
            F.col("deviceEnqueuedTime").alias("utc_time"),
            local_time(F.col("deviceEnqueuedTime")).alias("pacific_time"),
        )
    )


@query("f10_station_id")
def f10_station_id(spark, sf_dir):
    return event_bronze(spark, sf_dir).select(
        "rowhash", "deviceId", station_id(F.col("deviceId")).alias("stationid")
    )


@query("f3_envelope_fields")
def f3_envelope_fields(spark, sf_dir):
    """All fields of the envelope, with an object kept as text."""
    template = fx.line_templates()["Line N"]
    parsed = parse_envelope(bronze_of(fx.line_raw(spark, sf_dir), LOADED), template)
    names = [f.name for f in schemas.ENVELOPE_FIELDS if f.name != "messageProperties"]
    return parsed.select(
        "rowhash",
        *[F.col("message").getField(n).alias(n) for n in names],
        F.col("message.messageProperties.`iothub-creation-time-utc`").alias("created"),
        "flagged",
    )


# -- filters --------------------------------------------------------------------


@query("p5_template_filter")
def p5_template_filter(spark, sf_dir):
    return of_template(event_bronze(spark, sf_dir), "view").select("rowhash", "body")


@query("p6_case_insensitive")
def p6_case_insensitive(spark, sf_dir):
    """Column names in any case; template names only as written."""
    bronze = event_bronze(spark, sf_dir)
    named = bronze.where((F.col("TEMPLATENAME") == "view") | (F.col("templatename") == "VIEW"))
    return named.select(F.col("RowHash").alias("rowhash"), F.col("DEVICEID").alias("deviceId"))


@query("p7_flagged")
def p7_flagged(spark, sf_dir):
    bronze = event_bronze(spark, sf_dir)
    return parse_envelope(bronze, fx.event_templates()["view"]).select("rowhash", "flagged")


# -- silver ---------------------------------------------------------------------


def _silver_of_events(asset: str) -> Query:
    def run(spark, sf_dir):
        silver = to_silver(event_bronze(spark, sf_dir), fx.event_templates()[asset])
        return show(silver, drop=["loaddatetime"])

    return run


for _asset in fx.EVENT_ASSETS:
    query(f"f3_p3_silver_{_asset}")(_silver_of_events(_asset))


@query("f3_p3_silver_all_types")
def f3_p3_silver_all_types(spark, sf_dir):
    """Float, double, integer and boolean telemetry."""
    bronze = bronze_of(fx.line_raw(spark, sf_dir), LOADED)
    silver = silver_of_all(bronze, fx.line_templates().values())
    return show(silver.withColumn("discount", F.col("discount").cast("double")), drop=["loaddatetime"])


# -- merge ----------------------------------------------------------------------


@query("j1_merge_compat")
def j1_merge_compat(spark, sf_dir):
    layout = new_layout(spark, "j1c")
    two_deliveries(spark, sf_dir, layout, "compat")
    return copies_by_hash(bronze_target(layout).read(spark))


@query("j1_merge_strict")
def j1_merge_strict(spark, sf_dir):
    layout = new_layout(spark, "j1s")
    two_deliveries(spark, sf_dir, layout)
    return show(bronze_target(layout).read(spark), drop=["loadDatetime"])


def _merge_lines(spark: SparkSession, sf_dir: str, spec: MergeSpec, label: str) -> DataFrame:
    """All line items up to 1998, then all from 1996 on, into one target."""
    target = bronze_target(new_layout(spark, label))
    raw = fx.line_raw(spark, sf_dir)
    for batch in (
        between_positions(raw, end="1998-12-31 00:00:00"),
        between_positions(raw, start="1996-01-01 00:00:00"),
    ):
        merge_insert(to_bronze(batch, LOADED), target, spec)
    return copies_by_hash(target.read(spark))


@query("j1_merge_pruned_equals_plain")
def j1_merge_pruned_equals_plain(spark, sf_dir):
    """History pruned by month and device time, batch keys broadcast."""
    return _merge_lines(spark, sf_dir, MergeSpec(), "j1p")


@query("j1_merge_large_batch")
def j1_merge_large_batch(spark, sf_dir):
    """The form for batches whose keys are too many to broadcast, without pruning."""
    return _merge_lines(spark, sf_dir, MergeSpec(broadcast_rows=0, max_days=0, max_months=0), "j1l")


@query("j1_merge_undated")
def j1_merge_undated(spark, sf_dir):
    """Whole documents as bodies: every row lies in the one partition without a date."""
    target = bronze_target(new_layout(spark, "j1u"))
    for _ in range(2):
        merge_insert(to_bronze(fx.document_raw(spark, sf_dir), LOADED), target)
    return copies_by_hash(target.read(spark))


@query("j1_merge_undated_again")
def j1_merge_undated_again(spark, sf_dir):
    """Few undated messages come again, between new ones: their keys alone say where they are looked for."""
    target = bronze_target(new_layout(spark, "j1v"))
    raw = fx.document_raw(spark, sf_dir)
    merge_insert(to_bronze(raw, LOADED), target)
    some = raw.where(row_hash(F.col("body")).startswith("0"))
    changed = some.withColumn("body", F.concat("body", F.lit(" again")))
    stats = merge_insert(to_bronze(some.unionByName(changed), LOADED), target)
    found = target.read(spark).groupBy("rowhash").agg(F.count(F.lit(1)).alias("copies"))
    return found.withColumn("known_in_batch", F.lit(stats.matched_keys))


@query("j1_merge_time_of_day")
def j1_merge_time_of_day(spark, sf_dir):
    """Device times without a date give no instant, so a message has one place on any day."""
    target = bronze_target(new_layout(spark, "j1t"))
    raw = fx.event_raw(spark, sf_dir)
    dateless = F.regexp_replace("body", '"enqueuedTime":"[0-9-]+T', '"enqueuedTime":"')
    for batch in (between_positions(raw, end=MID_MONTH), raw):
        merge_insert(to_bronze(batch.withColumn("body", dateless), LOADED), target)
    dated = F.bool_or(F.col("deviceEnqueuedTime").isNotNull()).alias("dated")
    return target.read(spark).groupBy("rowhash").agg(F.count(F.lit(1)).alias("copies"), dated)


# -- streams --------------------------------------------------------------------


@query("k2_bootstrap_then_merge")
def k2_bootstrap_then_merge(spark, sf_dir):
    """Silver is created from all history, then continued on the same checkpoint."""
    layout = new_layout(spark, "k2")
    templates = fx.event_templates()
    raw = fx.event_raw(spark, sf_dir)
    deliver(spark, layout, between_positions(raw, end=MID_MONTH))
    start_silver(spark, layout, templates, trigger=ONCE).wait()
    deliver(spark, layout, raw)
    start_silver(spark, layout, templates, trigger=ONCE).wait()
    return show(read_silver(spark, layout, templates.values()), drop=["loaddatetime"])


@query("t6_fanout_all_templates")
def t6_fanout_all_templates(spark, sf_dir):
    layout = new_layout(spark, "t6")
    templates = fx.event_templates()
    deliver(spark, layout, fx.event_raw(spark, sf_dir))
    start_silver(spark, layout, templates, trigger=ONCE).wait()
    return show(read_silver(spark, layout, templates.values()), drop=["loaddatetime"])


@query("t6_fanout_rejects")
def t6_fanout_rejects(spark, sf_dir):
    """What the fan-out rejects, kept by a stream of its own next to the silver ones."""
    layout = new_layout(spark, "t6r")
    templates = {a: fx.event_templates()[a] for a in KNOWN_ASSETS}
    deliver(spark, layout, fx.event_raw(spark, sf_dir))
    start_silver(spark, layout, templates, trigger=ONCE, rejects=True).wait()
    rejected = spark.read.parquet(f"{layout.quarantine('silver')}/*")
    return rejected.select("rowhash", "reason")


@query("t6_fanout_single_stream")
def t6_fanout_single_stream(spark, sf_dir):
    """Asset names with spaces; one stream of bronze for all templates."""
    layout = new_layout(spark, "t6s")
    templates = fx.line_templates()
    merge_insert(to_bronze(fx.line_raw(spark, sf_dir), LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    return show(read_silver(spark, layout, templates.values()), drop=["loaddatetime"])


@query("t5_time_boxed")
def t5_time_boxed(spark, sf_dir):
    """A run that is cut off by its job time, then resumed to the end."""
    layout = new_layout(spark, "t5")
    fx.event_raw(spark, sf_dir).write.parquet(f"{layout.root}/raw")
    stream = bus_stream(spark, f"{layout.root}/raw", max_files=3)
    run_for(start_bronze(stream, layout, trigger=trigger_of(0)), timeout_seconds(0.02))
    run_for(start_bronze(stream, layout, trigger=ONCE))
    return copies_by_hash(bronze_target(layout).read(spark))


@query("t8_late_rows_kept")
def t8_late_rows_kept(spark, sf_dir):
    """The second half of the month arrives before the first, under a watermark."""
    layout = new_layout(spark, "t8")
    raw = fx.event_raw(spark, sf_dir)
    for part in (between_positions(raw, start=MID_MONTH), between_positions(raw, end=MID_MONTH)):
        part.write.mode("append").parquet(f"{layout.root}/raw")
        stream = bus_stream(spark, f"{layout.root}/raw", watermark="1 minute")
        run_for(start_bronze(stream, layout, trigger=ONCE, load_time=LOADED))
    return show(bronze_target(layout).read(spark), drop=["loadDatetime"])


@query("t8_recent_copies")
def t8_recent_copies(spark, sf_dir):
    """Both halves of the month, then all of it again, with copies dropped by the stream's state: no row is lost as late."""
    layout = new_layout(spark, "t8r")
    raw = fx.event_raw(spark, sf_dir)
    for part in (between_positions(raw, start=MID_MONTH), between_positions(raw, end=MID_MONTH), raw.where("body is not null")):
        part.write.mode("append").parquet(f"{layout.root}/raw")
        stream = bus_stream(spark, f"{layout.root}/raw")
        run_for(start_bronze(stream, layout, trigger=ONCE, load_time=LOADED, recent_minutes=600))
    offered = metrics.read(spark, layout.metrics()).agg(F.sum("matched_keys"), F.sum("quarantined")).first()
    landed = bronze_target(layout).read(spark).select("rowhash", "templateName", "yearDevice", "monthDevice")
    return landed.withColumn("known", F.lit(offered[0]).cast("long")).withColumn("keyless", F.lit(offered[1]).cast("long"))


@query("a1_batch_metrics")
def a1_batch_metrics(spark, sf_dir):
    layout = new_layout(spark, "a1")
    two_deliveries(spark, sf_dir, layout)
    return metrics.read(spark, layout.metrics()).drop("at")


@query("l2_last_batch")
def l2_last_batch(spark, sf_dir):
    layout = new_layout(spark, "l2")
    two_deliveries(spark, sf_dir, layout)
    return metrics.latest(spark, layout.metrics()).drop("at")


@query("a1_stream_progress")
def a1_stream_progress(spark, sf_dir):
    """Rows of each batch as Spark reports them, kept by a listener in one file per query and day."""
    layout = new_layout(spark, "a1p")
    raw = fx.event_raw(spark, sf_dir)
    reports_of = progress.ProgressLog()
    spark.streams.addListener(reports_of)
    try:
        for batch in (between_positions(raw, end=MID_MONTH), between_positions(raw, start=MID_MONTH)):
            batch.write.mode("append").parquet(f"{layout.root}/raw")
            stream = bus_stream(spark, f"{layout.root}/raw", watermark="1 hour")
            started = run_stream(stream, append_sink(f"{layout.root}/kept"), layout.checkpoint("kept"), ONCE, name="kept")
            run_for(started)
            reports_of.wait(started.runId)
            reports_of.flush(spark, layout.progress())
    finally:
        spark.streams.removeListener(reports_of)
    found = progress.read(spark, layout.progress())
    return found.select("query", "batch_id", "rows_in", (F.col("batch_ms") > 0).alias("timed"), F.col("watermark").isNotNull().alias("marked"))


# -- catalog ----------------------------------------------------------------------


def _silver_tables(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, Layout]:
    """A database with one silver table per event type."""
    root = scratch_folder(spark, label)
    database = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    layout = Layout(root, f"{database}.bronze", f"{database}.silver")
    merge_insert(to_bronze(fx.event_raw(spark, sf_dir), LOADED), bronze_target(layout))
    for template in fx.event_templates().values():
        rebuild_silver(spark, layout, template)
    return database, layout


@query("c1_table_over_existing_folder")
def c1_table_over_existing_folder(spark, sf_dir):
    """A folder that gets a table name, which is dropped later on, keeps all its messages."""
    root = scratch_folder(spark, "c1")
    database = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    raw = fx.event_raw(spark, sf_dir)
    merge_insert(to_bronze(between_positions(raw, end=MID_MONTH), LOADED), bronze_target(Layout(root)))
    named = bronze_target(Layout(root, f"{database}.bronze"))
    merge_insert(to_bronze(between_positions(raw, end=END), LOADED), named)
    spark.sql(f"DROP TABLE {database}.bronze")
    merge_insert(to_bronze(between_positions(raw, start=MID_MONTH), LOADED), named)
    return copies_by_hash(named.read(spark))


@query("c2_list_tables")
def c2_list_tables(spark, sf_dir):
    database, _ = _silver_tables(spark, sf_dir, "c2")
    return list_tables(spark, database, "silver").select("tableName")


@query("c3_c4_reset")
def c3_c4_reset(spark, sf_dir):
    """Silver really dropped and deleted: bronze per template as it was, and what is left of silver."""
    database, layout = _silver_tables(spark, sf_dir, "c3")
    reset = reset_layer(spark, layout, "silver", dry_run=False)
    tables = [r.tableName for r in list_tables(spark, database, "silver").collect()]
    left = bronze_target(layout).read(spark).groupBy("templateName").agg(F.count(F.lit(1)).alias("messages"))
    return left.withColumns(
        {
            "tables_dropped": F.lit(len(reset.tables)).cast("long"),
            "tables_left": F.lit(len(tables)).cast("long"),
            "folders_left": F.lit(len(children(spark, layout.silver()))).cast("long"),
        }
    )


@query("d5_reset_dry_run")
def d5_reset_dry_run(spark, sf_dir):
    """A dry run removes nothing: what it lists can still be read."""
    _, layout = _silver_tables(spark, sf_dir, "d5")
    reset = reset_layer(spark, layout, "silver")
    parts = [
        spark.table(t).select(F.lit(t.split(".")[1]).alias("tableName"), "rowhash") for t in reset.tables
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    return union.groupBy("tableName").agg(F.count(F.lit(1)).alias("row_count"))


# -- upkeep -----------------------------------------------------------------------

@query("d1_quarantine")
def d1_quarantine(spark, sf_dir):
    bronze = event_bronze(spark, sf_dir)
    bodiless = to_bronze(fx.event_raw(spark, sf_dir), LOADED).where("body is null")
    rejected = quarantine(bronze.unionByName(bodiless), KNOWN_ASSETS)
    return show(rejected, drop=["loadDatetime"])


@query("d8_conservation")
def d8_conservation(spark, sf_dir):
    """From the bus to silver, per template and month: where the messages are, and that none is lost or doubled."""
    layout = new_layout(spark, "d8c")
    templates = {a: t for a, t in fx.event_templates().items() if a in KNOWN_ASSETS}
    raw = fx.event_raw(spark, sf_dir)
    for batch in (between_positions(raw, end=MID_MONTH), raw):
        merge_insert(to_bronze(batch, LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    bronze = bronze_target(layout).read(spark)
    received = reports.received_balance(to_bronze(raw, LOADED), bronze)
    silver = read_silver(spark, layout, templates.values())
    refined = reports.balance(bronze, silver=silver, rejected=rejects.written(spark, layout))
    left = ["rows_left", "sum_left", "xor_left"]
    even = [*[F.col(f"{side}.{c}") == 0 for side in ("x", "y") for c in left]]
    both = received.alias("x").join(refined.alias("y"), [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in reports.MONTH], "left")
    # What has no body is in no bronze.
    even = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(True)) for c in even])
    return both.select(
        *[F.col(f"x.{c}").alias(c) for c in reports.MONTH],
        F.col("x.whole").alias("received"), "x.bronze", "x.copies", "x.bodiless",
        *[F.coalesce(F.col(f"y.{c}"), F.lit(0)).alias(c) for c in ("silver", "rejected")], even.alias("balanced"),
    )


@query("d1_release")
def d1_release(spark, sf_dir):
    """A template that comes later takes its messages out of quarantine; a second release finds none."""
    layout = new_layout(spark, "d1r")
    templates = fx.event_templates()
    merge_insert(to_bronze(fx.event_raw(spark, sf_dir), LOADED), bronze_target(layout))
    some = {a: t for a, t in templates.items() if a in KNOWN_ASSETS}
    run_for(start_silver_single(spark, layout, some, trigger=ONCE))
    for _ in range(2):
        rejects.release(spark, layout, templates)
    silver = read_silver(spark, layout, templates.values()).select("rowhash", F.lit("silver").alias("place"))
    left = rejects.current(spark, layout).select("rowhash", F.col("reason").alias("place"))
    return silver.unionByName(left)


@query("t6_template_joins_later")
def t6_template_joins_later(spark, sf_dir):
    """The single stream meets a new template in its second run and fills it from history by itself."""
    layout = new_layout(spark, "t6j")
    templates = fx.event_templates()
    raw = fx.event_raw(spark, sf_dir)
    merge_insert(to_bronze(between_positions(raw, end=MID_MONTH), LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, {a: templates[a] for a in KNOWN_ASSETS}, trigger=ONCE))
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    silver = read_silver(spark, layout, templates.values()).select("rowhash", F.lit("silver").alias("place"))
    left = rejects.current(spark, layout).select("rowhash", F.col("reason").alias("place"))
    return silver.unionByName(left)


@query("d2_orphans")
def d2_orphans(spark, sf_dir):
    return reports.orphans(event_bronze(spark, sf_dir), KNOWN_ASSETS)


@query("d3_redelivery")
def d3_redelivery(spark, sf_dir):
    return reports.redelivery(to_bronze(fx.event_raw(spark, sf_dir), LOADED))


@query("d3_summaries")
def d3_summaries(spark, sf_dir):
    """Deliveries per template from the sketches of all batches, and whether the estimates keep their errors."""
    layout = new_layout(spark, "d3s")
    raw = fx.event_raw(spark, sf_dir)
    for part in (raw.where(F.col("enqueuedTime") < MID_MONTH), raw.where(F.col("enqueuedTime") >= MID_MONTH)):
        part.write.mode("append").parquet(f"{layout.root}/raw")
        stream = bus_stream(spark, f"{layout.root}/raw")
        run_for(start_bronze(stream, layout, trigger=ONCE, load_time=LOADED, summarize=True))
    found = summaries.read(spark, layout.summaries("bronze"), [0.5])
    found = found.select(F.coalesce("templateName", F.lit("")).alias("name"), "deliveries", "devices", F.col("delays")[0].alias("middle"))
    # The messages themselves are read only to hold the estimates against them.
    received = to_bronze(raw, LOADED).withColumn("name", F.coalesce("templateName", F.lit("")))
    delay = F.unix_micros("enqueuedTime") - F.unix_micros("deviceEnqueuedTime")
    exact = received.join(F.broadcast(found.select("name", "middle")), "name").groupBy("name").agg(
        F.count_distinct("deviceId").alias("exact"), F.count(delay).alias("n"),
        F.count_if(delay < F.col("middle")).alias("below"), F.count_if(delay <= F.col("middle")).alias("upto"),
    )
    met = found.join(exact, "name")
    rank = F.col("n") * 0.5
    return met.select(
        F.nullif("name", F.lit("")).alias("templateName"), "deliveries",
        (F.abs(F.col("devices") - F.col("exact")) <= 0.05 * F.col("exact")).alias("devices_within"),
        ((F.col("below") - 0.01 * F.col("n") <= rank) & (rank <= F.col("upto") + 0.01 * F.col("n"))).alias("delay_within"),
    )


@query("d3_copies_whole_texts")
def d3_copies_whole_texts(spark, sf_dir):
    received = to_bronze(fx.document_raw(spark, sf_dir), LOADED)
    return reports.copies(received).select("rowhash", "copies")


@query("d6_drift")
def d6_drift(spark, sf_dir):
    return reports.drift(event_bronze(spark, sf_dir), fx.event_templates().values())


@query("d6_mistyped")
def d6_mistyped(spark, sf_dir):
    return reports.mistyped(event_bronze(spark, sf_dir), fx.event_templates().values())


@query("d6_typed_drift")
def d6_typed_drift(spark, sf_dir):
    return reports.typed_drift(event_bronze(spark, sf_dir), fx.event_templates().values())


@query("d8_rebuild")
def d8_rebuild(spark, sf_dir):
    layout = new_layout(spark, "d8")
    templates = fx.event_templates()
    merge_insert(to_bronze(fx.event_raw(spark, sf_dir), LOADED), bronze_target(layout), BRONZE_MERGE)
    for _ in range(2):
        for t in templates.values():
            rebuild_silver(spark, layout, t)
    return show(read_silver(spark, layout, templates.values()), drop=["loaddatetime"])
