"""Streaming jobs: bus to bronze, and bronze to one silver dataset per template."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegate import schemas
from tidegate.config import Layout, asset_name, asset_names
from tidegate.operators import quarantine
from tidegate.operators.bronze import to_bronze
from tidegate.operators.compact import finish
from tidegate.operators.merge import (
    BRONZE_MERGE,
    SILVER_MERGE,
    MergeSpec,
    MergeStats,
    merge_insert,
    merge_once,
)
from tidegate.operators.silver import to_silver
from tidegate.sources.replay import bronze_stream
from tidegate.sources.templates import Template
from tidegate.storage import Target, children, path_exists, write_batch_folder
from tidegate.streaming import metrics, rejects, summaries
from tidegate.streaming.prefilter import computed_once, without_recent_copies
from tidegate.streaming.runner import OnBatch, await_within, run_stream


def bronze_target(layout: Layout, bus: Sequence[T.StructField] = ()) -> Target:
    """Bronze, with the given bus columns besides the enqueued time.

    Only its writer needs to name them; readers see the fixed columns.
    """
    return Target(
        layout.bronze(),
        T.StructType([*schemas.BRONZE, *bus]),
        layout.bronze_table,
        sort_by=("templateName", "deviceEnqueuedTime"),
    )


def silver_target(layout: Layout, template: Template) -> Target:
    return Target(
        layout.silver(template.asset),
        template.silver_schema(),
        layout.silver_table_of(template.asset),
        sort_by=("Device_EnqueuedTime",),
    )


def append_sink(folder: str) -> OnBatch:
    """Batch callback: keep every row, one folder per batch."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch_folder(batch, folder, batch_id)

    return on_batch


def merge_batch(batch: DataFrame, batch_id: int, target: Target, spec: MergeSpec) -> MergeStats:
    """Merge a micro-batch.

    A strict merge may be repeated as it is.  In ``compat`` mode copies inside a batch are all
    kept, and rows without a key always, so a batch is merged once by its stream and number.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if spec.mode == "strict" or stream is None:
        return merge_insert(batch, target, spec)
    return merge_once(batch, target, spec, stream, batch_id)


def merge_sink(target: Target, spec: MergeSpec, layout: Layout, name: str) -> OnBatch:
    """Batch callback: insert-only merge into the target, then one metrics row."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stats = merge_batch(batch, batch_id, target, spec)
        metrics.record(batch.sparkSession, layout.metrics(), name, batch_id, stats)

    return on_batch


def bronze_sink(
    layout: Layout, mode: str = "strict", bus: Sequence[T.StructField] = (), summarize: bool = False
) -> OnBatch:
    """Merge into bronze; in strict mode messages without a body go to quarantine.

    With ``summarize`` each batch is read once more, for the sketches of its deliveries.
    """
    target = bronze_target(layout, bus)
    spec = BRONZE_MERGE.with_mode(mode).with_arrival([f.name for f in bus])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stats = merge_batch(batch, batch_id, target, spec)
        quarantined = stats.null_keys if mode == "strict" else 0
        if quarantined:
            rejected = batch.where(F.col("body").isNull()).withColumn("reason", F.lit("null_body"))
            write_batch_folder(rejected, layout.quarantine("bronze"), batch_id)
        if summarize:
            summaries.record(batch, layout.summaries("bronze"), batch_id)
        metrics.record(batch.sparkSession, layout.metrics(), "bronze", batch_id, stats, quarantined)

    return on_batch


def start_bronze(
    raw: DataFrame,
    layout: Layout,
    mode: str = "strict",
    trigger: dict[str, Any] | None = None,
    load_time: Any = None,
    summarize: bool = False,
    recent_minutes: float | None = None,
) -> StreamingQuery:
    """Land bus records in bronze, with all their bus columns.

    With ``recent_minutes`` copies that follow within that time go before the merge
    and are in no metric or summary.
    """
    if recent_minutes is not None and mode != "strict":
        raise ValueError("copies go before the merge in strict mode only")
    known = {"body", *schemas.BRONZE.names}
    bus = [f for f in raw.schema if f.name not in known]
    finish(raw.sparkSession, bronze_target(layout, bus))
    sink = bronze_sink(layout, mode, bus, summarize)
    messages = to_bronze(raw, load_time)
    if recent_minutes is not None:
        messages, sink = without_recent_copies(messages, recent_minutes), computed_once(sink)
    return run_stream(messages, sink, layout.checkpoint("bronze"), trigger)


def _refuse_other_form(spark: SparkSession, layout: Layout, checkpoints: Sequence[str]) -> None:
    """Both forms number their own batches and name folders after them: one layout, one form."""
    for name in checkpoints:
        if path_exists(spark, layout.checkpoint(name)):
            raise ValueError(f"{layout.root} is fed by the other stream form (checkpoint {name}): reset silver first")


@dataclass
class FanOut:
    """Running silver queries by asset, and the assets that failed to start."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)

    def wait(self, seconds: float | None = None) -> None:
        """Await all queries, stop them, then raise every failure as one error."""
        errors = {**self.errors, **await_within(self.queries, seconds)}
        if errors:
            text = "; ".join(f"{asset}: {e}" for asset, e in sorted(errors.items()))
            raise RuntimeError(f"{len(errors)} of the silver streams failed: {text}")


def start_silver(
    spark: SparkSession,
    layout: Layout,
    templates: Mapping[str, Template],
    mode: str = "strict",
    trigger: dict[str, Any] | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    rejects: bool = False,
) -> FanOut:
    """One independent query per template, each with its own target and checkpoint.

    A new template fills itself from all of bronze.  The first run and later runs
    share one sink, so nothing changes when a target comes into being.  Bronze
    files are sorted by template name, so each query's pushed-down filter skips
    the row groups of other templates.  With ``rejects``, one more query keeps the
    messages that no template takes; it judges by the templates known at its time.
    """
    asset_names(templates)
    _refuse_other_form(spark, layout, ["silver_single"])
    started = FanOut()
    if rejects:
        bronze = bronze_stream(spark, bronze_target(layout), max_files, max_bytes)
        started.queries["(rejects)"] = run_stream(
            quarantine.quarantine(bronze, templates),
            append_sink(layout.quarantine("silver")),
            layout.checkpoint("quarantine"),
            trigger,
        )
    for asset, template in templates.items():
        try:
            finish(spark, silver_target(layout, template))
            bronze = bronze_stream(spark, bronze_target(layout), max_files, max_bytes)
            sink = merge_sink(
                silver_target(layout, template), SILVER_MERGE.with_mode(mode), layout, f"silver_{asset_name(asset)}"
            )
            started.queries[asset] = run_stream(
                to_silver(bronze, template), sink, layout.checkpoint("silver", asset), trigger
            )
        except Exception as e:  # reported by wait(); other assets still run
            started.errors[asset] = e
    return started


def silver_sink(
    layout: Layout, templates: Mapping[str, Template], mode: str = "strict", parallel: int = 4
) -> OnBatch:
    """Batch callback that feeds every template from one batch of bronze."""
    asset_names(templates)
    spec = SILVER_MERGE.with_mode(mode)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch is read again by each step: kept, it would be a second copy of bronze on the executors' disks.
        is_rejected = quarantine.reason(templates).isNotNull()
        counts = (F.count(F.lit(1)).alias("rows"), F.count_if(is_rejected).alias("rejected"))
        if mode == "strict":
            # One look at the keys, by their hashes, spares a look per template.
            hashes = batch.groupBy(F.col(spec.key).isNotNull().alias("keyed"), F.xxhash64(spec.key)).agg(*counts)
            copies = F.max(F.when(F.col("keyed"), F.col("rows"))).alias("copies")
            found = hashes.agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), copies).first()
        else:
            found = batch.agg(*counts, F.lit(2).alias("copies")).first()
        rows, rejected = found.rows or 0, found.rejected or 0
        if rejected:
            write_batch_folder(quarantine.quarantine(batch, templates), layout.quarantine("silver"), batch_id)
        metrics.record(batch.sparkSession, layout.metrics(), "quarantine", batch_id, MergeStats(rows, 0, 0, 0), rejected)
        known = spec if (found.copies or 0) > 1 else spec.with_copies("none")

        def feed(asset: str) -> None:
            target = silver_target(layout, templates[asset])
            sink = merge_sink(target, known, layout, f"silver_{asset_name(asset)}")
            sink(to_silver(batch, templates[asset]), batch_id)

        with ThreadPoolExecutor(parallel) as pool:
            for run in [pool.submit(feed, asset) for asset in templates]:
                run.result()

    return on_batch


def adopt(spark: SparkSession, layout: Layout, templates: Mapping[str, Template], mode: str = "strict") -> list[str]:
    """Bring templates that the single stream has not fed before up to its position.

    Each template has a mark with the stream's last batch at the time it joined.  One
    without a mark, if the stream has run before, is filled from all of bronze, and its
    messages leave quarantine.  What the stream reads of that later is found to be there.
    The mark comes last: a run that ended before it starts anew and inserts what is missing.
    """
    names = asset_names(templates)
    marks = layout.checkpoint("silver_single_templates")
    known = set(children(spark, marks))
    new = [asset for asset in templates if names[asset] not in known]
    batches = [int(b) for b in children(spark, f"{layout.checkpoint('silver_single')}/commits") if b.isdigit()]
    filled = []
    if new and batches:
        bronze = bronze_target(layout).read(spark)
        for asset in new:
            target = silver_target(layout, templates[asset])
            stats = merge_insert(to_silver(bronze, templates[asset]), target, SILVER_MERGE.with_mode(mode))
            metrics.record(spark, layout.metrics(), f"silver_{names[asset]}", -1, stats)
            filled.append(asset)
        rejects.release(spark, layout, templates, mode)
    position = max(batches, default=-1)
    for asset in new:
        place = f"{marks}/{names[asset]}"
        spark.range(0, 1, 1, 1).select(F.lit(str(position))).write.mode("overwrite").text(place)
    return filled


def start_silver_single(
    spark: SparkSession,
    layout: Layout,
    templates: Mapping[str, Template],
    mode: str = "strict",
    trigger: dict[str, Any] | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """All templates from one query: bronze is listed once, rejects are kept.

    Cheaper than one query per template when there are many.  Its checkpoint is
    shared, so a template that comes later is filled from history before the stream goes on.
    """
    _refuse_other_form(spark, layout, ["silver", "quarantine"])
    for template in templates.values():
        finish(spark, silver_target(layout, template))
    adopt(spark, layout, templates, mode)
    bronze = bronze_stream(spark, bronze_target(layout), max_files, max_bytes)
    sink = silver_sink(layout, templates, mode)
    return run_stream(bronze, sink, layout.checkpoint("silver_single"), trigger)
