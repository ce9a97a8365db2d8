"""Insert-only merge: add the rows of a batch whose key the target does not hold.

The target is history and far larger than a batch, so history is only scanned:

* its scan reads the key column of the partitions and device-time ranges the
  batch touches.  That loses nothing, because the key, the partition columns and
  the device time are all functions of the message body: equal keys have equal
  partitions and times;
* messages without a device time have no range.  While a batch has few of them,
  their keys themselves are the predicate, which the key filters of the files answer
  without reading them;
* the distinct keys of the batch are broadcast to that scan while their number is
  within ``broadcast_rows``; beyond it both sides are reduced to distinct keys
  before they are shuffled, so a key with very many copies is one row per task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.schemas import PARTITION_COLUMNS
from tidegate.storage import Slot, Target, any_of, observed

MODES = ("strict", "compat")
COPIES = ("expected", "unknown", "none")
DAY_MICROS = 86_400_000_000
LAST_MICROS = 2**63 - 1


@dataclass(frozen=True)
class MergeSpec:
    """How to merge.

    ``strict`` keeps one row per key and takes no row without a key.  ``compat``
    compares a batch with the target only: copies inside one batch are all
    inserted, and so is every row whose key is null.  ``arrival`` names the columns
    that may differ between copies, a time first; the earliest copy is kept.

    ``copies`` says what is known of copies inside a batch.  Where they are ``expected``
    or that is ``unknown``, they are removed if a look at the keys finds some, which
    spares a shuffle of all rows; with ``none`` nobody looks.
    """

    key: str = "rowhash"
    mode: str = "strict"
    partition_by: tuple[str, ...] = PARTITION_COLUMNS
    time: str = "deviceEnqueuedTime"
    arrival: tuple[str, ...] = ("enqueuedTime", "loadDatetime")
    copies: str = "expected"
    broadcast_rows: int = 1_000_000
    max_days: int = 4_000
    max_months: int = 1_200
    max_ranges: int = 32
    filter_keys: int = 200

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.copies not in COPIES:
            raise ValueError(f"copies are one of {COPIES}, not {self.copies!r}")

    def with_mode(self, mode: str) -> MergeSpec:
        return replace(self, mode=mode)

    def with_copies(self, copies: str) -> MergeSpec:
        return replace(self, copies=copies)

    def with_arrival(self, columns: Sequence[str]) -> MergeSpec:
        return replace(self, arrival=(*self.arrival, *columns))


BRONZE_MERGE = MergeSpec()
SILVER_MERGE = MergeSpec(
    time="Device_EnqueuedTime",
    arrival=("Eventhub_enqueuedTime", "loaddatetime"),
    copies="unknown",  # strict bronze has none, but it may have been compat before
)


@dataclass(frozen=True)
class Footprint:
    """What a batch touches: row counts, partitions, and device-time ranges in µs.

    ``copies`` tells whether a key may occur more than once.
    ``slots`` is None when the batch spans too many months to be worth listing; the
    target is then read whole, which is slower but just as exact.  ``undated_keys`` are
    the keys of its rows without a device time, None if there are too many to name.
    """

    rows: int
    null_keys: int
    copies: bool
    slots: tuple[Slot, ...] | None
    ranges: tuple[tuple[int, int], ...]
    undated: bool
    undated_keys: tuple[str, ...] | None = None


@dataclass(frozen=True)
class MergeStats:
    rows_in: int
    null_keys: int
    matched_keys: int
    inserted: int


def footprint(batch: DataFrame, spec: MergeSpec = BRONZE_MERGE) -> Footprint:
    """One job over the batch; the driver gets one row per device day.

    If those are too many, as with devices whose clocks are wrong, one per month.
    In strict mode rows are first counted per hash of the key, which shuffles eight
    bytes for each.  Two keys with one hash only make a batch seem to have copies.
    """
    instant = F.col(spec.time)
    counts = (
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(spec.key).isNull()).alias("null_keys"),
        F.min(F.unix_micros(instant)).alias("lo"),
        F.max(F.unix_micros(instant)).alias("hi"),
    )
    totals = (
        F.sum("n").alias("n"),
        F.sum("null_keys").alias("null_keys"),
        F.max(F.col("n") - F.col("null_keys")).alias("copies"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    for unit, limit in (("day", spec.max_days), ("month", spec.max_months), (None, 1)):
        by = []
        if unit is not None:
            by = [*spec.partition_by, "span"]
            batch = batch.withColumn("span", F.date_trunc(unit, instant))
        if spec.mode == "strict" and spec.copies != "none":
            keys = batch.groupBy(*by, F.xxhash64(spec.key).alias("key_hash")).agg(*counts)
            spans = keys.groupBy(*by).agg(*totals)
        else:
            copies = F.lit(2 if spec.mode == "compat" else 1).alias("copies")
            spans = batch.groupBy(*by).agg(*counts, copies)
        rows = [r for r in spans.limit(limit + 1).collect() if r.n]
        slots = None
        if unit is not None:
            slots = tuple(dict.fromkeys(tuple(r[c] for c in spec.partition_by) for r in rows))
            if len(rows) > limit or len(slots) > spec.max_months:
                continue
        undated = any(r.lo is None for r in rows)
        return Footprint(
            sum(r.n for r in rows),
            sum(r.null_keys for r in rows),
            any((r.copies or 0) > 1 for r in rows),
            slots,
            _time_ranges([(r.lo, r.hi) for r in rows if r.lo is not None], spec.max_ranges),
            undated,
            _undated_keys(batch, spec) if undated and slots is not None else None,
        )


def _undated_keys(batch: DataFrame, spec: MergeSpec) -> tuple[str, ...] | None:
    """The distinct keys without a device time, if a predicate can name them."""
    key = F.col(spec.key)
    keys = batch.where(F.col(spec.time).isNull() & key.isNotNull()).select(key).distinct()
    found = keys.limit(spec.filter_keys + 1).collect()
    return tuple(sorted(r[0] for r in found)) if len(found) <= spec.filter_keys else None


def _time_ranges(spans: Sequence[tuple[int, int]], limit: int) -> tuple[tuple[int, int], ...]:
    """At most ``limit`` ranges that cover all the spans, split at the widest gaps."""
    spans = sorted(spans)
    if not spans:
        return ()
    gaps = [(after[0] - before[1], i) for i, (before, after) in enumerate(zip(spans, spans[1:]), 1)]
    wide = sorted(gaps, reverse=True)[: limit - 1]
    cuts = sorted(i for gap, i in wide if gap > DAY_MICROS)
    pieces = zip([0, *cuts], [*cuts, len(spans)])
    return tuple((spans[i][0], max(hi for _, hi in spans[i:j])) for i, j in pieces)


def in_footprint(fp: Footprint, spec: MergeSpec) -> Column:
    """Predicate with literal bounds of the device time, which Parquet statistics can use.

    Keys without a time are compared one by one, as key filters answer equality only.
    """
    instant = F.col(spec.time)
    found = []
    if fp.undated and fp.undated_keys is None:
        found.append(instant.isNull())
    elif fp.undated_keys:
        found.append(instant.isNull() & any_of([F.col(spec.key) == F.lit(k) for k in fp.undated_keys]))
    for lo, hi in fp.ranges:
        bounds = (F.timestamp_micros(F.lit(v).cast("long")) for v in (lo, hi))
        found.append(instant.between(*bounds))
    return any_of(found)


def history_keys(target: Target, batch: DataFrame, fp: Footprint, spec: MergeSpec) -> DataFrame:
    """Keys of the target that a row of the batch could equal."""
    history = target.read(batch.sparkSession, fp.slots)
    if fp.slots is not None:
        history = history.where(in_footprint(fp, spec))
    return history.select(spec.key)


def matched_keys(
    batch: DataFrame, history: DataFrame, spec: MergeSpec, fp: Footprint
) -> DataFrame:
    """Distinct keys that are in both; never more than the batch has rows.

    Of two distinct sides an inner join gives the same as a semi join, but a semi
    join would be moved below the aggregation and shuffle every row of history.
    """
    keys = batch.select(spec.key).where(F.col(spec.key).isNotNull())
    if fp.copies:
        keys = keys.distinct()
    if fp.rows <= spec.broadcast_rows:
        return history.join(F.broadcast(keys), spec.key, "left_semi").distinct()
    return history.distinct().join(keys.hint("shuffle_merge"), spec.key, "inner")


def without(
    batch: DataFrame, hits: DataFrame, spec: MergeSpec, n_hits: int, batch_rows: int
) -> DataFrame:
    """Rows of the batch whose key is not in ``hits``; null keys match nothing."""
    if n_hits <= spec.broadcast_rows:
        return batch.join(F.broadcast(hits), spec.key, "left_anti")
    if spec.mode == "strict":
        # One row per key.  An anti join would be moved below the step that made it so.
        known = hits.withColumn("known", F.lit(True)).hint("shuffle_merge")
        fresh = batch.join(known, spec.key, "left").where("known is null")
        return fresh.select(*batch.columns)
    key = F.col(spec.key)
    keyless = batch.where(key.isNull())
    keyed = batch.where(key.isNotNull())
    # A key with more than 1/1000 of the rows is hot.  There are at most 1000 of
    # those, so they are broadcast and their rows are not shuffled.
    hot = keyed.groupBy(spec.key).count().where(F.col("count") * 1000 > batch_rows).select(spec.key)
    hot_hits = hits.join(F.broadcast(hot), spec.key, "left_semi")
    hot_rows = keyed.join(F.broadcast(hot), spec.key, "left_semi")
    cold_rows = keyed.join(F.broadcast(hot), spec.key, "left_anti")
    return (
        cold_rows.join(hits.hint("shuffle_merge"), spec.key, "left_anti")
        .unionByName(hot_rows.join(F.broadcast(hot_hits), spec.key, "left_anti"))
        .unionByName(keyless)
    )


def has_copies(batch: DataFrame, key: str) -> bool:
    """Whether a key (or, hardly ever, a hash of keys) occurs twice; shuffles hashes only."""
    keys = batch.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key)).count()
    return not keys.where("count > 1").isEmpty()


def first_copy(batch: DataFrame, spec: MergeSpec = BRONZE_MERGE) -> DataFrame:
    """One row per key, the copy with the earliest time in the first arrival column.

    All columns but the arrival ones follow from the key, so grouping by them adds
    no group and keeps this a hash aggregation that drops copies before the shuffle.
    Floating point columns are aggregated instead, as grouping would turn -0.0 into
    0.0.  The arrival columns share one ordering, so they come from one copy.
    """
    arrival = [c for c in spec.arrival if c in batch.columns]
    floats = [f.name for f in batch.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    content = [c for c in batch.columns if c not in arrival and c not in floats]
    if not arrival:
        return batch.dropDuplicates([spec.key])
    # A copy without a time comes last; min_by would skip it.
    order = F.coalesce(F.unix_micros(arrival[0]), F.lit(LAST_MICROS))
    picked = [F.min_by(c, order).alias(c) for c in arrival] + [F.min(c).alias(c) for c in floats]
    return batch.groupBy(*content).agg(*picked).select(*batch.columns)


@contextmanager
def persisted(df: DataFrame):
    """Keep a frame over several actions; lost blocks are recomputed from the source."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        try:
            df.unpersist()
        except Py4JJavaError:  # stopping the stream interrupts the call at work, once
            df.unpersist()


def merge_insert(
    batch: DataFrame,
    target: Target,
    spec: MergeSpec = BRONZE_MERGE,
    append: Callable[[DataFrame], int] | None = None,
) -> MergeStats:
    """Merge one batch into the target and report what happened.

    Each step is chosen by a measured size: copies are removed only if there are
    any, and the batch is joined only if some of its keys were found.  What is measured
    is kept without the bodies; the batch is read once for that and once to insert.
    Repeating a batch, even after a half-finished write, inserts only what is
    missing (for rows with a key).  ``append`` takes the rows to insert, by default the target.
    """
    append = append or target.append
    batch = batch.select(*target.schema.names)
    if not target.exists(batch.sparkSession):
        return _first_load(batch, append, spec)
    # Bodies are not kept but computed again: a kept partition of them can be larger than an executor's memory.
    with persisted(batch.select(*dict.fromkeys([spec.key, spec.time, *spec.partition_by]))) as keys:
        fp = footprint(keys, spec)
        if fp.rows == 0:
            return MergeStats(0, 0, 0, 0)
        rows = batch
        if spec.mode == "strict":
            rows = rows.where(F.col(spec.key).isNotNull())
            if fp.copies:
                rows = first_copy(rows, spec)
        history = history_keys(target, keys, fp, spec)
        with persisted(matched_keys(keys, history, spec, fp)) as hits:
            n_hits = hits.count()
            if n_hits:
                rows = without(rows, hits, spec, n_hits, fp.rows)
            return MergeStats(fp.rows, fp.null_keys, n_hits, append(rows))


def merge_once(
    batch: DataFrame, target: Target, spec: MergeSpec, stream: str, batch_id: int
) -> MergeStats:
    """Merge one batch of a stream exactly once, however often it is tried.

    Its rows are first written beside the target, which stays as it was; a note says that
    they are complete.  From then on a repetition only moves what is left to move, and
    compares nothing with a target that holds half of the batch.  The note
    is kept until the next batch, for a batch whose commit was lost.
    """
    spark = batch.sparkSession
    name = f"{stream}-{batch_id}"
    known = target.noted(spark, name)
    if known is None:
        stats = merge_insert(batch, target, spec, lambda rows: target.stage(rows, name))
        target.note(spark, name, json.dumps(asdict(stats)))
    else:
        stats = MergeStats(**json.loads(known))
    target.publish(spark, name, f"{stream}-{batch_id - 1}")
    return stats


def _first_load(batch: DataFrame, append: Callable[[DataFrame], int], spec: MergeSpec) -> MergeStats:
    """Create the target, possibly from all of history, without keeping the batch."""
    seen = Observation()
    totals = (F.count(F.lit(1)).alias("rows"), F.count_if(F.col(spec.key).isNull()).alias("null_keys"))
    rows = batch.observe(seen, *totals)
    if spec.mode == "strict":
        rows = rows.where(F.col(spec.key).isNotNull())
        if spec.copies != "none" and has_copies(batch, spec.key):
            rows = first_copy(rows, spec)
    inserted = append(rows)
    # A batch without any key leaves an empty plan and no metrics; its rows still count.
    counts = observed(seen) or batch.agg(*totals).first().asDict()
    return MergeStats(counts["rows"], counts["null_keys"], 0, inserted)
