"""What was delivered, as sketches that merge: devices and delivery delay per template.

Each batch leaves one row per template: its deliveries, a distinct-count sketch of the devices and a quantile sketch of the
delay from the device to the bus.  Reading merges these rows and never looks at the messages.  Devices are counted within
5 % (three standard errors of 1.6 %), a quantile's rank within 1 % (99 % of the time).

Every ``ROLL`` batches the rows of all but the latest are merged into one row per template, named after
the last batch in it; readers take the newest such file and the batches after it, so an interrupted merge
counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.storage import children, delete_path, path_exists

SCHEMA = "templateName string, deliveries bigint, devices binary, delays binary"
ROLL = 100
DEVICE_BITS = 12
DELAY_K = 400


def summarize(received: DataFrame) -> DataFrame:
    """One row per template (null: no name) of rows as received, in the columns of bronze.

    Rows without a device do not count as one; the delay in microseconds needs both times.
    """
    delay = F.unix_micros("enqueuedTime") - F.unix_micros("deviceEnqueuedTime")
    return received.groupBy("templateName").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.hll_sketch_agg("deviceId", DEVICE_BITS).alias("devices"),
        F.kll_sketch_agg_bigint(delay, DELAY_K).alias("delays"),
    )


def record(received: DataFrame, folder: str, batch_id: int) -> None:
    """Keep the summary of one batch; a repeated batch replaces its own."""
    spark = received.sparkSession
    _write(summarize(received), f"{folder}/batch_id={batch_id}")
    if batch_id > 0 and batch_id % ROLL == 0:
        roll_up(spark, folder)


def _write(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def _complete(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    numbers = (int(n.removeprefix(prefix)) for n in children(spark, folder) if n.startswith(prefix))
    return sorted(n for n in numbers if path_exists(spark, f"{folder}/{prefix}{n}/_SUCCESS"))


def _parts(spark: SparkSession, folder: str) -> tuple[list[str], list[int]]:
    """The newest merged file, if there is one, and the batches after it."""
    merged = _complete(spark, folder, "upto=")[-1:]
    after = [b for b in _complete(spark, folder, "batch_id=") if not merged or b > merged[0]]
    return [f"{folder}/upto={n}" for n in merged], after


def _merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(*paths)
    return rows.groupBy("templateName").agg(
        F.sum("deliveries").alias("deliveries"),
        F.hll_union_agg("devices").alias("devices"),
        F.kll_merge_agg_bigint("delays").alias("delays"),
    )


def roll_up(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Merge all batches but the latest ``keep``, which may come again; returns how many."""
    merged, after = _parts(spark, folder)
    old = after[: max(0, len(after) - keep)]
    if not old:
        return 0
    _write(_merged(spark, [*merged, *(f"{folder}/batch_id={b}" for b in old)]), f"{folder}/upto={old[-1]}")
    for name in children(spark, folder):
        kind, _, number = name.partition("=")
        if (kind == "batch_id" and int(number) <= old[-1]) or (kind == "upto" and int(number) < old[-1]):
            delete_path(spark, f"{folder}/{name}")
    return len(old)


def read(spark: SparkSession, folder: str, ranks: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Per template: ``deliveries``, ``devices`` and ``delays``, microseconds at the given ranks (null: none is known)."""
    merged, after = _parts(spark, folder)
    rows = _merged(spark, [*merged, *(f"{folder}/batch_id={b}" for b in after)])
    at = F.array(*[F.lit(float(r)) for r in ranks])
    known = F.kll_sketch_get_n_bigint("delays") > 0
    return rows.select(
        "templateName",
        "deliveries",
        F.hll_sketch_estimate("devices").alias("devices"),
        F.when(known, F.kll_sketch_get_quantile_bigint("delays", at)).alias("delays"),
    )
