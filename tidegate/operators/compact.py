"""Compaction: small files of a partition are packed into bins, and each bin is rewritten as one file.

A run keeps a journal beside the dataset: ``plan`` (the files that go, with their bins), ``files`` (those that come)
and ``ready`` (both are complete and hold the same rows).  Up to ``ready`` the dataset is untouched, and a
journal without it is dropped.  From then on the new files are moved in, and only then the old
ones deleted; whoever finds the journal goes on with that.  So no row is ever missing; between the two
steps rows may be found twice, which an insert-only merge does not mind.

Streams that read the dataset take packed files for new ones.  A merge finds their rows in its target, so nothing
is added, but they are read once more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.storage import KEY_PREFIX, Target, delete_file, delete_path, move_files, path_exists

GOAL = 128 * 1024 * 1024
BIN = "_bin"
# A shuffle of more parts than this costs more than bins that share a task.
MOST_TASKS = 50_000


@dataclass(frozen=True)
class Compaction:
    """Files that were replaced, files that replaced them, and their rows."""

    files: int
    bins: int
    rows: int


NOTHING = Compaction(0, 0, 0)


def journal(target: Target) -> str:
    return f"{target.path.rstrip('/')}_compacting"


def files(spark: SparkSession, target: Target) -> DataFrame:
    """The files of a dataset: ``path, bytes`` and the partition; their content is not read."""
    reader = spark.read.format("binaryFile").option("basePath", target.path).option("pathGlobFilter", "*.parquet")
    slot = [F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.partition_by]
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")]
    return reader.load(target.path).select(*place, *slot)


def pack(listed: DataFrame, slot: tuple[str, ...], goal: int, least: int) -> DataFrame:
    """Files under ``least`` bytes with their ``bin``: ``path, bytes, bin, bins`` and the partition.

    The files of a partition are laid one behind the other and cut every ``goal`` bytes.  A file
    that would be alone in its bin stays as it is.  Rows of the undated
    partition are dealt to its bins by key, so there only a file that is alone in the partition stays.
    """
    own = Window.partitionBy(*slot)
    small = listed.where(F.col("bytes") < least)
    before = F.sum("bytes").over(own.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    cut = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / goal).cast("int"))
    undated = F.col(slot[0]).isNull()
    group = F.when(undated, F.lit(-1)).otherwise(F.col("bin"))
    cut = cut.withColumn("bins", F.max("bin").over(own) + 1).withColumn("_group", group)
    met = cut.withColumn("_files", F.count(F.lit(1)).over(Window.partitionBy(*slot, "_group")))
    return met.where("_files > 1").drop("_files", "_group")


def _rows(spark: SparkSession, target: Target, plan: DataFrame, least: int) -> DataFrame:
    """The rows of the planned files with their bin, and all columns that these files have."""
    slots = [tuple(r) for r in plan.select(*target.partition_by).distinct().collect()]  # one per month
    reader = spark.read.option("mergeSchema", "true").option("basePath", target.path)
    # Other files of the same folders are left out of the scan by their size.
    found = reader.parquet(*[target.folder(s) for s in slots]).where(F.col("_metadata.file_size") < least)
    for c in target.partition_by:
        found = found.withColumn(c, F.col(c).cast(target.schema[c].dataType))
    rows = found.withColumn("_path", F.col("_metadata.file_path"))
    named = plan.select(F.col("path").alias("_path"), F.col("bin").alias("_file_bin"), F.col("bins").alias("_bins"))
    met = rows.join(named, "_path")
    place = F.col("_file_bin")
    if target.key in found.columns:
        lead = F.conv(F.substring(target.key, 1, KEY_PREFIX), 16, 10).cast("int")
        by_key = F.floor(lead * F.col("_bins") / 16**KEY_PREFIX).cast("int")
        place = F.when(F.col(target.partition_by[0]).isNull(), F.coalesce(by_key, place)).otherwise(place)
    return met.withColumn(BIN, place).drop("_path", "_file_bin", "_bins")


def _print(rows: DataFrame, slot: tuple[str, ...]) -> DataFrame:
    """Rows of each partition as a number and two sums of hashes, whatever their order."""
    own = rows.withColumn("_h", F.xxhash64(*sorted(c for c in rows.columns if c not in (*slot, BIN))))
    return own.groupBy(*slot).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("sum"), F.bit_xor("_h").alias("xor")
    )


def compact(spark: SparkSession, target: Target, goal: int = GOAL, least: int | None = None) -> Compaction:
    """Pack the small files of all partitions into files of about ``goal`` bytes.

    Files under ``least`` bytes (half of ``goal``) are small.  What an earlier run began is finished first.  The streams
    that write the dataset must be stopped; those of this session are looked for.
    """
    if spark.streams.active:
        raise ValueError("stop the streams of this session before its files are packed")
    least = goal // 2 if least is None else least
    finish(spark, target)
    if not path_exists(spark, target.path):
        return NOTHING
    slot, place = target.partition_by, journal(target)
    pack(files(spark, target), slot, goal, least).write.parquet(f"{place}/plan")
    plan = spark.read.schema(_plan_schema(target)).parquet(f"{place}/plan")
    count = plan.count()
    if not count:
        delete_path(spark, place)
        return NOTHING
    bins = plan.select(*slot, "bin").distinct().count()
    rows = _rows(spark, target, plan, least)
    order = [c for c in (*target.sort_by, target.key) if c in rows.columns]
    dealt = rows.repartition(min(bins, MOST_TASKS), *slot, BIN).sortWithinPartitions(*slot, BIN, *order)
    target.writer(dealt, BIN).parquet(f"{place}/files")
    written = spark.read.option("mergeSchema", "true").option("basePath", f"{place}/files").parquet(f"{place}/files")
    for c in slot:
        written = written.withColumn(c, F.col(c).cast(target.schema[c].dataType))
    old, new = _print(rows, slot), _print(written, slot)
    even = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in old.columns]
    both = old.alias("x").join(new.alias("y"), even, "full").select(F.col("x.rows").alias("x"), F.col("y.rows").alias("y"))
    total, odd = both.agg(F.sum("x"), F.count_if(F.col("x").isNull() | F.col("y").isNull())).first()
    if odd:
        raise RuntimeError(f"packed files of {target.path} do not hold the rows of those they replace")
    made = files(spark, Target(f"{place}/files", target.schema, partition_by=slot)).count()
    spark.range(0, 1, 1, 1).select(F.lit(str(total)).alias("value")).write.text(f"{place}/ready")
    finish(spark, target)
    return Compaction(count, made, total)


def _plan_schema(target: Target) -> str:
    slot = ", ".join(f"{c} {target.schema[c].dataType.simpleString()}" for c in target.partition_by)
    return f"path string, bytes bigint, {slot}, bin int, bins int"


def finish(spark: SparkSession, target: Target) -> bool:
    """End what an interrupted run began: forward from its ``ready`` on, back before it.

    True if the dataset was changed.
    """
    place = journal(target)
    if not path_exists(spark, place):
        return False
    forward = path_exists(spark, f"{place}/ready/_SUCCESS")
    if forward:
        swap_in(spark, target)
        drop_old(spark, target)
        delete_path(spark, f"{place}/ready")  # before the rest, which is only read together with it
        if target.table is not None and spark.catalog.tableExists(target.table):
            spark.catalog.refreshTable(target.table)
        spark.catalog.refreshByPath(target.path)
    delete_path(spark, place)
    return forward


def swap_in(spark: SparkSession, target: Target) -> int:
    """Move the packed files into their partitions; a file keeps its name, so this can be repeated."""

    def place(folder: str, name: str) -> str:
        head, _, own = folder.rpartition("/")
        return f"{target.path.rstrip('/')}/{head}/packed-{own.rpartition('=')[2]}-{name}"

    return move_files(spark, f"{journal(target)}/files", place)


def drop_old(spark: SparkSession, target: Target) -> None:
    """Delete the files of the plan; those that are gone already do not matter."""
    for row in spark.read.parquet(f"{journal(target)}/plan").select("path").toLocalIterator():
        delete_file(spark, row.path)
