"""Partitioned Parquet datasets, by path or by catalog table, and folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.schemas import PARTITION_COLUMNS

# Row-group statistics exist for this timestamp type but not for Spark's default,
# and the merge relies on them to skip history by device time.
WRITE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

# Messages without a device time are told apart by their key alone.  They are dealt to
# files by this many leading characters of it, and a filter of the keys in each row group
# lets a merge skip the files of other keys.  The filter's size follows the keys.
KEY_PREFIX = 2
SPREAD = "_spread"
PACKED = "_packed"  # a key of hex digits, in half as many bytes

Slot = tuple[int | None, ...]


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def file_uri(spark: SparkSession, path: str) -> str:
    """The file with its scheme, URL-encoded like ``_metadata.file_path``."""
    hadoop, fs = _path(spark, path)
    uri = hadoop.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().toString()
    return re.sub("^file:/+", "file:/", uri)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, without hidden and working files."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop)]
    return [n for n in names if not n.startswith(("_", "."))]


def delete_path(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.delete(hadoop, True)


def delete_file(spark: SparkSession, uri: str) -> bool:
    """Delete one file, named as ``_metadata.file_path`` does."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.delete(hadoop, False)


def move_files(spark: SparkSession, source: str, place: Callable[[str, str], str]) -> int:
    """Move all data files under ``source`` to ``place(folder below it, name)``; without reading them.

    A move that was cut off goes on where it ended, as long as places depend on the names alone.
    """
    if not path_exists(spark, source):
        return 0
    moved = 0
    root, fs = _path(spark, source)
    start = len(fs.makeQualified(root).toString().rstrip("/")) + 1
    files = fs.listFiles(root, True)
    while files.hasNext():
        found = files.next().getPath()
        folder, _, name = found.toString()[start:].rpartition("/")
        if name.startswith(("_", ".")):
            continue
        goal, _ = _path(spark, place(folder, name))
        fs.mkdirs(goal.getParent())
        if not fs.rename(found, goal):
            raise OSError(f"could not move {found} to {goal}")
        moved += 1
    return moved


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach: under ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = os.path.join(tempfile.gettempdir(), "tidegate")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def set_write_conf(spark: SparkSession) -> None:
    """Set the writer's settings on this session (Parquet takes them only from there)."""
    for key, value in WRITE_CONF.items():
        spark.conf.set(key, value)


def observed(observation: Observation) -> dict[str, int] | None:
    """Metrics of a finished action, None if it has none.

    Adaptive execution drops them together with a plan it finds to be empty, so
    nothing may be decided by metrics that are missing.
    """
    try:
        return observation.get or None
    except Py4JJavaError as e:
        if "InterruptedException" in str(e):
            raise
        return None


def write_batch_folder(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write one micro-batch to a folder of its own, so that a replay replaces it."""
    set_write_conf(rows.sparkSession)
    (
        rows.hint("rebalance")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(f"{folder}/batch_id={batch_id}")
    )


def any_of(conditions: Sequence[Column]) -> Column:
    """Their disjunction as a balanced tree, so that a long one does not nest deeply."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """Keys as bytes where these give back the same text: hashes cannot be compressed, so a shuffle of them is half as large."""
    digits = F.unhex(key)
    same = F.lower(F.hex(digits)) == F.col(key)
    return rows.withColumns({PACKED: F.when(same, digits), key: F.when(same, F.lit(None).cast("string")).otherwise(F.col(key))})


def _unpacked(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn(key, F.coalesce(F.lower(F.hex(PACKED)), key)).drop(PACKED)


@dataclass(frozen=True)
class Target:
    """One dataset with one writer.

    With ``table`` set it is an external table of Spark's catalog at ``path``,
    else a plain folder that is always read with ``schema``: files written before
    a column existed give null for it.
    """

    path: str
    schema: T.StructType
    table: str | None = None
    partition_by: tuple[str, ...] = PARTITION_COLUMNS
    sort_by: tuple[str, ...] = ()
    key: str = "rowhash"

    def exists(self, spark: SparkSession) -> bool:
        """Whether there is anything to merge with.

        Data that the catalog does not know (the name was added later, or the table
        was dropped) is registered, never written over.
        """
        if self.table is None:
            return path_exists(spark, self.path)
        if spark.catalog.tableExists(self.table):
            return True
        if not children(spark, self.path):
            return False
        self._register(spark)
        return True

    def _register(self, spark: SparkSession) -> None:
        """Make a table of the files in ``path``, with all columns they have."""
        own = {f.name.lower(): f for f in self.schema}
        by_name = {c.lower() for c in self.partition_by}
        fields = {name: f for name, f in own.items() if name not in by_name}
        for found in spark.read.option("mergeSchema", "true").parquet(self.path).schema:
            name = found.name.lower()
            if name in by_name:
                continue
            if name in own and own[name].dataType != found.dataType:
                raise ValueError(
                    f"{self.path} has {found.name} as {found.dataType.simpleString()}, "
                    f"not {own[name].dataType.simpleString()}: rebuild it before naming it {self.table}"
                )
            fields.setdefault(name, found)
        columns = [*fields.values(), *(self.schema[c] for c in self.partition_by)]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        by = ", ".join(f"`{c}`" for c in self.partition_by)
        place = file_uri(spark, self.path).replace("'", "\\'")
        spark.sql(f"CREATE TABLE {self.table} ({listed}) USING parquet PARTITIONED BY ({by}) LOCATION '{place}'")
        spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def read(self, spark: SparkSession, slots: Sequence[Slot] | None = None) -> DataFrame:
        """The dataset, or only the partitions in ``slots``.

        A folder lists just the partition folders asked for, so reading one month
        does not list years of history; a table gets the same from the catalog.
        """
        if self.table is not None:
            # Another session, such as that of a stream, may have changed it.
            spark.catalog.refreshTable(self.table)
            df = spark.table(self.table)
            return df if slots is None else df.where(self._in_slots(slots))
        reader = spark.read.schema(self.schema).option("basePath", self.path)
        if slots is None:
            return reader.parquet(self.path)
        folders = [f for f in map(self.folder, slots) if path_exists(spark, f)]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return reader.parquet(*folders).where(self._in_slots(slots))

    def append(self, rows: DataFrame) -> int:
        """Write the rows into the dataset and return how many there were."""
        return self._write(rows, self.path, self.table)

    def stage(self, rows: DataFrame, batch: str) -> int:
        """Write the rows of one batch beside the dataset, over what an earlier try left."""
        delete_path(rows.sparkSession, self._staged(batch))
        return self._write(rows, self._staged(batch), None)

    def _staged(self, batch: str = "") -> str:
        return f"{self.path.rstrip('/')}_staged/{batch}".rstrip("/")

    def note(self, spark: SparkSession, batch: str, text: str) -> None:
        """State that a staged batch is complete; the text is kept with it."""
        spark.range(0, 1, 1, 1).select(F.lit(text)).write.mode("overwrite").text(f"{self._staged(batch)}.note")

    def noted(self, spark: SparkSession, batch: str) -> str | None:
        """The text of a batch that was staged completely, published or not."""
        place = f"{self._staged(batch)}.note"
        return spark.read.text(place).first().value if path_exists(spark, f"{place}/_SUCCESS") else None

    def publish(self, spark: SparkSession, batch: str, before: str | None = None) -> int:
        """Move what is left of a staged batch into the dataset; the note of an older batch goes.

        A file keeps its name behind the batch's, so a move that was cut off goes on where it
        ended.  There is one move per file and no reading.
        """
        staged = self._staged(batch)
        moved = 0
        if path_exists(spark, staged):
            home = self.path.rstrip("/")
            moved = move_files(spark, staged, lambda folder, name: f"{home}/{folder}/{batch}-{name}")
            if moved and self.table is not None and self.exists(spark):
                spark.sql(f"MSCK REPAIR TABLE {self.table}")
            delete_path(spark, staged)
        if before is not None:
            delete_path(spark, f"{self._staged(before)}.note")
        return moved

    def _write(self, rows: DataFrame, path: str, table: str | None) -> int:
        """Write the rows as the dataset's files and return how many there were.

        ``rebalance`` gathers each partition into files of the advisory size and
        splits one that holds most of the rows, so neither many small files nor
        one endless task results.  Sorting inside a file keeps the statistics of
        its row groups narrow for template and time filters.  Rows without a
        partition are dealt by the beginning of their key, so a key is in one file
        of each batch, and the other files' key filters rule it out.
        """
        spark = rows.sparkSession
        rows = rows.select(*self.schema.names)
        if self.table is not None:
            rows = self._evolve(spark, rows)
        written = Observation()
        keyed = self.key in rows.columns
        if keyed:
            undated = F.col(self.partition_by[0]).isNull()
            rows = rows.withColumn(SPREAD, F.when(undated, F.substring(self.key, 1, KEY_PREFIX)))
        texts = keyed and isinstance(rows.schema[self.key].dataType, T.StringType)
        laid = _packed(rows, self.key) if texts else rows
        laid = laid.hint("rebalance", *[F.col(c) for c in self.partition_by], *([F.col(SPREAD)] if keyed else []))
        rows = (
            (_unpacked(laid, self.key) if texts else laid)
            .observe(written, F.count(F.lit(1)).alias("rows"))
            .sortWithinPartitions(*self.partition_by, *self.sort_by, *([self.key] if keyed else []))
            .drop(SPREAD)
        )
        writer = self.writer(rows)
        if table is None:
            writer.parquet(path)
        else:
            writer.format("parquet").option("path", path).saveAsTable(table)
        # Without metrics the plan was found to be empty: nothing was written.
        return (observed(written) or {}).get("rows", 0)

    def writer(self, rows: DataFrame, *below: str) -> DataFrameWriter:
        """A writer of the dataset's files, with folders for the columns ``below`` in each partition."""
        set_write_conf(rows.sparkSession)
        writer = rows.write.mode("append").partitionBy(*self.partition_by, *below).option("compression", "zstd")
        if self.key in rows.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        return writer

    def _evolve(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """Add new columns to the table; columns the rows lack are filled with null."""
        if not self.exists(spark):
            return rows
        have = {f.name.lower(): f for f in spark.table(self.table).schema}
        for field in self.schema:
            old = have.get(field.name.lower())
            if old is not None and old.dataType != field.dataType:
                raise ValueError(
                    f"{self.table}.{field.name} is {old.dataType.simpleString()}, "
                    f"not {field.dataType.simpleString()}: rebuild the table from bronze"
                )
        new = [f for f in self.schema if f.name.lower() not in have]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({columns})")
        now = spark.table(self.table).schema
        written = {c.lower() for c in rows.columns}
        return rows.select(
            *[
                F.col(f.name) if f.name.lower() in written else F.lit(None).cast(f.dataType).alias(f.name)
                for f in now
            ]
        )

    def folder(self, slot: Slot) -> str:
        parts = [
            f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}"
            for c, v in zip(self.partition_by, slot)
        ]
        return "/".join([self.path.rstrip("/"), *parts])

    def _in_slots(self, slots: Sequence[Slot]) -> Column:
        """Literal partition predicate; grouped on the last column to stay short."""
        groups: dict[Slot, list[int | None]] = {}
        for slot in slots:
            groups.setdefault(slot[:-1], []).append(slot[-1])
        found = []
        for head, last in groups.items():
            name = F.col(self.partition_by[-1])
            values = [v for v in last if v is not None]
            matches = ([name.isin(values)] if values else []) + ([name.isNull()] if None in last else [])
            each = any_of(matches)
            for column, value in zip(self.partition_by, head):
                each = each & (F.col(column).isNull() if value is None else F.col(column) == value)
            found.append(each)
        return any_of(found)
