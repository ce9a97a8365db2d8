"""Sources: the message bus (or a file replay of it) and bronze read as a stream."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schemas
from tidegate.storage import Target, children, path_exists

# Without it a file source ignores files that are a week older than its newest one.
MAX_FILE_AGE = "36500d"


def look_back(minutes: float, now: datetime | None = None) -> datetime:
    """Start position: this many minutes ago, as an aware UTC instant."""
    return (now or datetime.now(timezone.utc)) - timedelta(minutes=minutes)


def first_start(spark: SparkSession, folder: str, minutes: float) -> str:
    """Start position of a stream's first run, which later runs keep.

    Were it taken anew at each run, records that arrived during a pause longer than
    the look-back would be skipped although the checkpoint has not passed them.
    """
    kept = spark.read.text(folder).first() if path_exists(spark, folder) else None
    if kept is not None:
        return kept.value
    start = look_back(minutes).isoformat()
    spark.range(0, 1, 1, 1).select(F.lit(start)).write.mode("overwrite").text(folder)
    return start


def instant(moment: datetime | str) -> Column:
    """A literal instant; a datetime without zone is taken as UTC."""
    if isinstance(moment, datetime):
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        micros = (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
        return F.timestamp_micros(F.lit(micros).cast("long"))
    return F.lit(moment).cast("timestamp")


def between_positions(
    raw: DataFrame, start: datetime | str | None = None, end: datetime | str | None = None
) -> DataFrame:
    """Records enqueued from ``start`` to ``end``, both inclusive."""
    if start is not None:
        raw = raw.where(F.col("enqueuedTime") >= instant(start))
    if end is not None:
        raw = raw.where(F.col("enqueuedTime") <= instant(end))
    return raw


def bus_batch(
    spark: SparkSession,
    location: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    schema: T.StructType = schemas.RAW,
) -> DataFrame:
    """Bounded read of replayed bus records."""
    return between_positions(spark.read.schema(schema).parquet(location), start, end)


def landing_schema(spark: SparkSession, location: str, columns: str | None = None) -> T.StructType:
    """Body and enqueued time, and the further bus columns: ``columns`` as DDL, or all those of the files that have landed.

    Files may have different columns, but not one column with two types.  Where nothing has landed the columns
    must be named (an empty text for none), as those of later files would be left out unseen.
    """
    if columns is not None:
        found = T.StructType.fromDDL(columns) if columns.strip() else T.StructType()
    elif children(spark, location):
        found = spark.read.option("mergeSchema", "true").parquet(location).schema
    else:
        raise ValueError(f"nothing has landed in {location}: name its bus columns, or '' for none")
    taken = {n.lower() for n in (*schemas.RAW.names, *schemas.BRONZE.names)}
    return T.StructType([*schemas.RAW, *(f for f in found if f.name.lower() not in taken)])


def bus_stream(
    spark: SparkSession,
    location: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    watermark: str | None = None,
    schema: T.StructType = schemas.RAW,
    archive: str | None = None,
) -> DataFrame:
    """Unbounded read of bus records that land as Parquet files, whatever their age.

    ``schema`` may name further bus columns, such as partition and offset.
    The stream remembers each file it has read while it lies there; with ``archive``
    files are moved to that folder once they are done with.
    ``watermark`` declares a delay on the enqueued time.  Nothing downstream keeps
    state, so it drops no late record; leave it out unless a stateful operator is
    added after this source.
    """
    reader = _limited(spark.readStream.schema(schema), max_files, max_bytes)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = between_positions(reader.parquet(location), start, end)
    return raw if watermark is None else raw.withWatermark("enqueuedTime", watermark)


def kafka_options(
    servers: str,
    topic: str,
    start: datetime | None = None,
    end: datetime | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options for Spark's Kafka source with positions by time.

    Spark takes an end for bounded reads only; end a stream with ``between_positions``.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    for name, moment in (("startingTimestamp", start), ("endingTimestamp", end)):
        if moment is not None:
            options[name] = str(int(moment.timestamp() * 1000))
    if start is not None:
        options["startingOffsetsByTimestampStrategy"] = "latest"
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bus records from Kafka with their bus columns; needs Spark's Kafka package."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(
        F.col("value").alias("body"),
        F.col("timestamp").alias("enqueuedTime"),
        *("key", "topic", "partition", "offset"),
    )


def bronze_stream(
    spark: SparkSession,
    bronze: Target,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Bronze as a stream: all history on a first run, then only new rows."""
    reader = _limited(spark.readStream.schema(bronze.schema), max_files, max_bytes)
    return reader.option("basePath", bronze.path).parquet(bronze.path)


def _limited(reader, max_files: int | None, max_bytes: int | None):
    """Take files of any age and bound a micro-batch.

    Spark takes one bound only, and a number of files wins.
    """
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader
