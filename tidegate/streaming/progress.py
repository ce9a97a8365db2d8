"""What Spark reports of every micro-batch: rows, time, watermark and how far behind its source is."""

from __future__ import annotations

import json
import logging
import threading
import time
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidegate.storage import children, delete_path

log = logging.getLogger(__name__)

SCHEMA = (
    "query string, day string, run string, batch_id bigint, at timestamp, rows_in bigint, rows_per_second double, "
    "batch_ms bigint, planning_ms bigint, source_ms bigint, watermark string, behind bigint, end_offsets string"
)


class ProgressLog(StreamingQueryListener):
    """Keeps one row per batch of every named query until ``flush`` writes them.

    Listeners are told after a batch is committed, in order and apart from the batch itself, so
    nothing here holds a stream up or can fail it.  Batches without any rows are
    left out unless they end a day's silence: Spark reports them every ten seconds.
    """

    def __init__(self) -> None:
        self._rows: list[Row] = []
        self._ended: set[str] = set()
        self._lock = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = _row(json.loads(event.progress.json))
        if row is not None:
            with self._lock:
                self._rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, run: str, seconds: float = 30) -> bool:
        """Wait until all of a stopped query's batches were reported."""
        end = time.monotonic() + seconds
        with self._lock:
            while str(run) not in self._ended and (left := end - time.monotonic()) > 0:
                self._lock.wait(left)
            return str(run) in self._ended

    def flush(self, spark: SparkSession, folder: str) -> int:
        """Add the rows kept so far to the file of their query and day."""
        with self._lock:
            rows, self._rows = self._rows, []
        days = sorted({(r.query, r.day) for r in rows})
        for query, day in days:
            own = spark.createDataFrame([r for r in rows if (r.query, r.day) == (query, day)], SCHEMA)
            _add(spark, f"{folder}/query={query}/day={day}", own.drop("query", "day"))
        return len(rows)


def _row(progress: dict) -> Row | None:
    """One report as a row, None for a query without a name or a batch without rows."""
    if not progress.get("name") or not progress.get("numInputRows"):
        return None
    at = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    spent = progress.get("durationMs") or {}
    sources = progress.get("sources") or []
    # Sources that know how far they are behind say so by these names.
    found = [(s.get("metrics") or {}).get(k) for s in sources for k in ("maxOffsetsBehindLatest", "numFilesOutstanding")]
    behind = [int(float(v)) for v in found if v is not None]
    return Row(
        query=progress["name"],
        day=at.date().isoformat(),
        run=progress["runId"],
        batch_id=progress["batchId"],
        at=at,
        rows_in=progress["numInputRows"],
        rows_per_second=float(progress.get("processedRowsPerSecond") or 0.0),
        batch_ms=spent.get("triggerExecution"),
        planning_ms=spent.get("queryPlanning"),
        source_ms=(spent.get("latestOffset") or 0) + (spent.get("getBatch") or 0),
        watermark=(progress.get("eventTime") or {}).get("watermark"),
        behind=max(behind) if behind else None,
        end_offsets=json.dumps([s.get("endOffset") for s in sources]),
    )


def _add(spark: SparkSession, place: str, rows: DataFrame) -> None:
    """One file per day: the new one holds the old one's rows and is complete before that goes."""
    versions = sorted(int(n.removeprefix("v=")) for n in children(spark, place) if n.startswith("v="))
    paths = [f"{place}/v={v}" for v in versions]
    if paths:
        rows = rows.unionByName(spark.read.schema(rows.schema).json(paths))
    # A day has as many rows as batches.
    rows.coalesce(1).write.json(f"{place}/v={versions[-1] + 1 if versions else 0}")
    for path in paths:
        delete_path(spark, path)


def read(spark: SparkSession, folder: str, days: int | None = None) -> DataFrame:
    """All batches reported, or those of each query's last ``days`` days with any."""
    columns = [part.split()[0] for part in SCHEMA.split(", ")]
    paths = []
    for query in children(spark, folder):
        found = sorted(children(spark, f"{folder}/{query}"))
        paths += [f"{folder}/{query}/{day}" for day in (found if days is None else found[-days:])]
    if not paths:
        return spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
    rows = spark.read.schema(SCHEMA).option("basePath", folder).json(paths).select(*columns)
    # A file that was replaced but not yet deleted holds the same rows.
    return rows.dropDuplicates(["query", "run", "batch_id"])


def by_day(progress: DataFrame) -> DataFrame:
    """Per query and day: batches, rows, the longest batch and the latest watermark."""
    return progress.groupBy("query", "day").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows_in").alias("rows_in"),
        F.max("batch_ms").alias("longest_ms"),
        F.max("watermark").alias("watermark"),
        F.max("behind").alias("behind"),
    )
