"""Start, time-box and await streaming queries."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

OnBatch = Callable[[DataFrame, int], Any]

ONCE = {"availableNow": True}
POLL_SECONDS = 0.5
GRACE_SECONDS = 600.0


class Drained(Exception):
    """A batch that came after its query was asked to end; it did nothing and comes again."""


class Drain:
    """Lets a query end between two batches.

    Once it is asked to, the next batch waits at its gate, before it has done anything: by then
    the one before is committed.  Released, that batch fails, so its records stay with the source.
    """

    def __init__(self) -> None:
        self._asked = threading.Event()
        self._waiting = threading.Event()
        self._released = threading.Event()

    def guard(self, on_batch: OnBatch) -> OnBatch:
        def guarded(batch: DataFrame, batch_id: int) -> Any:
            if self._asked.is_set():
                self._waiting.set()
                self._released.wait()
                raise Drained(f"batch {batch_id} was not begun")
            return on_batch(batch, batch_id)

        return guarded

    def stop(self, query: StreamingQuery, seconds: float = GRACE_SECONDS) -> bool:
        """Stop between batches; after ``seconds`` stop anyway.  Whether the end was clean."""
        self._asked.set()
        end = time.monotonic() + seconds
        clean = True
        while query.isActive and not self._waiting.is_set() and query.status["isTriggerActive"]:
            if time.monotonic() > end:
                log.warning("stream %s is stopped inside a batch after %s seconds", query.name or query.id, seconds)
                clean = False
                break
            time.sleep(0.05)
        # A batch at the gate must go for the query to end, but not before the query knows that it does.
        release = threading.Timer(0.5, self._released.set)
        release.start()
        try:
            query.stop()
        finally:
            self._released.set()
            release.cancel()
        return clean


_DRAINS: dict[str, Drain] = {}


def stop(query: StreamingQuery, seconds: float = GRACE_SECONDS) -> bool:
    """End a query of ``run_stream`` at a batch boundary; any other at once."""
    drain = _DRAINS.pop(str(query.runId), None)
    if drain is None or not query.isActive:
        query.stop()
        return True
    return drain.stop(query, seconds)


def trigger_of(minutes: float | str | None) -> dict[str, str]:
    """Trigger for a pause in minutes; empty or 0 starts the next batch at once."""
    if minutes in (None, "") or float(minutes) == 0:
        return {"processingTime": "0 seconds"}
    seconds = float(minutes) * 60
    if seconds < 0:
        raise ValueError("the trigger interval must not be negative")
    if seconds % 60 == 0:
        return {"processingTime": f"{int(seconds // 60)} minutes"}
    return {"processingTime": f"{seconds:g} seconds"}


def timeout_seconds(minutes: float | str | None) -> float | None:
    """Job time in seconds; 0, or text that is no number, means no end."""
    try:
        value = float(minutes)
    except (TypeError, ValueError):
        return None
    if value < 0:
        raise ValueError("the job time must not be negative")
    return value * 60 or None


def run_stream(
    df: DataFrame,
    on_batch: OnBatch,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start one query that hands every micro-batch to ``on_batch``.

    ``stop`` lets it finish the batch at work.
    """
    if not df.isStreaming:
        raise ValueError("run_stream needs a streaming DataFrame")
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"partition columns need the session time zone UTC, not {zone}")
    drain = Drain()
    writer = (
        df.writeStream.foreachBatch(drain.guard(on_batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or trigger_of(0)))
    )
    query = (writer.queryName(name) if name else writer).start()
    _DRAINS[str(query.runId)] = drain
    return query


def await_within(queries: dict[str, StreamingQuery], seconds: float | None) -> dict[str, Exception]:
    """Wait for every query until one shared deadline, stop the rest, return failures.

    A failure is logged when it happens; the other queries go on.  At the deadline each
    query finishes the batch it is at, all of them at the same time.
    """
    deadline = None if seconds is None else time.monotonic() + seconds
    errors: dict[str, Exception] = {}
    waiting = dict(queries)
    while waiting:
        for name, query in list(waiting.items()):
            pause = POLL_SECONDS
            if deadline is not None:
                pause = min(pause, deadline - time.monotonic())
                if pause < 0.001:  # Spark's clock counts milliseconds
                    waiting.clear()
                    break
            try:
                if query.awaitTermination(pause):
                    del waiting[name]
            except Exception as e:
                log.error("stream %s failed: %s", name, e)
                errors[name] = e
                del waiting[name]
    with ThreadPoolExecutor(max(1, len(queries))) as pool:
        list(pool.map(stop, queries.values()))
    return errors


def run_for(query: StreamingQuery, seconds: float | None = None) -> float:
    """Await one query at most this long, stop it, and return the seconds it ran."""
    start = time.monotonic()
    errors = await_within({"query": query}, seconds)
    if errors:
        raise errors["query"]
    return time.monotonic() - start
