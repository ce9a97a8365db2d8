"""Copies that arrive soon after one another go before the merge, by the stream's own state (off by default).

The merge drops every copy anyway, whatever its age, but reads the keys of the months a batch touches to
do so.  Where most copies follow within minutes, the state store can drop them first, so that a batch that holds nothing else touches
no history.  The price is one shuffle of the stream's rows and a state of one key per row of the last minutes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.merge import persisted
from tidegate.streaming.runner import OnBatch

SEEN, IDENT = "_seen", "_ident"


def without_recent_copies(
    messages: DataFrame, minutes: float, key: str = "rowhash", time: str = "enqueuedTime", now: Column | None = None
) -> DataFrame:
    """Rows of a stream without those whose key came in the last ``minutes``.

    A watermark drops rows that are later than it, which must not happen here.  So the rows are not dated by
    ``time`` but by that time brought between ``minutes`` ago and now: no row is older than any watermark this makes, late ones and those with
    times to come included, and all go on to the merge.  The watermark stays another ``minutes`` behind, for clocks that are
    set back; so a key leaves the state once rows of three times ``minutes`` later have come, whatever times the rows have.

    Rows without a key are all kept.  Of copies inside one batch any one stays, so it may have
    another arrival than the earliest.  A stream keeps its state from its first run on: Spark lets it neither gain nor lose it.
    """
    if minutes <= 0:
        raise ValueError("the state needs a time above 0")
    span = F.make_dt_interval(mins=F.lit(int(minutes)), secs=F.lit(round(minutes % 1 * 60, 6)).cast("decimal(18,6)"))
    now = F.current_timestamp() if now is None else now
    # least and greatest pass over nulls: a row without a time counts as one of now.
    seen = F.greatest(F.least(F.col(time), now), now - span)
    ident = F.coalesce(F.col(key), F.uuid())
    dated = messages.withColumn(SEEN, seen).withColumn(IDENT, ident).withWatermark(SEEN, f"{2 * minutes * 60:.3f} seconds")
    return dated.dropDuplicatesWithinWatermark([IDENT]).drop(SEEN, IDENT)


def computed_once(on_batch: OnBatch) -> OnBatch:
    """Batch callback over a batch that is kept, as each reading would run the state again; empty batches, which only move the watermark, end here."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as kept:
            if not kept.isEmpty():
                on_batch(kept, batch_id)

    return guarded
