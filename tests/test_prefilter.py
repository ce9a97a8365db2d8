from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import LOADED, SF, rows, write_files
from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.sources.replay import bus_stream
from tidegate.streaming import metrics
from tidegate.streaming.ingest import bronze_target, start_bronze
from tidegate.streaming.prefilter import computed_once, without_recent_copies
from tidegate.streaming.runner import ONCE, run_for, run_stream

ROW = "rowhash string, enqueuedTime timestamp, clock timestamp"


def run(spark, layout, place, **options):
    stream = bus_stream(spark, place, max_files=1)
    run_for(start_bronze(stream, layout, trigger=ONCE, load_time=LOADED, **options))
    found = metrics.read(spark, layout.metrics()).agg(F.sum("rows_in"), F.sum("inserted"), F.sum("quarantined")).first()
    return rows(bronze_target(layout).read(spark), "loadDatetime", "enqueuedTime"), tuple(found)


def test_same_bronze_fewer_rows(spark, tmp_path):
    """Old, late and future times and rows without body or time: all reach the merge, copies do not."""
    raw = fx.event_raw(spark, SF)
    odd = [("{}", None), ("{}", "2999-01-01 00:00:00"), ('{"a":1}', "1971-01-01 00:00:00"), (None, None), (None, None)]
    odd = spark.createDataFrame(odd, "body string, t string").selectExpr("body", "cast(t as timestamp) as enqueuedTime")
    for part in (raw, odd, raw.where("enqueuedTime < '2024-01-10'"), odd):
        place = write_files(part, str(tmp_path), 1)
    plain, offered = run(spark, Layout(f"{tmp_path}/plain"), place)
    kept, fewer = run(spark, Layout(f"{tmp_path}/kept"), place, recent_minutes=600)
    assert kept == plain
    assert fewer[1:] == offered[1:]
    assert offered[0] > fewer[0] == fewer[1] + fewer[2]  # nothing that reached the merge was known to it


def test_state_is_bounded_and_forgets(spark, tmp_path):
    """Each hour 50 new keys and the one that always comes: with ten minutes the state holds those of the last batches only."""
    sizes, got = [], []

    def on_batch(batch, batch_id):
        got.append(Counter(r["rowhash"] for r in batch.collect()))

    schema = spark.createDataFrame([], ROW).schema
    place = f"{tmp_path}/in"
    for hour in range(6):
        clock = F.expr(f"timestamp'2024-05-01 00:00:00' + interval {hour} hours")
        keys = F.array(F.concat(F.lit(f"k{hour}-"), "id"), F.when(F.col("id") < 3, "always"))
        batch = spark.range(50).select(F.explode(keys).alias("rowhash"), F.timestamp_seconds("id").alias("enqueuedTime"), clock.alias("clock"))
        batch.where("rowhash is not null").repartition(1).write.mode("append").parquet(place)
        stream = without_recent_copies(spark.readStream.schema(schema).parquet(place), 10, now=F.col("clock"))
        query = run_stream(stream, computed_once(on_batch), f"{tmp_path}/checkpoint", ONCE)
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in query.recentProgress)
    assert len(got) == 6 and all(sum(g.values()) - g["always"] == 50 for g in got)
    # The watermark follows the rows: a batch still meets the state of the one before.
    assert [g["always"] for g in got] == [1, 0, 1, 0, 1, 0]
    assert max(sizes) <= 2 * 51


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="strict"):
        start_bronze(fx.event_raw(spark, SF), Layout(str(tmp_path)), mode="compat", recent_minutes=5)
    with pytest.raises(ValueError, match="above 0"):
        without_recent_copies(fx.event_raw(spark, SF), 0, key="body")
