"""How the cost of one merge and of the fan-out grows with the history.

    python benchmarks/scaling.py [sf_dir] [copies ...]

History is all line items, each repeated under other order numbers; the batch is
one month of them, half of it already in the history.  Times are of the step that
finds the batch's known keys.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F

import bench
from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import (
    MergeSpec,
    footprint,
    history_keys,
    matched_keys,
    merge_insert,
    persisted,
)
from tidegate.plans.queries import new_layout
from tidegate.sources.replay import between_positions
from tidegate.streaming.ingest import bronze_target, start_silver, start_silver_single
from tidegate.streaming.runner import ONCE, run_for

FORMS = {
    "pruned": MergeSpec(),
    "broadcast, whole history": MergeSpec(max_days=0, max_months=0),
    "shuffle, whole history": MergeSpec(max_days=0, max_months=0, broadcast_rows=0),
}


def repeated(raw, copies: int):
    """Each message ``copies`` times, as messages of different parts."""
    number = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("number")
    text = F.concat(F.lit('"component":"'), F.col("number").cast("string"), F.lit("/"))
    return raw.select("*", number).select(
        F.replace("body", F.lit('"component":"'), text).alias("body"), "enqueuedTime"
    )


def seconds(run) -> float:
    run()
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def merge_cost(spark, raw, copies: int) -> None:
    layout: Layout = new_layout(spark, "scaling")
    target = bronze_target(layout)
    start = time.perf_counter()
    loaded = merge_insert(to_bronze(repeated(raw, copies)), target).inserted
    load = time.perf_counter() - start
    print(f"history {loaded:>10,} rows, loaded at {loaded / load:,.0f} rows/s", flush=True)
    month = between_positions(raw, "1997-03-01", "1997-03-31")
    new = repeated(month, copies + 1).where(F.col("body").contains(f'"{copies + 1}/'))
    known = repeated(month, 1)
    with persisted(to_bronze(known.unionAll(new))) as batch:
        rows = batch.count()
        for name, spec in FORMS.items():
            def find():
                fp = footprint(batch, spec)
                return matched_keys(batch, history_keys(target, batch, fp, spec), spec, fp).count()

            print(f"  batch of {rows:,}, {name}: {seconds(find):.2f} s", flush=True)


def fan_out_cost(spark, raw, templates, copies: int) -> None:
    layout = new_layout(spark, "fanout")
    rows = merge_insert(to_bronze(repeated(raw, copies)), bronze_target(layout)).inserted
    start = time.perf_counter()
    start_silver(spark, layout, templates, trigger=ONCE).wait()
    apart = time.perf_counter() - start
    single = Layout(layout.root + "-single")
    merge_insert(bronze_target(layout).read(spark), bronze_target(single))
    start = time.perf_counter()
    run_for(start_silver_single(spark, single, templates, trigger=ONCE))
    together = time.perf_counter() - start
    print(
        f"fan-out of {rows:,} rows to {len(templates)} templates: "
        f"one stream each {apart:.1f} s, single stream {together:.1f} s",
        flush=True,
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = bench.new_session()
    raw = fx.line_raw(spark, sf_dir)
    for copies in map(int, sys.argv[2:] or (1, 4, 16)):
        merge_cost(spark, raw, copies)
    fan_out_cost(spark, raw, fx.line_templates(), 2)
    fan_out_cost(spark, fx.event_raw(spark, sf_dir), fx.event_templates(), 1)
    spark.stop()


if __name__ == "__main__":
    main()
