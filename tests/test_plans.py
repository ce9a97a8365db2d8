"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import (
    MergeSpec,
    first_copy,
    footprint,
    history_keys,
    matched_keys,
    merge_insert,
    without,
)
from tidegate.operators.silver import silver_of_all, to_silver
from tidegate.plans.rebuild import bronze_of
from tidegate.sources.replay import between_positions, bronze_stream
from tidegate.sources.templates import template
from tidegate.storage import Target
from tidegate.streaming.ingest import bronze_target

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Line items in bronze, and a batch of some of its months."""
    target = bronze_target(Layout(str(tmp_path_factory.mktemp("plans"))))
    raw = fx.line_raw(spark, SF)
    merge_insert(to_bronze(raw), target)
    batch = to_bronze(between_positions(raw, "1997-03-01", "1997-04-10"))
    batch.write.parquet(f"{target.path}-batch")
    return target, spark.read.parquet(f"{target.path}-batch")


def test_bronze_parses_once(spark):
    assert plan(to_bronze(fx.line_raw(spark, SF))).count("from_json") == 1
    batch = bronze_of(fx.line_raw(spark, SF))
    assert batch._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_silver_parses_once_and_pushes_the_template_down(spark, lake):
    text = plan(to_silver(lake[0].read(spark), fx.line_templates()["Line A"]))
    assert text.count("from_json") == 1
    assert "EqualTo(templateName,Line A)" in text
    assert "iothub-creation-time-utc" not in text
    assert "Exchange" not in text


def test_templates_with_the_same_fields_take_one_pass(spark, lake):
    """Rows are those of each template by itself; bodies are parsed once for all templates alike."""
    bronze = lake[0].read(spark)
    templates = [*fx.line_templates().values()]
    both = silver_of_all(bronze, templates)
    text = plan(both)
    assert "Union" not in text and text.count("from_json") == 1
    alone = reduce(lambda a, b: a.unionByName(b), (to_silver(bronze, t) for t in templates))
    assert both.columns == alone.columns
    assert both.exceptAll(alone).isEmpty() and alone.exceptAll(both).isEmpty()
    other = template("Line R", {"returned": "boolean"})
    mixed = silver_of_all(bronze, [*templates[:2], other])
    assert mixed.count() == alone.count() and mixed.where("templateName = 'Line R' and discount is not null").isEmpty()


def test_history_scan_is_pruned_to_the_key(spark, lake):
    target, batch = lake
    spec = MergeSpec()
    fp = footprint(batch, spec)
    assert set(fp.slots) == {(1997, 3), (1997, 4)}
    text = plan(history_keys(target, batch, fp, spec))
    assert "InMemoryFileIndex(2 paths)" in text
    assert re.search(r"PartitionFilters: \[.*yearDevice", text)
    assert "GreaterThanOrEqual(deviceEnqueuedTime,1997-03-01" in text
    assert "ReadSchema: struct<deviceEnqueuedTime:timestamp,rowhash:string>" in text


def test_undated_messages_are_looked_for_among_the_undated_only(spark, lake):
    target, batch = lake
    undated = to_bronze(batch.selectExpr("concat('x', body) as body", "enqueuedTime"))
    spec = MergeSpec(filter_keys=10)
    both = batch.unionByName(undated)
    fp = footprint(both, spec)
    assert set(fp.slots) == {(1997, 3), (1997, 4), (None, None)} and fp.undated
    merge_insert(undated, target, spec)
    text = plan(history_keys(target, both, fp, spec))
    assert "InMemoryFileIndex(3 paths)" in text
    assert re.search(r"PushedFilters: \[.*IsNull\(deviceEnqueuedTime\),And\(GreaterThanOrEqual", text), text[-900:]


def scanned(df) -> int:
    """Rows that the scan of an executed plan without shuffles gave, after row groups were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_few_undated_keys_read_few_undated_files(spark, tmp_path):
    """A key's files are found by its beginning and by the key filters, not by reading all."""
    target = bronze_target(Layout(str(tmp_path)))
    small = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(k) for k in small}
    for key in small:
        spark.conf.set(key, "100k")
    bodies = spark.range(20_000).selectExpr("concat('no json ', id) as body", "timestamp '2024-01-01' as enqueuedTime")
    merge_insert(to_bronze(bodies), target)
    for key, value in before.items():
        spark.conf.set(key, value)
    files = target.read(spark).inputFiles()
    assert len(files) >= 8
    spec = MergeSpec()
    batch = to_bronze(bodies.limit(1).unionByName(bodies.limit(1).withColumn("body", F.lit("new"))))
    fp = footprint(batch, spec)
    assert fp.slots == ((None, None),) and len(fp.undated_keys) == 2
    history = history_keys(target, batch, fp, spec)
    assert "EqualTo(rowhash," in plan(history)
    assert scanned(history) <= 20_000 * 3 / len(files)
    assert scanned(history_keys(target, batch, replace(fp, undated_keys=None), spec)) == 20_000
    stats = merge_insert(batch, target, spec)
    assert (stats.matched_keys, stats.inserted) == (1, 1)
    assert merge_insert(batch, target, spec).inserted == 0
    many = merge_insert(to_bronze(bodies), target, spec)
    assert (many.matched_keys, many.inserted) == (20_000, 0)


def test_history_of_a_table_is_pruned(spark, lake, tmp_path):
    name = "plans_bronze_table"
    target = Target(str(tmp_path / "bronze"), lake[1].schema, name)
    target.append(lake[0].read(spark))
    spec = MergeSpec()
    text = plan(history_keys(target, lake[1], footprint(lake[1], spec), spec))
    assert re.search(r"PartitionFilters: \[.*yearDevice.*monthDevice", text)
    assert "ReadSchema: struct<deviceEnqueuedTime:timestamp,rowhash:string>" in text
    spark.sql(f"DROP TABLE {name}")


def test_row_groups_outside_the_time_range_are_skipped(spark, lake):
    """Files are written with statistics Spark can filter timestamps on."""
    import pyarrow.parquet as pq
    from pathlib import Path

    file = next(Path(lake[0].path).glob("yearDevice=1997/monthDevice=3/*.parquet"))
    meta = pq.ParquetFile(file).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: i for i in range(meta.num_columns)}
    column = meta.row_group(0).column(columns["deviceEnqueuedTime"])
    assert column.physical_type == "INT64" and column.statistics.has_min_max


def test_small_batch_never_shuffles_history(spark, lake):
    target, batch = lake
    spec = MergeSpec()
    fp = footprint(batch, spec)
    hits = matched_keys(batch, history_keys(target, batch, fp, spec), spec, fp)
    text = plan(hits)
    assert "BroadcastHashJoin [rowhash" in text and "LeftSemi, BuildRight" in text
    # The batch's keys are known to be distinct; the one shuffle is of the keys found.
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text
    fresh = plan(without(batch, hits, spec, 10, fp.rows))
    assert "LeftAnti, BuildRight" in fresh and "SortMergeJoin" not in fresh


def test_large_batch_is_not_broadcast(spark, lake):
    target, batch = lake
    for mode in ("strict", "compat"):
        spec = MergeSpec(broadcast_rows=5, mode=mode)
        fp = footprint(batch, spec)
        hits = matched_keys(batch, history_keys(target, batch, fp, spec), spec, fp)
        assert "Broadcast" not in plan(hits)
        fresh = plan(without(batch, hits, spec, fp.rows, fp.rows))
        assert re.search(r"SortMergeJoin \[rowhash.*Left(Anti|Outer)", fresh)
        assert ("Broadcast" in fresh) == (mode == "compat")  # hot keys only


def test_large_sides_are_distinct_before_they_are_shuffled(spark, lake):
    """No join may be moved below the aggregation that thins out a hot key."""
    target, batch = lake
    spec = MergeSpec(broadcast_rows=5)
    fp = replace(footprint(batch, spec), copies=True)
    hits = matched_keys(batch, history_keys(target, batch, fp, spec), spec, fp)
    joined, _, sides = plan(hits).partition("SortMergeJoin")
    assert "Aggregate" not in joined
    assert sides.count("HashAggregate") == 4 and sides.count("Exchange") == 2
    fresh = plan(without(first_copy(batch, spec), batch.select("rowhash"), spec, fp.rows, fp.rows))
    joined, _, sides = fresh.partition("SortMergeJoin")
    assert "Aggregate" not in joined and sides.count("HashAggregate") == 2


def test_copies_are_dropped_before_the_shuffle(spark, lake):
    text = plan(first_copy(lake[1]))
    assert text.count("HashAggregate") == 2 and "Sort" not in text
    assert text.count("Exchange") == 1


def test_hot_partition_is_split_on_write(spark, lake, tmp_path):
    """Rebalancing lets adaptive execution split a partition with most of the rows."""
    hinted = lake[1].hint("rebalance", "yearDevice", "monthDevice")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)
    target = Target(str(tmp_path / "t"), lake[1].schema)
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "2k")
    try:
        march = lake[1].where("monthDevice = 3")
        target.append(march.unionByName(march).unionByName(march).repartition(8))
    finally:
        spark.conf.set(conf, before)
    assert len(list((tmp_path / "t").glob("yearDevice=1997/monthDevice=3/*.parquet"))) > 1


def test_bronze_stream_reads_all_columns_once(spark, lake):
    stream = bronze_stream(spark, lake[0])
    assert stream.isStreaming and set(stream.columns) == set(lake[0].schema.names)


@pytest.mark.parametrize(
    "name",
    [n for n in contract.queries() if n[:2] in ("f1", "f3", "f4", "f5", "f8", "p5", "p7", "d1", "d2", "d3", "d6")],
)
def test_no_python_in_plans(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for operator in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
