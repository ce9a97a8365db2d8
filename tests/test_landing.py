"""Bus columns of files that land: files that differ, and a folder in which nothing has landed."""

from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators.compact import files
from tidegate.sources.replay import bus_stream, landing_schema
from tidegate.streaming.ingest import bronze_target, start_bronze
from tidegate.streaming.runner import ONCE, run_for

SF = "/root/testdata/sf0.001"


def land(spark, folder, **columns):
    raw = fx.event_raw(spark, SF).where("body is not null").limit(20)
    raw.withColumns(columns).coalesce(1).write.mode("append").parquet(f"{folder}/raw")


def test_files_with_different_columns(spark, folder):
    land(spark, folder, partition=F.lit(1))
    land(spark, folder, offset=F.lit(7).cast("long"))
    schema = landing_schema(spark, f"{folder}/raw")
    assert set(schema.names) == {"body", "enqueuedTime", "partition", "offset"}


def test_all_columns_reach_bronze(spark, folder):
    land(spark, folder, partition=F.lit(1))
    land(spark, folder, offset=F.lit(7).cast("long"), rowhash=F.lit("x"))
    schema = landing_schema(spark, f"{folder}/raw")
    layout = Layout(f"{folder}/lake")
    run_for(start_bronze(bus_stream(spark, f"{folder}/raw", schema=schema), layout, trigger=ONCE))
    assert files(spark, bronze_target(layout)).count() > 0
    kept = spark.read.option("mergeSchema", "true").parquet(layout.bronze())
    assert {"partition", "offset"} <= set(kept.columns)
    # A message that both files hold keeps the columns of its earliest copy.
    assert kept.where("partition is not null or offset is not null").count() == kept.count() > 0


def test_types_that_differ_are_refused(spark, folder):
    land(spark, folder, partition=F.lit(1))
    land(spark, folder, partition=F.lit("a"))
    with pytest.raises(Py4JJavaError, match="CANNOT_MERGE_SCHEMAS"):
        landing_schema(spark, f"{folder}/raw")


def test_nothing_landed(spark, folder):
    with pytest.raises(ValueError, match="nothing has landed"):
        landing_schema(spark, f"{folder}/raw")
    assert landing_schema(spark, f"{folder}/raw", "").names == ["body", "enqueuedTime"]
    named = landing_schema(spark, f"{folder}/raw", "partition int, body string, offset bigint")
    assert named.simpleString() == "struct<body:string,enqueuedTime:timestamp,partition:int,offset:bigint>"
