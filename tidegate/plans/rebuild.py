"""Batch forms of the two layers, from the same transforms as the streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from tidegate.config import Layout
from tidegate.operators.bronze import first_delivery, to_bronze
from tidegate.operators.merge import SILVER_MERGE, MergeSpec, MergeStats, merge_insert
from tidegate.operators.silver import to_silver
from tidegate.sources.templates import Template
from tidegate.streaming.ingest import bronze_target, silver_target


def bronze_of(raw: DataFrame, load_time: Column | datetime | str | None = None) -> DataFrame:
    """Strict bronze of a bounded set of bus records: one row per message."""
    return to_bronze(first_delivery(raw), load_time)


def rebuild_silver(
    spark: SparkSession,
    layout: Layout,
    template: Template,
    into: Layout | None = None,
    spec: MergeSpec = SILVER_MERGE,
) -> MergeStats:
    """Fill one silver dataset from all of bronze, by default in place.

    Merging makes this safe to repeat.  After a type change, give another layout
    in ``into`` and switch readers over when it is complete.
    """
    bronze = bronze_target(layout).read(spark)
    return merge_insert(to_silver(bronze, template), silver_target(into or layout, template), spec)
