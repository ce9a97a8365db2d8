"""Catalog lookups and the reset of one layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.config import Layout
from tidegate.operators.compact import GOAL, Compaction, compact
from tidegate.storage import Target, children, delete_path, file_uri, path_exists

LAYERS = ("bronze", "silver")


def list_tables(spark: SparkSession, database: str, containing: str) -> DataFrame:
    """Tables of a database whose name contains the text, matched with case."""
    return (
        spark.sql(f"SHOW TABLES IN {database}")
        .where(~F.col("isTemporary") & F.contains(F.col("tableName"), F.lit(containing)))
        .select("namespace", "tableName")
    )


@dataclass(frozen=True)
class Reset:
    """What a reset removes, or removed."""

    tables: tuple[str, ...]
    paths: tuple[str, ...]
    dry_run: bool


def _layer_tables(spark: SparkSession, layout: Layout, layer: str) -> list[str]:
    name = layout.bronze_table if layer == "bronze" else layout.silver_table
    if name is None:
        return []
    database, _, base = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    base = base.lower()
    # The catalog listing is metadata: one row per template.
    names = [r.tableName for r in list_tables(spark, database, base).collect()]
    wanted = (n for n in names if n == base or (layer == "silver" and n.startswith(f"{base}_")))
    home = layout.bronze() if layer == "bronze" else layout.silver()
    tables = [f"{database}.{n}" for n in sorted(wanted)]
    return [t for t in tables if _lies_in(spark, t, home)]


def _lies_in(spark: SparkSession, table: str, folder: str) -> bool:
    """Whether a table's data is the folder or in it: its name alone does not make it ours."""
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    # A column may have that name too; the table's own facts come last.
    places = [r.data_type for r in facts.collect()]
    home = file_uri(spark, folder).rstrip("/")
    return bool(places) and f"{file_uri(spark, places[-1]).rstrip('/')}/".startswith(f"{home}/")


def reset_layer(
    spark: SparkSession, layout: Layout, layer: str, dry_run: bool = True
) -> Reset:
    """Drop the tables of one layer and delete its data, checkpoints, rejects and metrics.

    Only lists them unless ``dry_run`` is False.  Everything deleted lies under the
    layout's own root.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    if not layout.root.strip("/") or layout.root.rstrip("/").endswith(":"):
        raise ValueError("refusing to reset a layout at the root of a file system")
    folders = {
        "bronze": [
            layout.bronze(),
            *[f"{layout.bronze()}_{own}" for own in ("staged", "compacting")],
            *[layout.checkpoint("bronze"), layout.start("bronze"), layout.summaries("bronze")],
        ],
        "silver": [
            layout.silver(),
            *[layout.checkpoint(c) for c in ("silver", "silver_single", "silver_single_templates", "quarantine")],
            layout.quarantine("silver_superseded"),
        ],
    }[layer] + [layout.quarantine(layer)]
    for place in (layout.metrics(), f"{layout.metrics()}_rolled"):
        for name in sorted(children(spark, place)):
            if (name == "target=bronze") == (layer == "bronze"):
                folders.append(f"{place}/{name}")
    paths = tuple(p for p in folders if path_exists(spark, p))
    tables = tuple(_layer_tables(spark, layout, layer))
    if not dry_run:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in paths:
            delete_path(spark, path)
    return Reset(tables, paths, dry_run)


def compact_layer(spark: SparkSession, layout: Layout, layer: str, goal: int = GOAL) -> dict[str, Compaction]:
    """Pack the small files of bronze, or of every silver dataset; the layer's streams must be stopped.

    The datasets are those that exist, so their templates need not be known.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    if layer == "bronze":
        target = Target(layout.bronze(), schemas.BRONZE, layout.bronze_table, sort_by=("templateName", "deviceEnqueuedTime"))
        return {"bronze": compact(spark, target, goal)}
    done = {}
    for name in sorted(children(spark, layout.silver())):
        if name.endswith(("_staged", "_compacting")):
            continue
        # Partitions and the sort order are all that is needed of a template's schema.
        target = Target(layout.silver(name), schemas.BRONZE, layout.silver_table_of(name), sort_by=("Device_EnqueuedTime",))
        done[name] = compact(spark, target, goal)
    return done
