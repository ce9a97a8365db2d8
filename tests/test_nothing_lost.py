"""Messages that earlier forms of the jobs could lose, hide or store twice."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidegate import jobs
from tidegate.config import Layout, asset_name
from tidegate.maintenance import reset_layer
from tidegate.operators import reports
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import merge_insert
from tidegate.sources.replay import bus_stream
from tidegate.sources.templates import template
from tidegate.streaming import metrics
from tidegate.streaming.ingest import bronze_target, start_bronze, start_silver, start_silver_single
from tidegate.streaming.runner import ONCE, run_for

BUS = "body string, enqueuedTime timestamp"


def message(name: str, sent: str = "2024-03-01T00:00:00Z") -> str:
    return f'{{"deviceId":"1-{name}","templateName":"t","enqueuedTime":"{sent}","telemetry":{{"n":1}}}}'


def bus(spark, bodies, at="2024-03-01 00:00:00"):
    return spark.createDataFrame([(b,) for b in bodies], "body string").withColumn(
        "enqueuedTime", F.lit(at).cast("timestamp")
    )


def bodies_of(df) -> list[str]:
    return sorted(r.body for r in df.select("body").collect())


@pytest.fixture
def database(spark, folder) -> str:
    name = "lost_" + Path(folder).name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_table_over_an_existing_folder(spark, folder, database):
    """A name given later, and a dropped table, find the data that is there."""
    first, second, third = ([message(f"{k}{i}") for i in range(20)] for k in "abc")
    undated = [message("u", "soon")]
    merge_insert(to_bronze(bus(spark, first + undated)), bronze_target(Layout(folder)))
    named = bronze_target(Layout(folder, f"{database}.bronze"))
    stats = merge_insert(to_bronze(bus(spark, first[:5] + second)), named)
    assert (stats.matched_keys, stats.inserted) == (5, 20)
    assert bodies_of(named.read(spark)) == sorted(first + undated + second)
    spark.sql(f"DROP TABLE {database}.bronze")
    merge_insert(to_bronze(bus(spark, second[:5] + third)), named)
    assert bodies_of(named.read(spark)) == sorted(first + undated + second + third)


def test_folder_of_another_type_is_refused(spark, folder, database):
    merge_insert(to_bronze(bus(spark, [message("a")])), bronze_target(Layout(folder)))
    named = bronze_target(Layout(folder, f"{database}.bronze"))
    spark.range(1).select(
        F.lit(1).alias("body"), F.lit(2024).alias("yearDevice"), F.lit(1).alias("monthDevice")
    ).write.partitionBy("yearDevice", "monthDevice").parquet(f"{folder}/other")
    other = bronze_target(Layout(folder, f"{database}.other"))
    with pytest.raises(ValueError, match="body as int"):
        type(other)(f"{folder}/other", other.schema, other.table).exists(spark)
    assert named.exists(spark)


def test_files_older_than_a_week_are_read(spark, folder):
    layout, place = Layout(folder), f"{folder}/raw"
    for name, age in (("new", 0), ("old", 30 * 86_400)):
        before = set(Path(place).glob("*.parquet"))
        bus(spark, [message(name)]).coalesce(1).write.mode("append").parquet(place)
        for file in set(Path(place).glob("*.parquet")) - before:
            os.utime(file, (time.time() - age,) * 2)
        run_for(start_bronze(bus_stream(spark, place), layout, trigger=ONCE))
    assert bronze_target(layout).read(spark).count() == 2


def test_first_batch_without_any_body(spark, folder):
    layout, place = Layout(folder), f"{folder}/raw"
    bus(spark, [None] * 5).write.parquet(place)
    run_for(start_bronze(bus_stream(spark, place), layout, trigger=ONCE))
    assert spark.read.parquet(f"{layout.quarantine('bronze')}/*").count() == 5
    row = metrics.read(spark, layout.metrics()).first()
    assert (row.rows_in, row.inserted, row.quarantined) == (5, 0, 5)


def test_time_of_day_is_no_instant(spark, folder):
    """Otherwise its month, and with it the place of the message, depends on the day of the run."""
    texts = ["10:00:00", "T10:00", "10:00Z", "2024", "2024-03", "2024-03-01 10:00", " 2024-03-01", "1700000000"]
    rows = to_bronze(bus(spark, [message("a", t) for t in texts])).collect()
    years = {r.body: r.yearDevice for r in rows}
    assert [years[message("a", t)] for t in texts] == [None, None, None, 2024, 2024, 2024, 2024, 2023]
    target = bronze_target(Layout(folder))
    for _ in range(2):
        merge_insert(to_bronze(bus(spark, [message("a", "10:00:00")])), target)
    assert target.read(spark).count() == 1


def test_stream_forms_do_not_mix(spark, folder):
    layout, templates = Layout(folder), {"t": template("t", {"n": "integer"})}
    merge_insert(to_bronze(bus(spark, [message("a")])), bronze_target(layout))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    with pytest.raises(ValueError, match="other stream form"):
        start_silver(spark, layout, templates, trigger=ONCE)


def test_reset_takes_its_own_metrics_and_tables(spark, folder, database):
    layout = Layout(f"{folder}/lake", f"{database}.bronze", f"{database}.silver")
    place, templates = f"{folder}/raw", {"Pump-2": template("Pump-2", {"n": "integer"})}
    bus(spark, [message("a").replace('"t"', '"Pump-2"')]).write.parquet(place)
    run_for(start_bronze(bus_stream(spark, place), layout, trigger=ONCE))
    start_silver(spark, layout, templates, trigger=ONCE).wait()
    assert spark.table(f"{database}.silver_Pump_2").count() == 1
    spark.sql(f"CREATE TABLE {database}.silver_eu_view (x int) USING parquet LOCATION '{folder}/eu'")
    reset = reset_layer(spark, layout, "silver", dry_run=False)
    assert reset.tables == (f"{database}.silver_pump_2",)
    assert spark.catalog.tableExists(f"{database}.silver_eu_view")
    assert {r.target for r in metrics.read(spark, layout.metrics()).collect()} == {"bronze"}


def test_drift_of_many_templates(spark):
    templates = [template(f"t{i}", {"n": "integer"}) for i in range(2000)] + [template("t", {"m": "integer"})]
    rows = reports.drift(to_bronze(bus(spark, [message("a"), message("b")])), templates).collect()
    assert [tuple(r) for r in rows] == [("t", "n", 2)]


def test_names_hold_what_tables_can():
    assert asset_name("Pump-2 a/b.c") == "Pump_2_a_b_c"


def test_job_keeps_bus_columns_and_drains_once(spark, folder):
    place, root = f"{folder}/raw", f"{folder}/lake"
    now = F.current_timestamp()
    records = bus(spark, [message("a"), message("b")]).withColumn("enqueuedTime", now)
    records = records.withColumn("partition", F.lit(3)).withColumn("offset", F.lit(7))
    late = bus(spark, [message("z")]).withColumn("enqueuedTime", now + F.expr("interval 1 day"))
    records.unionByName(late, allowMissingColumns=True).write.parquet(place)
    end = records.select(F.date_format(now + F.expr("interval 1 hour"), "yyyy-MM-dd HH:mm:ss").alias("t")).first().t
    jobs.main(["bronze", "--root", root, "--source", place, "--once", "--end", end])
    rows = spark.read.parquet(f"{root}/bronze").select("body", "partition", "offset").collect()
    assert sorted(map(tuple, rows)) == [(message("a"), 3, 7), (message("b"), 3, 7)]


def test_kafka_needs_a_topic(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["bronze", "--root", "/x", "--kafka", "h:9092"])
    assert "--topic" in capsys.readouterr().err
