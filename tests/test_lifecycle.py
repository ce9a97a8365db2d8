"""Templates that come later, released messages, and balances between the layers."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators import reports
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import merge_insert
from tidegate.plans.queries import KNOWN_ASSETS
from tidegate.storage import children
from tidegate.streaming import ingest, rejects
from tidegate.streaming.ingest import bronze_target, silver_target, start_silver_single
from tidegate.streaming.runner import ONCE, run_for

SF = "/root/testdata/sf0.001"
LOADED = "2024-09-01 00:00:00"
TEMPLATES = fx.event_templates()
SOME = {a: TEMPLATES[a] for a in KNOWN_ASSETS}


@pytest.fixture(scope="module")
def raw(spark):
    df = fx.event_raw(spark, SF).cache()
    yield df
    df.unpersist()


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def places(spark, layout) -> Counter:
    """Every message with where it is."""
    found = rejects.current(spark, layout).select("rowhash", "reason")
    for t in TEMPLATES.values():
        found = found.unionByName(silver_target(layout, t).read(spark).select("rowhash", F.lit("silver").alias("reason")))
    return rows(found)


@pytest.fixture(scope="module")
def known_from_the_start(spark, raw, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("start")))
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, TEMPLATES, trigger=ONCE))
    return places(spark, layout)


@pytest.fixture
def later(spark, raw, folder):
    """A lake whose first run did not know all templates."""
    layout = Layout(folder)
    merge_insert(to_bronze(raw, LOADED), bronze_target(layout))
    run_for(start_silver_single(spark, layout, SOME, trigger=ONCE))
    return layout


def test_release(spark, later, known_from_the_start):
    before = rejects.current(spark, later).where("reason = 'unknown_template'")
    new = before.where("templateName = 'purchase'").count()
    stats = rejects.release(spark, later, TEMPLATES)
    assert set(stats) == {"purchase"} and 0 < stats["purchase"].inserted < new  # some have no telemetry
    assert places(spark, later) == known_from_the_start
    assert rejects.release(spark, later, TEMPLATES) == {}
    assert places(spark, later) == known_from_the_start
    assert len(children(spark, later.quarantine("silver_superseded"))) == 1


def test_release_cut_off(spark, later, known_from_the_start, monkeypatch):
    """Silver is filled, the marks are not written: the next release does it all again."""

    def cut(*args):
        raise RuntimeError("cut off")

    monkeypatch.setattr(rejects, "write_batch_folder", cut)
    with pytest.raises(RuntimeError):
        rejects.release(spark, later, TEMPLATES)
    monkeypatch.undo()
    assert rejects.release(spark, later, TEMPLATES)["purchase"].inserted == 0
    assert places(spark, later) == known_from_the_start


def test_release_without_quarantine(spark, folder):
    assert rejects.release(spark, Layout(folder), TEMPLATES) == {}
    assert rejects.current(spark, Layout(folder)).count() == 0


def test_template_joins_the_single_stream(spark, raw, later, known_from_the_start):
    more = raw.limit(0).unionByName(raw.where("body is not null").withColumn("body", F.regexp_replace("body", '"value":', '"value":1')))
    merge_insert(to_bronze(more, LOADED), bronze_target(later))
    run_for(start_silver_single(spark, later, TEMPLATES, trigger=ONCE))
    found = places(spark, later)
    assert not known_from_the_start - found
    assert max(found.values()) == 1
    # It has a mark now and is not filled again.
    assert ingest.adopt(spark, later, TEMPLATES) == []


def test_template_joins_and_the_run_dies(spark, later, known_from_the_start, monkeypatch):
    def cut(*args):
        raise RuntimeError("cut off")

    monkeypatch.setattr(rejects, "release", cut)
    with pytest.raises(RuntimeError):
        start_silver_single(spark, later, TEMPLATES, trigger=ONCE)
    monkeypatch.undo()
    assert "purchase" not in children(spark, later.checkpoint("silver_single_templates"))
    run_for(start_silver_single(spark, later, TEMPLATES, trigger=ONCE))
    assert places(spark, later) == known_from_the_start


def test_balance_shows_what_is_lost_or_doubled(spark, raw, folder):
    received = to_bronze(raw, LOADED)
    target = bronze_target(Layout(folder))
    merge_insert(received, target)
    bronze = target.read(spark)

    def uneven(df) -> int:
        found = reports.received_balance(received, df)
        return found.where("rows_left <> 0 or sum_left <> 0 or xor_left <> 0").count()

    assert uneven(bronze) == 0
    some = bronze.where("templateName = 'view' and yearDevice is not null").orderBy("rowhash").limit(2).collect()
    lost = bronze.where(F.col("rowhash") != some[0].rowhash)
    assert uneven(lost) == 1
    doubled = bronze.unionByName(bronze.where(F.col("rowhash") == some[1].rowhash))
    assert uneven(doubled) == 1
    # One lost and another doubled in the same month: the numbers agree, the messages do not.
    changed = bronze.withColumn("rowhash", F.when(F.col("rowhash") == some[0].rowhash, some[1].rowhash).otherwise(F.col("rowhash")))
    assert changed.count() == bronze.count() and uneven(changed) == 1


def test_fingerprint_does_not_mind_order(spark, raw):
    bronze = to_bronze(raw.where("body is not null"), LOADED)
    assert rows(reports.fingerprint(bronze)) == rows(reports.fingerprint(bronze.orderBy(F.rand(1)).repartition(3)))
