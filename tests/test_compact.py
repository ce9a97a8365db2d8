"""Packing of small files: rows stay, files fall to the bins, and a run may die at any step."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate import fixtures as fx
from tidegate.config import Layout, asset_name
from tidegate.maintenance import compact_layer
from tidegate.operators import compact as packing
from tidegate.operators.bronze import to_bronze
from tidegate.operators.compact import NOTHING, compact, files, finish, journal, pack
from tidegate.operators.merge import merge_insert
from tidegate.sources.replay import bus_stream
from tidegate.storage import path_exists
from tidegate.streaming import rejects
from tidegate.streaming.ingest import bronze_target, silver_target, start_bronze, start_silver_single
from tidegate.streaming.runner import ONCE, run_for

SF = "/root/testdata/sf0.001"
LOADED = "2024-09-01 00:00:00"
BATCHES = 4


class Cut(Exception):
    pass


def fill(spark, target):
    """Bronze in batches, so that each month and the undated slot have several files."""
    raw = fx.event_raw(spark, SF).withColumn("part", F.pmod(F.xxhash64("body"), F.lit(BATCHES)))
    for k in range(BATCHES):
        merge_insert(to_bronze(raw.where(F.col("part") == k).drop("part"), LOADED), target)


def rows(spark, target) -> Counter:
    return Counter(map(tuple, target.read(spark).collect()))


def counts(spark, target) -> Counter:
    return Counter((r.yearDevice, r.monthDevice) for r in files(spark, target).collect())


@pytest.fixture
def target(spark, folder):
    target = bronze_target(Layout(folder))
    fill(spark, target)
    return target


def test_rows_stay_and_files_become_bins(spark, target):
    before, many = rows(spark, target), counts(spark, target)
    assert (None, None) in many and min(many.values()) >= BATCHES
    done = compact(spark, target)
    assert rows(spark, target) == before
    assert counts(spark, target) == Counter(dict.fromkeys(many, 1))
    assert (done.files, done.bins, done.rows) == (sum(many.values()), len(many), sum(before.values()))
    assert not path_exists(spark, journal(target))
    assert compact(spark, target) == NOTHING  # a file alone stays


def test_bins_hold_the_goal(spark, target):
    before = rows(spark, target)
    sizes = sorted(r.bytes for r in files(spark, target).collect())
    goal = 3 * sizes[-1]
    plan = pack(files(spark, target), target.partition_by, goal, sizes[-1] + 1).collect()
    held = Counter()
    for r in plan:
        held[r.yearDevice, r.monthDevice, r.bin] += r.bytes
    assert all(n < goal + sizes[-1] for n in held.values())
    done = compact(spark, target, goal, sizes[-1] + 1)
    assert done.files == len(plan) and rows(spark, target) == before
    # Undated rows lie in ranges of keys: no key's beginning is in two files.
    undated = target.read(spark).where("yearDevice is null")
    by = undated.groupBy(F.substring("rowhash", 1, 2)).agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert by.where("n > 1").isEmpty()


def test_large_files_are_left(spark, target):
    before = {r.path for r in files(spark, target).collect()}
    assert compact(spark, target, goal=2, least=1) == NOTHING
    assert {r.path for r in files(spark, target).collect()} == before


@pytest.mark.parametrize("step", ["rewrite", "verify", "moves", "half_moved", "deletes", "half_deleted", "end"])
def test_cut_off(spark, target, monkeypatch, step):
    before, many = rows(spark, target), counts(spark, target)

    def cut(*_):
        raise Cut

    def half(own, stop):
        def run(*args):
            if half.left <= 0:
                raise Cut
            half.left -= 1
            return own(*args)

        half.left = stop
        return run

    with monkeypatch.context() as m:
        if step == "rewrite":
            m.setattr(type(target), "writer", cut)
        elif step == "verify":
            m.setattr(packing, "_print", cut)
        elif step == "moves":
            m.setattr(packing, "swap_in", cut)
        elif step == "half_moved":
            own = packing.move_files

            def some(spark, source, place):
                todo = half(place, 1)
                return own(spark, source, todo)

            m.setattr(packing, "move_files", some)
        elif step == "deletes":
            m.setattr(packing, "drop_old", cut)
        elif step == "half_deleted":
            m.setattr(packing, "delete_file", half(packing.delete_file, 3))
        else:
            own_delete = packing.delete_path
            m.setattr(packing, "delete_path", lambda s, p: cut() if p == journal(target) else own_delete(s, p))
        with pytest.raises(Cut):
            compact(spark, target)
    left = rows(spark, target)
    assert left.keys() == before.keys()  # nothing is ever missing
    # Files that come after the crash are not touched by what is finished.
    merge_insert(to_bronze(fx.document_raw(spark, SF), LOADED), target)
    added = Counter({r: n for r, n in rows(spark, target).items() if r not in before})
    finish(spark, target)
    assert not path_exists(spark, journal(target))
    assert rows(spark, target) == before + added
    compact(spark, target)
    assert rows(spark, target) == before + added
    assert counts(spark, target) == Counter(dict.fromkeys(many, 1))


def test_rows_that_differ_stop_the_run(spark, target, monkeypatch):
    before = rows(spark, target)
    own = packing._rows
    asked = []

    def less(*args):
        asked.append(own(*args))
        return asked[-1]

    monkeypatch.setattr(packing, "_rows", less)
    first = packing._print
    monkeypatch.setattr(packing, "_print", lambda df, slot: first(df if df is asked[0] else df.limit(3), slot))
    with pytest.raises(RuntimeError, match="do not hold"):
        compact(spark, target)
    finish(spark, target)
    assert rows(spark, target) == before


def test_further_columns_are_kept(spark, folder):
    """Bus columns that this caller does not name are in the files, and stay there."""
    raw = fx.event_raw(spark, SF).withColumn("offset", F.xxhash64("body"))
    wide = to_bronze(raw, LOADED)
    named = bronze_target(Layout(folder), [wide.schema["offset"]])
    for k in range(3):
        merge_insert(wide.where(F.pmod("offset", F.lit(3)) == k), named)
    before = rows(spark, named)
    compact(spark, bronze_target(Layout(folder)))
    assert rows(spark, named) == before and any(r[named.schema.names.index("offset")] for r in before)


def test_table(spark, folder):
    spark.sql(f"CREATE DATABASE packed_db LOCATION '{folder}/db'")
    try:
        target = bronze_target(Layout(folder, "packed_db.bronze"))
        fill(spark, target)
        before = rows(spark, target)
        assert compact(spark, target).bins == len(counts(spark, target))
        assert rows(spark, target) == before
    finally:
        spark.sql("DROP DATABASE packed_db CASCADE")


def test_empty_and_missing(spark, folder):
    assert compact(spark, bronze_target(Layout(folder))) == NOTHING
    assert not finish(spark, bronze_target(Layout(folder)))


def test_streams_go_on_after_bronze_was_packed(spark, folder):
    """The silver stream reads packed rows once more and adds none; the next start of bronze finishes what was cut off."""
    layout, templates = Layout(folder), dict(list(fx.event_templates().items())[:2])
    raw = fx.event_raw(spark, SF)
    for k in range(2):
        raw.where(F.pmod(F.xxhash64("body"), F.lit(2)) == k).write.mode("append").parquet(f"{folder}/raw")
        run_for(start_bronze(bus_stream(spark, f"{folder}/raw"), layout, trigger=ONCE, load_time=LOADED))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    silver = [rows(spark, silver_target(layout, t)) for t in templates.values()]
    left = Counter(r.rowhash for r in rejects.current(spark, layout).collect())
    own = packing.drop_old
    packing.drop_old = lambda *_: (_ for _ in ()).throw(Cut())
    try:
        with pytest.raises(Cut):
            compact(spark, bronze_target(layout))
    finally:
        packing.drop_old = own
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    assert path_exists(spark, journal(bronze_target(layout)))  # bronze is its own writer's
    run_for(start_bronze(bus_stream(spark, f"{folder}/raw"), layout, trigger=ONCE, load_time=LOADED))
    assert not path_exists(spark, journal(bronze_target(layout)))
    run_for(start_silver_single(spark, layout, templates, trigger=ONCE))
    assert [rows(spark, silver_target(layout, t)) for t in templates.values()] == silver
    assert Counter(r.rowhash for r in rejects.current(spark, layout).collect()) == left
    done = compact_layer(spark, layout, "silver")
    assert done.keys() == {asset_name(a) for a in templates}
    assert [rows(spark, silver_target(layout, t)) for t in templates.values()] == silver
