"""Compat batches that are cut off at any step and repeated."""

from __future__ import annotations

from collections import Counter

import pytest

from tidegate import fixtures as fx
from tidegate.config import Layout
from tidegate.operators import merge
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import BRONZE_MERGE, merge_once
from tidegate.sources.replay import between_positions, bus_stream
from tidegate.storage import Target, children, path_exists
from tidegate.streaming.ingest import bronze_target, start_bronze
from tidegate.streaming.runner import ONCE, run_for

SF = "/root/testdata/sf0.001"
LOADED = "2024-09-01 00:00:00"
COMPAT = BRONZE_MERGE.with_mode("compat")


class Cut(Exception):
    pass


@pytest.fixture(scope="module")
def batches(spark):
    raw = fx.event_raw(spark, SF)
    # Many copies inside each batch, of messages in the target and of others, and rows without a body.
    first = to_bronze(between_positions(raw, end="2024-01-16"), LOADED)
    both = to_bronze(raw.unionByName(raw), LOADED)
    out = [first.cache(), both.cache()]
    yield out
    for df in out:
        df.unpersist()


def bodies(spark, target) -> Counter:
    return Counter(r.body for r in target.read(spark).select("body").collect())


@pytest.fixture(scope="module")
def clean(spark, batches, tmp_path_factory):
    target = bronze_target(Layout(str(tmp_path_factory.mktemp("clean"))))
    stats = [merge_once(df, target, COMPAT, "s", k) for k, df in enumerate(batches)]
    return bodies(spark, target), stats


def test_clean_run_is_the_plain_merge(spark, batches, clean, folder):
    target = bronze_target(Layout(folder))
    stats = [merge.merge_insert(df, target, COMPAT) for df in batches]
    assert (bodies(spark, target), stats) == clean
    assert clean[0][None] > 1 and max(n for b, n in clean[0].items() if b) > 1


@pytest.mark.parametrize("step", ["stage", "note", "moves", "publish", "after"])
def test_cut_off_and_repeated(spark, batches, clean, folder, monkeypatch, step):
    target = bronze_target(Layout(folder))
    own = {name: getattr(Target, name) for name in ("stage", "note", "publish")}

    def cut(name, before):
        def run(self, *args):
            if before:
                raise Cut
            own[name](self, *args)
            raise Cut

        return run

    def half_moved(self, spark, batch, before=None):
        """One file is in its place, then the driver dies."""
        staged = f"{self._staged(batch)}"
        root = next(f for f in children(spark, staged) if "=" in f)
        inner = children(spark, f"{staged}/{root}")[0]
        name = children(spark, f"{staged}/{root}/{inner}")[0]
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(staged).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        goal = hadoop(f"{self.path}/{root}/{inner}/{batch}-{name}")
        fs.mkdirs(goal.getParent())
        fs.rename(hadoop(f"{staged}/{root}/{inner}/{name}"), goal)
        raise Cut

    stats = []
    for k, df in enumerate(batches):
        with monkeypatch.context() as m:
            if step == "moves":
                m.setattr(Target, "publish", half_moved)
            elif step != "after":
                m.setattr(Target, step, cut(step, before=step == "note"))
            try:
                merge_once(df, target, COMPAT, "s", k)
            except Cut:
                pass
        stats.append(merge_once(df, target, COMPAT, "s", k))
        assert merge_once(df, target, COMPAT, "s", k) == stats[-1]  # its commit was lost
    assert (bodies(spark, target), stats) == clean
    assert children(spark, f"{target.path}_staged") == ["s-1.note"]


def test_another_stream_has_its_own_batches(spark, batches, folder):
    target = bronze_target(Layout(folder))
    merge_once(batches[0], target, COMPAT, "s", 0)
    n = sum(bodies(spark, target).values())
    stats = merge_once(batches[0], target, COMPAT, "t", 0)
    assert stats.inserted == stats.null_keys and sum(bodies(spark, target).values()) == n + stats.null_keys


def test_table(spark, batches, clean, folder):
    spark.sql(f"CREATE DATABASE once_db LOCATION '{folder}/db'")
    try:
        target = bronze_target(Layout(folder, "once_db.bronze"))
        for k, df in enumerate(batches):
            merge_once(df, target, COMPAT, "s", k)
        assert bodies(spark, target) == clean[0]
    finally:
        spark.sql("DROP DATABASE once_db CASCADE")


def test_compat_stream_that_lost_its_commit(spark, folder):
    """Bodiless rows have no key; even so a repeated batch adds none."""
    layout = Layout(folder)
    fx.event_raw(spark, SF).write.parquet(f"{folder}/raw")
    run_for(start_bronze(bus_stream(spark, f"{folder}/raw"), layout, "compat", ONCE, LOADED))
    before = bodies(spark, bronze_target(layout))
    commit = f"{layout.checkpoint('bronze')}/commits/0"
    assert path_exists(spark, commit) and before[None] > 0
    path = spark._jvm.org.apache.hadoop.fs.Path(commit)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, False)
    run_for(start_bronze(bus_stream(spark, f"{folder}/raw"), layout, "compat", ONCE, LOADED))
    assert bodies(spark, bronze_target(layout)) == before
