from __future__ import annotations

import datetime as dt
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidegate.operators import merge
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import (
    DAY_MICROS,
    MergeSpec,
    _time_ranges,
    first_copy,
    footprint,
    merge_insert,
)
from tidegate import schemas, storage
from tidegate.storage import Target

COMPAT = MergeSpec(mode="compat")
STRICT = MergeSpec()
# The form for batches too large to broadcast, with and without pruning.
LARGE = MergeSpec(broadcast_rows=0)
LARGE_COMPAT = MergeSpec(broadcast_rows=0, mode="compat")
UNPRUNED = MergeSpec(max_days=0, max_months=0)
BY_MONTH = MergeSpec(max_days=0)


def body(name: str) -> str | None:
    """A message whose device month follows from its name; upper case is undated."""
    if name == "-":
        return None
    if name.isupper():
        return f'{{"deviceId":"1-{name}"}}'
    month, day = 1 + ord(name[0]) % 12, 1 + ord(name[0]) % 28
    return f'{{"deviceId":"1-{name}","enqueuedTime":"2024-{month:02d}-{day:02d}T00:00:00Z"}}'


def batch(spark, names, hour=0):
    rows = [(body(n), dt.datetime(2024, 1, 1, hour)) for n in names]
    return to_bronze(spark.createDataFrame(rows, schemas.RAW), "2024-06-01")


def target(folder) -> Target:
    return Target(f"{folder}/bronze", schemas.BRONZE)


def held(spark, where: Target) -> Counter:
    rows = where.read(spark).select("body").collect()
    names = {body(n): n for n in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-"}
    return Counter(names[r.body] for r in rows)


@pytest.mark.parametrize("spec", [COMPAT, LARGE_COMPAT])
def test_compat_compares_with_the_target_only(spark, folder, spec):
    t = target(folder)
    merge_insert(batch(spark, "aa-b"), t, spec)
    assert held(spark, t) == Counter("aa-b")
    stats = merge_insert(batch(spark, "a-cc"), t, spec)
    assert held(spark, t) == Counter("aa-b-cc")
    assert (stats.rows_in, stats.inserted, stats.matched_keys, stats.null_keys) == (4, 3, 1, 1)
    merge_insert(batch(spark, "aa-b"), t, spec)  # a replay adds rows without key only
    assert held(spark, t) == Counter("aa-b-cc-")


@pytest.mark.parametrize("spec", [STRICT, LARGE, UNPRUNED, BY_MONTH])
def test_strict_keeps_one_row_per_key(spark, folder, spec):
    t = target(folder)
    merge_insert(batch(spark, "aa-bX"), t, spec)
    stats = merge_insert(batch(spark, "abb-ccXY"), t, spec)
    assert held(spark, t) == Counter("abcXY")
    assert (stats.rows_in, stats.inserted, stats.matched_keys, stats.null_keys) == (8, 2, 3, 1)
    again = merge_insert(batch(spark, "cXYaab"), t, spec)
    assert again.inserted == 0


def test_empty_batch(spark, folder):
    t = target(folder)
    assert merge_insert(batch(spark, ""), t).rows_in == 0
    assert t.read(spark).count() == 0
    assert merge_insert(batch(spark, ""), t).rows_in == 0
    assert merge_insert(batch(spark, "a-"), t).inserted == 1


def test_earliest_copy_is_kept(spark):
    rows = batch(spark, "ab", 5).unionByName(batch(spark, "a", 2)).unionByName(batch(spark, "ab", 9))
    got = {r.deviceId: r.enqueuedTime.hour for r in first_copy(rows).collect()}
    assert got == {"1-a": 2, "1-b": 5}


def test_earliest_copy_is_taken_whole(spark):
    """Bus columns of one copy, whatever their types; a copy without a time comes last."""
    spec = MergeSpec(key="k", arrival=("at", "offset", "tags"))
    rows = spark.createDataFrame(
        [
            ("x", -0.0, 2, 10, {"a": "late"}),
            ("x", -0.0, 1, 30, {"a": "early"}),
            ("x", -0.0, None, 5, {"a": "untimed"}),
            ("y", None, None, 7, None),
        ],
        "k string, v double, at long, offset long, tags map<string,string>",
    ).withColumn("at", F.timestamp_seconds("at"))
    got = {r.k: r for r in first_copy(rows, spec).collect()}
    assert (got["x"].offset, got["x"].tags) == (30, {"a": "early"})
    assert str(got["x"].v) == "-0.0"
    assert (got["y"].at, got["y"].offset, got["y"].v) == (None, 7, None)
    assert len(got) == 2


@pytest.mark.parametrize("spec", [COMPAT, LARGE_COMPAT])
def test_hot_key_in_a_compat_batch(spark, folder, spec):
    """One key with a third of the rows, present in the target or not."""
    t = target(folder)
    merge_insert(batch(spark, "a"), t, spec)
    merge_insert(batch(spark, "a" * 3000 + "z" * 3000 + "bcd"), t, spec)
    assert held(spark, t) == Counter({"a": 1, "z": 3000, "b": 1, "c": 1, "d": 1})


def test_half_finished_write_is_completed_by_a_replay(spark, folder):
    t = target(folder)
    merge_insert(batch(spark, "abcdefgh"), t)
    lost = sorted(Path(t.path).glob("yearDevice=*/monthDevice=*"))[:3]
    for part in lost:
        part.rename(f"{folder}/lost-{part.name}")
    assert len(held(spark, t)) < 8
    merge_insert(batch(spark, "abcdefgh"), t)
    assert held(spark, t) == Counter("abcdefgh")


names = st.lists(st.sampled_from("abcdeABC-"), max_size=8)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(batches=st.lists(names, min_size=1, max_size=3), spec=st.sampled_from([STRICT, LARGE, BY_MONTH]))
def test_any_split_and_redelivery_gives_the_distinct_set(spark, tmp_path_factory, batches, spec):
    t = target(tmp_path_factory.mktemp("property"))
    for b in [*batches, batches[0]]:
        merge_insert(batch(spark, b), t, spec)
    wanted = {n for b in batches for n in b} - {"-"}
    if wanted:
        assert held(spark, t) == Counter(wanted)


def test_footprint_levels(spark):
    rows = batch(spark, "abcX-")
    by_day, by_month, whole = (footprint(rows, s) for s in (STRICT, BY_MONTH, UNPRUNED))
    assert replace(by_day, slots=set(by_day.slots)) == replace(by_month, slots=set(by_month.slots))
    assert by_day.rows == whole.rows == 5
    assert not by_day.copies and not whole.copies
    for spec in (STRICT, BY_MONTH, UNPRUNED):
        assert footprint(batch(spark, "abcb"), spec).copies
        assert not footprint(batch(spark, "abc--"), spec).copies
        assert footprint(batch(spark, ""), spec).rows == 0
    assert by_day.null_keys == whole.null_keys == 1
    assert set(by_day.slots) == {(2024, 2), (2024, 3), (2024, 4), (None, None)}
    assert len(by_day.ranges) == 3 and by_day.undated
    assert whole.slots is None
    assert not footprint(batch(spark, "abc"), MergeSpec(copies="none")).copies
    compat = footprint(rows, COMPAT)
    assert (compat.rows, set(compat.slots), compat.ranges) == (5, set(by_day.slots), by_day.ranges)


def test_time_ranges():
    day = DAY_MICROS
    spans = [(0, 10), (20, 30), (5 * day, 5 * day + 1), (100 * day, 100 * day)]
    assert _time_ranges(spans, 32) == ((0, 30), (5 * day, 5 * day + 1), (100 * day, 100 * day))
    assert _time_ranges(spans, 2) == ((0, 5 * day + 1), (100 * day, 100 * day))
    assert _time_ranges(spans, 1) == ((0, 100 * day),)
    assert _time_ranges([(0, 100), (1, 2)], 5) == ((0, 100),)
    assert _time_ranges([], 5) == ()


@pytest.mark.parametrize("limits", [{}, {"max_days": 200}, {"max_days": 200, "max_months": 200}])
def test_clocks_that_are_wrong_by_centuries(spark, folder, limits):
    """Device times on 1,500 days of as many months: pruned by day, by month, or not at all."""
    spec = MergeSpec(**{"max_months": 2_000, **limits})
    months = spark.range(1500).selectExpr(
        "concat('{\"enqueuedTime\":\"', date_format(add_months(date'1950-01-05', int(id)), 'yyyy-MM-dd'), "
        "'T00:00:00Z\"}') as body",
        "timestamp'2024-01-01' as enqueuedTime",
    )
    t = target(folder)
    merge_insert(to_bronze(months.limit(1000), "2024-06-01").coalesce(1), t, spec)
    fp = footprint(to_bronze(months, "2024-06-01"), spec)
    assert (fp.slots is None) == ("max_months" in limits)
    assert len(fp.ranges) <= spec.max_ranges
    stats = merge_insert(to_bronze(months, "2024-06-01"), t, spec)
    assert (stats.matched_keys, stats.inserted) == (1000, 500)
    assert t.read(spark).select("rowhash").distinct().count() == 1500


def test_table_target(spark, folder):
    name = "merge_target_" + Path(folder).name.replace("-", "_")
    t = Target(f"{folder}/bronze", schemas.BRONZE, name)
    merge_insert(batch(spark, "ab"), t)
    stats = merge_insert(batch(spark, "bcX"), t)
    assert stats.inserted == 2
    assert held(spark, t) == Counter("abcX")
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("copies", ["expected", "unknown"])
def test_first_load_removes_copies(spark, folder, copies):
    t = target(folder)
    merge_insert(batch(spark, "aabX-X"), t, MergeSpec(copies=copies))
    assert held(spark, t) == Counter("abX")


def test_batches_known_to_be_without_copies(spark, folder):
    t, spec = target(folder), MergeSpec(copies="none")
    merge_insert(batch(spark, "abX-"), t, spec)
    merge_insert(batch(spark, "bcXY-"), t, spec)
    assert held(spark, t) == Counter("abcXY")


def test_unknown_settings():
    for setting in ({"mode": "other"}, {"copies": "other"}):
        with pytest.raises(ValueError):
            MergeSpec(**setting)


@pytest.mark.parametrize("spec", [STRICT, LARGE, UNPRUNED, COMPAT, LARGE_COMPAT])
def test_bodies_are_not_kept_between_the_steps(spark, folder, spec, monkeypatch):
    """A merge keeps keys, times and partitions over its steps: a kept partition with bodies can exceed an executor's memory."""
    kept, keep = [], merge.persisted
    monkeypatch.setattr(merge, "persisted", lambda df: kept.append(df.columns) or keep(df))
    t = target(folder)
    merge_insert(batch(spark, "aab-X"), t, spec)
    stats = merge_insert(batch(spark, "abbc-XY"), t, spec)
    assert (stats.rows_in, stats.matched_keys, stats.null_keys) == (7, 3, 1)
    assert set(held(spark, t)) == set("abcXY") | ({"-"} if spec.mode == "compat" else set())
    assert kept and set().union(*kept) <= {"rowhash", "deviceEnqueuedTime", "yearDevice", "monthDevice"}


@pytest.mark.parametrize("spec", [STRICT, LARGE])
def test_first_load_without_copies_shuffles_no_body_for_them(spark, folder, spec, monkeypatch):
    """Rows are brought together by key only if a look at the keys finds one twice."""
    calls, keep = [], merge.first_copy
    monkeypatch.setattr(merge, "first_copy", lambda *a: calls.append(1) or keep(*a))
    t = target(folder)
    assert merge_insert(batch(spark, "abX--"), t, spec).inserted == 3
    assert held(spark, t) == Counter("abX") and not calls
    other = Target(f"{folder}/other", schemas.BRONZE)
    assert merge_insert(batch(spark, "abbX"), other, spec).inserted == 3
    assert held(spark, other) == Counter("abX") and calls


def test_keys_are_laid_out_as_bytes_and_written_as_they_are(spark, folder):
    """Only lower-case hex digits of even number are packed; any key comes back as it was."""
    keys = ["ab12", "AB12", "abc", "", "zz", "0" * 64, None, "é", " ab"]
    rows = batch(spark, "a").drop("rowhash").crossJoin(spark.createDataFrame([(k,) for k in keys], "rowhash string"))
    packed = storage._packed(rows, "rowhash")
    assert {r[0] for r in packed.select("rowhash").collect()} == {"AB12", "abc", "zz", None, "é", " ab"}
    t = target(folder)
    assert t.append(rows) == len(keys)
    assert Counter(r.rowhash for r in t.read(spark).collect()) == Counter(keys)
