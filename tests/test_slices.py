"""Ordered plans that must not depend on how a key is spread over slices."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riverdeck.plans import slices
from riverdeck.operators.lookup import scan_gap_ranges, scan_gaps
from riverdeck.plans.slices import gaps, global_rank, islands, nearest
from riverdeck.session import pinned, scratch_root, scratch_scope


@pytest.fixture(params=[3, 50, slices.SPAN], autouse=True)
def span(request, monkeypatch):
    """Keys cut into many spans, a few, and one."""
    monkeypatch.setattr(slices, "SPAN", request.param)


def skewed_rows(count, hot_share=0.5, seed=0):
    """(key, position, value or null): one key holds `hot_share` of the rows."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot_share else f"k{rng.randint(0, 9)}", i,
             i if rng.random() < 0.05 else None) for i in range(count)]


def walked(rows, following):
    last, out = {}, {}
    for key, at, value in (reversed(rows) if following else rows):
        if value is not None:
            last[key] = value
        out[at] = last.get(key)
    return out


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("hot_share", [0.0, 0.5, 1.0])
def test_nearest_crosses_slices(spark, following, hot_share):
    rows = skewed_rows(400, hot_share)
    frame = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    found = {r["at"]: r.found for r in nearest(frame, ["k"], ["at"], "v", "found", following).collect()}
    assert found == walked(rows, following)


def test_nearest_carries_over_slices_without_values(spark):
    frame = spark.createDataFrame([("k", i, 7 if i == 3 else None) for i in range(500)], "k string, at int, v int")
    found = {r["at"]: r.found for r in nearest(frame, ["k"], ["at"], "v", "found").collect()}
    assert found == {i: 7 if i >= 3 else None for i in range(500)}


@pytest.mark.parametrize("values", ["few", "one", "many"])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_global_rank_equals_window_rank(spark, values, keys):
    rng = random.Random(1)
    spread = {"few": 3, "one": 1, "many": 10_000}[values]
    rows = [(f"p{i}", "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 3)}", rng.randint(1, spread))
            for i in range(500)]
    frame = spark.createDataFrame(rows, "id string, k string, v int")
    plain = frame.withColumn("rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("v"))).cast("bigint"))
    assert sorted(map(tuple, global_rank(frame, "v", ["id"], keys).collect())) == sorted(map(tuple, plain.collect()))


def test_spans_meet_at_any_number(spark):
    rows = [("k", at, at if at % 5 == 0 else None) for at in (-11, -10, -1, 0, 1, 2, 9, 10, 11, 500)]
    frame = spark.createDataFrame(rows, "k string, at int, v int")
    for following in (False, True):
        found = {r["at"]: r.found for r in nearest(frame, ["k"], ["at"], "v", "found", following).collect()}
        assert found == walked(rows, following)


def test_nothing_runs_before_an_action(spark):
    frame = spark.createDataFrame(skewed_rows(50), "k string, at int, v int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "nearest")
    nearest(frame, ["k"], ["at"], "v", "found")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getJobIdsForGroup("building") == []


def test_empty_input(spark):
    none = spark.createDataFrame([], "k string, at int, v int")
    assert nearest(none, ["k"], ["at"], "v", "found").count() == 0
    assert global_rank(none, "at", ["k"]).count() == 0


def test_scope_removes_its_scratch_data(spark):
    with scratch_scope(spark) as path:
        kept = pinned(spark.range(3))
        assert kept.count() == 3 and os.path.isdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("seed", range(3))
def test_islands_and_gaps(spark, seed):
    rng = random.Random(seed)
    starts = [rng.randint(0, 3000) for _ in range(40)]
    present = sorted({at for start in starts for at in range(start, start + rng.randint(1, 30))})
    frame = spark.createDataFrame([(at,) for at in [*present, *present[::7]]], "height bigint").repartition(5)
    runs = sorted(map(tuple, islands(frame, "height").collect()))
    assert [at for lo, hi in runs for at in range(lo, hi + 1)] == present
    missing = sorted(set(range(present[0], present[-1] + 1)) - set(present))
    found = sorted(map(tuple, gaps(frame, "height").collect()))
    assert [at for lo, hi in found for at in range(lo, hi + 1)] == missing
    assert all(b[0] > a[1] + 1 for a, b in zip(found, found[1:]))  # whole gaps, not pieces
    wanted = [at for at in range(100, 3500) if at not in set(present)]
    assert sorted(r[0] for r in scan_gaps(frame, 100, 3499, width=11).collect()) == wanted


def test_gap_ranges_at_the_ends(spark):
    heights = spark.createDataFrame([(h,) for h in (5, 6, 9)], "height bigint")
    ranges = lambda frame=heights, **kw: sorted(map(tuple, scan_gap_ranges(frame, **kw).collect()))
    assert ranges() == [(7, 8)] and ranges(start=1) == [(1, 4), (7, 8)] and ranges(end=20) == [(7, 8), (10, 20)]
    assert ranges(start=6, end=8) == [(7, 8)] and ranges(start=9, end=2) == [] and ranges(start=10, end=12) == [(10, 12)]
    empty = heights.limit(0)
    assert ranges(empty) == [] and ranges(empty, start=3) == [] and ranges(empty, start=3, end=4) == [(3, 4)]
    assert ranges(start=1, end=10 ** 12) == [(1, 4), (7, 8), (10, 10 ** 12)]  # as many rows as gaps
