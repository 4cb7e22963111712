"""Player figures refreshed batch by batch equal those of all actions."""

import random

import pytest
from pyspark.sql import functions as F

from riverdeck import schemas
from riverdeck.operators import players as p
from riverdeck.streaming import logs, profiles

SCHEMA = schemas.TABLES["player_actions"]


def made(seed, n):
    """Few players and hands, so that batches cut most hands; numbers at the ends of ranges, nulls everywhere."""
    pick = random.Random(seed)
    numbers = [None, -32769, -32768, -1, 0, 1, 2, 32767, 32768, 32769, 2 ** 31 - 1]
    return [(pick.choice(["a", "b", "c", "d", None]), pick.choice(["g", "h", None]), pick.choice(numbers), pick.choice([None, 5, 9, 70]),
             pick.choice(["bet", "call", "fold", "all-in", "wave", None]), 0, None, None) for _ in range(n)]


def rows_of(frame):
    return sorted(map(str, frame.select(*schemas.PLAYER_TOTALS.names).collect()))


@pytest.mark.parametrize("compacted", [False, True])
def test_any_cut_equals_the_recompute(spark, tmp_path, compacted):
    rows, out = made(1, 300), str(tmp_path / "players")
    cuts = [0, 1, 40, 40, 180, 300]
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        profiles.refresh_players(spark.createDataFrame(rows[low:high], SCHEMA), out, batch)
        expected = p.action_counts(spark.createDataFrame(rows[:high], SCHEMA))
        assert rows_of(profiles.current_action_counts(spark, out)) == rows_of(expected)
        if compacted:
            profiles.compact_players(spark, out)


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    rows, out = made(2, 120), str(tmp_path / "players")
    parts = [spark.createDataFrame(rows[k:k + 40], SCHEMA) for k in (0, 40, 80)]
    for batch, part in enumerate(parts):
        profiles.refresh_players(part, out, batch)
    profiles.compact_players(spark, out)
    profiles.refresh_players(parts[2], out, 2)
    assert rows_of(profiles.current_action_counts(spark, out)) == rows_of(p.action_counts(spark.createDataFrame(rows, SCHEMA)))


def test_a_batch_lost_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    rows, out = made(3, 80), str(tmp_path / "players")
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:40], rows[40:]))
    profiles.refresh_players(first, out, 0)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(logs, "commit", lost)
        with pytest.raises(RuntimeError):
            profiles.refresh_players(second, out, 1)
    assert rows_of(profiles.current_action_counts(spark, out)) == rows_of(p.action_counts(first))
    profiles.refresh_players(second, out, 1)
    assert rows_of(profiles.current_action_counts(spark, out)) == rows_of(p.action_counts(spark.createDataFrame(rows, SCHEMA)))


def test_a_batch_writes_its_own_players_only(spark, tmp_path):
    out = str(tmp_path / "players")
    action = lambda player, hand: (player, "g", hand, 7, "bet", 0, None, None)
    profiles.refresh_players(spark.createDataFrame([action(f"p{k}", k) for k in range(50)], SCHEMA), out, 0)
    profiles.refresh_players(spark.createDataFrame([action("p3", 3), action("p3", 4), action("new", 1)], SCHEMA), out, 1)
    assert {r[0] for r in profiles.touched_players(spark, out, 0).collect()} == {"p3", "new"}
    written = spark.read.parquet(f"{out}/totals").filter(F.col(logs.BATCH) == 1).collect()
    assert {(r.player_address, r.total_actions, r.unique_hands) for r in written} == {("p3", 3, 2), ("new", 1, 1)}


def test_one_player_is_filtered_at_every_scan(spark, tmp_path):
    actions = spark.createDataFrame(made(4, 100), SCHEMA)
    sessions = spark.createDataFrame([("a", "g", 1, 9, 5, 8, 0, None)], schemas.TABLES["player_sessions"])
    for frame, name in ((actions, "actions"), (sessions, "sessions")):
        frame.write.parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in ("actions", "sessions")]
    one = p.player_stats_of("a", *stored)
    assert one.collect() == p.player_stats(*stored).filter("player_address = 'a'").collect() != []
    assert one._jdf.queryExecution().toString().count("EqualTo(player_address,a)") >= 2
    assert p.player_stats_of("nobody", *stored).collect() == []


def test_hands_are_summed_at_fixed_width(spark, tmp_path):
    """Bytes as buffers can't be hashed: each task would sort a bitmap per scattered hand."""
    out = str(tmp_path / "players")
    scattered = spark.createDataFrame([("p", "g", k * 40_000, 7, "bet", 0, None, None) for k in range(60)], SCHEMA)
    profiles.refresh_players(scattered, out, 0)
    profiles.refresh_players(scattered, out, 1)
    stored = logs.read_log(spark, out, "hands", schemas.HAND_BITS)
    assert dict(stored.dtypes)["hands"] == "bigint" and [r.unique_hands for r in profiles.current_action_counts(spark, out).collect()] == [60]
    for summed in (profiles._by_range(scattered), profiles._all_hands(stored)):
        plan = summed._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
