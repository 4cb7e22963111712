"""The stored tier update: both tables change together, once."""

import pytest

from riverdeck import tier_runs
from riverdeck.streaming import logs

AT = "2024-03-01 00:00:00"


def rake(spark, **amounts):
    rows = [(p, 2024, 2, a) for p, a in amounts.items()] + [(p, 2024, 1, 10 ** 12) for p in amounts]
    return spark.createDataFrame(rows, "player_address string, year int, month int, rake_contributed bigint")


def tiers(spark, root):
    found = tier_runs.current_vip_tiers(spark, root).collect()
    assert len({r.player_address for r in found}) == len(found)
    return {r.player_address: r.vip_tier for r in found}


def history(spark, root):
    return sorted((r.player_address, r.old_tier, r.new_tier, r.batch_id) for r in tier_runs.read_vip_history(spark, root).collect())


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "tiers")
    held = spark.createDataFrame([("a", "bronze"), ("b", "gold"), ("c", None), ("d", "silver")], "player_address string, vip_tier string")
    assert tier_runs.load_vip_tiers(held, path) == 0
    return path


def test_a_repeated_update_adds_nothing(spark, root):
    month = rake(spark, a=50_000_000, b=0, c=10 ** 10)
    assert tier_runs.update_vip_tiers(spark, root, month, 2024, 2, AT) == 1
    expected = [("a", "bronze", "silver", 1), ("b", "gold", "bronze", 1), ("d", "silver", "bronze", 1)]
    for _ in range(2):
        assert tiers(spark, root) == {"a": "silver", "b": "bronze", "c": None, "d": "bronze"}
        assert history(spark, root) == expected
        assert tier_runs.update_vip_tiers(spark, root, month, 2024, 2, AT) is None
    assert tier_runs.update_vip_tiers(spark, root, rake(spark, a=0, d=2_000_000_000), 2024, 2) == 2
    assert tiers(spark, root) == {"a": "bronze", "b": "bronze", "c": None, "d": "diamond"}
    assert len(history(spark, root)) == 5


@pytest.mark.parametrize("lost_at", ["history", "commits"])
def test_a_lost_run_leaves_neither_table_changed(spark, root, lost_at, monkeypatch):
    month = rake(spark, a=50_000_000)
    write, commit = logs.write_batch, logs.commit

    def lost(*args, **kw):
        if lost_at == "commits" or args[2] == lost_at:
            raise RuntimeError("lost")
        return write(*args, **kw)

    monkeypatch.setattr(logs, "commit" if lost_at == "commits" else "write_batch", lost)
    with pytest.raises(RuntimeError):
        tier_runs.update_vip_tiers(spark, root, month, 2024, 2, AT)
    monkeypatch.setattr(logs, "write_batch", write)
    monkeypatch.setattr(logs, "commit", commit)
    assert tiers(spark, root) == {"a": "bronze", "b": "gold", "c": None, "d": "silver"} and history(spark, root) == []
    assert tier_runs.update_vip_tiers(spark, root, month, 2024, 2, AT) == 1  # the same number, written over
    assert tiers(spark, root)["a"] == "silver" and [h[0] for h in history(spark, root)] == ["a", "b", "d"]


def test_compaction_keeps_tiers_and_history(spark, root):
    for amount in (50_000_000, 200_000_000, 0):
        tier_runs.update_vip_tiers(spark, root, rake(spark, a=amount), 2024, 2, AT)
        before = tiers(spark, root), [h[:3] for h in history(spark, root)]
        tier_runs.compact_vip_tiers(spark, root)
        assert (tiers(spark, root), [h[:3] for h in history(spark, root)]) == before
    assert tier_runs.load_vip_tiers(spark.createDataFrame([("e", "gold")], "player_address string, vip_tier string"), root) == 4
    assert tiers(spark, root)["e"] == "gold" and tiers(spark, root)["a"] == "bronze"
