"""The monthly tier update as an action on stored tables, exactly once.

Tiers and their history are logs under one root, written by numbered runs: a run writes the players it moved
to both, then its commit row, and readers see committed runs only. So both tables change together or not
at all: a run that is lost between its writes leaves nothing, and its number is written over by the next. A run that
is repeated finds every player at the tier they earn and moves nobody. One update runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck import schemas
from riverdeck.operators.loyalty import month_rake, vip_tier_changes, vip_tier_history
from riverdeck.session import pinned, scratch_scope
from riverdeck.streaming import logs

HISTORY = schemas.TABLES["vip_tier_history"]


def _next_run(spark: SparkSession, root: str) -> int:
    newest = logs.last_commit(spark, root) if logs.exists(spark, f"{root}/commits") else None
    return 0 if newest is None else newest + 1


def _write(spark: SparkSession, root: str, tiers: DataFrame, history: DataFrame) -> int:
    run = _next_run(spark, root)
    logs.write_batch(tiers.select(*schemas.TIERS.names), root, "tiers", run)
    logs.write_batch(history.select(*HISTORY.names), root, "history", run)
    logs.commit(spark, root, run)
    return run


def load_vip_tiers(tiers: DataFrame, root: str) -> int:
    """Put the tiers of (further) players (player_address, vip_tier) under `root`, without history; the run's number."""
    spark = tiers.sparkSession
    return _write(spark, root, tiers, spark.createDataFrame([], HISTORY))


def current_vip_tiers(spark: SparkSession, root: str) -> DataFrame:
    """(player_address, vip_tier) as the last committed run left them."""
    return logs.latest(logs.read_log(spark, root, "tiers", schemas.TIERS), ["player_address"])


def read_vip_history(spark: SparkSession, root: str) -> DataFrame:
    """All changes of committed runs, each with its run as batch_id."""
    return logs.read_log(spark, root, "history", HISTORY)


def update_vip_tiers(spark: SparkSession, root: str, monthly: DataFrame, year: int, month: int,
                     changed_at: str | None = None) -> int | None:
    """Move every player to the tier that the month's rake earns and note the change, stamped now or with the
    given time. Returns the run's number; None where nobody moves and nothing was written."""
    rake = month_rake(monthly, year, month).select("player_address", "current_month_rake")
    held = current_vip_tiers(spark, root).join(rake, "player_address", "left").na.fill(0, ["current_month_rake"])
    with scratch_scope(spark):
        changes = pinned(vip_tier_changes(held), "changes")
        if changes.isEmpty():
            return None
        history = pinned(vip_tier_history(changes, changed_at), "history")
        return _write(spark, root, changes.select("player_address", F.col("new_tier").alias("vip_tier")), history)


def compact_vip_tiers(spark: SparkSession, root: str) -> None:
    """Merge older runs: the newest tier of each player in one base, all changes in another."""
    logs.compact(spark, root, "tiers", schemas.TIERS, lambda rows: logs.latest(rows, ["player_address"]))
    logs.compact(spark, root, "history", HISTORY, lambda rows: rows)
