"""Player figures kept current: each batch of actions refreshes the players it names, and no old action is read.

Two logs under one root hold all there is to know of the past. `totals` has a row per player: counts, first and last
block, distinct hands. `hands` says which hands those are: per player, game and range of 64 hand numbers one
64-bit word with a bit per hand, so a player of scattered hands costs a word a hand and no more. A batch is reduced to such
rows, meets the rows of its own keys, and logs both anew; a hand counts where its bit is new, so distinct hands stay
exact however batches cut a hand. All that is summed per range is of fixed width: hashed, never sorted.

A batch that runs again reads only what batches before it left. Actions carry no key, so they should come from the
deduplicated event log. Players, games and hand numbers may be null and count as values of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from riverdeck.operators.players import ACTION_FIGURES, action_figures, player_summary_of
from riverdeck.schemas import HAND_BITS, PLAYER_TOTALS
from riverdeck.session import pinned, scratch_scope
from riverdeck.streaming import logs

PLAYER = ["player_address"]
RANGE = ["player_address", "game_id", "hands_from"]
_WORD = 64  # hand numbers to a row, the bits of a bigint


def _by_range(actions: DataFrame) -> DataFrame:
    """Actions reduced to a row per player, game and range of hands, with the hands' bits. No number has the range
    null and its first bit."""
    number = F.col("hand_number").cast("bigint")
    place = F.coalesce(F.pmod(number, F.lit(_WORD)), F.lit(0)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return actions.withColumns({"hands_from": F.floor(number / _WORD), "_bit": bit}).groupBy(*RANGE).agg(
        *action_figures(), F.bit_or("_bit").alias("hands"))


def _all_hands(rows: DataFrame) -> DataFrame:
    """A row per range with all bits that any version of it holds; versions only ever gain bits."""
    return rows.groupBy(*RANGE).agg(F.bit_or("hands").alias("hands"))


def _known(spark: SparkSession, out: str, name: str, schema, batch_id: int, keys: Sequence[str], asked: DataFrame) -> DataFrame:
    """The logged rows, of batches before this one, of the keys that `asked` holds, with their batch."""
    if not logs.exists(spark, f"{out}/commits"):
        return spark.createDataFrame([], StructType([*schema.fields]).add(logs.BATCH, LongType()))
    wanted = asked.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    met = F.lit(True)
    for key in keys:
        met = met & F.col(key).eqNullSafe(F.col(f"_{key}"))
    rows = logs.read_log(spark, out, name, schema).filter(F.col(logs.BATCH) < batch_id)
    return rows.join(wanted, met, "left_semi")


def _merged(*totals: DataFrame) -> DataFrame:
    rows = totals[0]
    for more in totals[1:]:
        rows = rows.unionByName(more)
    figures = [F.sum(c).alias(c) for c in ACTION_FIGURES]
    return rows.groupBy(*PLAYER).agg(
        *figures, F.sum("unique_hands").alias("unique_hands"),
        F.min("first_block").alias("first_block"), F.max("last_block").alias("last_block"))


def refresh_players(actions: DataFrame, out: str, batch_id: int) -> None:
    """Take up one batch of actions: its players' totals and hands, seen together or not at all."""
    spark = actions.sparkSession
    with scratch_scope(spark):
        fresh = pinned(_by_range(actions), "fresh")
        known = _all_hands(_known(spark, out, "hands", HAND_BITS, batch_id, RANGE, fresh))
        none = F.lit(0).cast("bigint")
        both = fresh.select(*RANGE, "hands", none.alias("held")).unionByName(
            known.select(*RANGE, "hands", F.bit_count("hands").cast("bigint").alias("held")))
        hands = pinned(both.groupBy(*RANGE).agg(F.bit_or("hands").alias("hands"), F.sum("held").alias("held")), "hands")
        acted = fresh.select(*PLAYER, *ACTION_FIGURES, none.alias("unique_hands"), "first_block", "last_block")
        gained = hands.select(
            *PLAYER, *[none.alias(c) for c in ACTION_FIGURES], (F.bit_count("hands") - F.col("held")).alias("unique_hands"),
            *[F.lit(None).cast("bigint").alias(c) for c in ("first_block", "last_block")])
        before = _newest_totals(_known(spark, out, "totals", PLAYER_TOTALS, batch_id, PLAYER, fresh))
        logs.write_batch(_merged(acted, gained, before).select(*PLAYER_TOTALS.names), out, "totals", batch_id)
        logs.write_batch(hands.select(*HAND_BITS.names), out, "hands", batch_id)
        logs.commit(spark, out, batch_id)


def start_players(actions: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Refresh players from a stream of actions."""
    return logs.start(actions.writeStream, lambda batch, batch_id: refresh_players(batch, out, batch_id), checkpoint, trigger)


def _newest_totals(rows: DataFrame) -> DataFrame:
    return logs.latest(rows, PLAYER).select(*PLAYER_TOTALS.names)


def current_action_counts(spark: SparkSession, out: str) -> DataFrame:
    """What `operators.players.action_counts` gives for all actions taken up so far."""
    return _newest_totals(logs.read_log(spark, out, "totals", PLAYER_TOTALS))


def touched_players(spark: SparkSession, out: str, after: int) -> DataFrame:
    """(player_address) of the players that batches after number `after` refreshed."""
    return logs.read_log(spark, out, "totals", PLAYER_TOTALS).filter(F.col(logs.BATCH) > after).select(*PLAYER).distinct()


def current_player_stats(spark: SparkSession, out: str, sessions: DataFrame, monthly: DataFrame | None = None,
                         tiers: DataFrame | None = None, pots: DataFrame | None = None) -> DataFrame:
    """The wide summary, as `operators.players.player_stats` gives it."""
    return player_summary_of(current_action_counts(spark, out), sessions, monthly, tiers, pots)


def compact_players(spark: SparkSession, out: str) -> None:
    """One base per log, with the newest row of each key; a batch that runs again still finds what it needs."""
    logs.compact(spark, out, "totals", PLAYER_TOTALS, _newest_totals)
    logs.compact(spark, out, "hands", HAND_BITS, lambda rows: _all_hands(rows).repartitionByRange(*PLAYER).sortWithinPartitions(*RANGE))
