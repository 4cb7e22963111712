"""Final table states as folds over ordered events.

The order of events is (height, event_seq). "First" and "last" columns become min_by / max_by
on that pair, so each fold is an ordinary aggregate: combined before the shuffle, safe for hot
keys, and mergeable across micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.constants import PROGRESS_EVERY
from riverdeck.operators import events as ev
from riverdeck.plans.slices import nearest

HAND_KEY = ["game_id", "hand_number"]


def _arrival() -> Column:
    return F.struct("height", "event_seq")


def fold_hands(started: DataFrame) -> DataFrame:
    """One row per hand: first block, last seed and deck.

    Rows flagged `weak` (hands known without a snapshot) only count where nothing else set the
    seed and deck; among themselves the first wins."""
    at = _arrival()
    first_block = F.min_by("block_height", at).alias("block_height")
    if "weak" not in started.columns:
        return started.groupBy(*HAND_KEY).agg(
            first_block, F.max_by("deck_seed", at).alias("deck_seed"), F.max_by("deck", at).alias("deck"))
    strong, weak = F.when(~F.col("weak"), at), F.when(F.col("weak"), at)
    return started.groupBy(*HAND_KEY).agg(
        first_block,
        *[F.coalesce(F.max_by(c, strong), F.min_by(c, weak)).alias(c) for c in ("deck_seed", "deck")])


def partial_hands(started: DataFrame) -> DataFrame:
    """The fold's mergeable state for one batch of events; `merge_hands` joins many of them."""
    at = _arrival()
    last = F.max_by(F.struct("deck_seed", "deck"), at)
    return started.groupBy(*HAND_KEY).agg(
        F.min(at).alias("first_at"), F.min_by("block_height", at).alias("block_height"),
        F.max(at).alias("last_at"), last["deck_seed"].alias("deck_seed"), last["deck"].alias("deck"))


def merge_hands(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*HAND_KEY).agg(
        F.min_by("block_height", "first_at").alias("block_height"),
        F.max_by("deck_seed", "last_at").alias("deck_seed"), F.max_by("deck", "last_at").alias("deck"))


def merge_hand_partials(partials: DataFrame) -> DataFrame:
    """Partials of one hand as one partial."""
    return partials.groupBy(*HAND_KEY).agg(
        F.min("first_at").alias("first_at"), F.min_by("block_height", "first_at").alias("block_height"),
        F.max("last_at").alias("last_at"), F.max_by("deck_seed", "last_at").alias("deck_seed"),
        F.max_by("deck", "last_at").alias("deck"))


def partial_results(completed: DataFrame) -> DataFrame:
    """The mergeable state of `fold_results` for one batch of events."""
    at = _arrival()
    return completed.groupBy(*HAND_KEY).agg(
        F.min(at).alias("first_at"), F.min_by("block_height", at).alias("block_height"),
        F.max(at).alias("last_at"), F.max_by("community_cards", at).alias("community_cards"),
        F.max_by("winner_count", at).alias("winner_count"))


def merge_result_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*HAND_KEY).agg(
        F.min("first_at").alias("first_at"), F.min_by("block_height", "first_at").alias("block_height"),
        F.max("last_at").alias("last_at"), F.max_by("community_cards", "last_at").alias("community_cards"),
        F.max_by("winner_count", "last_at").alias("winner_count"))


def merged_results(partials: DataFrame) -> DataFrame:
    """Partials as result rows, as `fold_results` gives them."""
    return merge_result_partials(partials).select(
        *HAND_KEY, "block_height", ev.card_list(F.col("community_cards")).alias("community_cards"), "winner_count")


def fold_results(completed: DataFrame) -> DataFrame:
    """One row per hand: first block, last community cards and winner count."""
    at = _arrival()
    return completed.groupBy(*HAND_KEY).agg(
        F.min_by("block_height", at).alias("block_height"),
        ev.card_list(F.max_by("community_cards", at)).alias("community_cards"),
        F.max_by("winner_count", at).alias("winner_count"))


def fold_sessions(moves: DataFrame) -> DataFrame:
    """Sessions from joins and leaves (`session_events`).

    A join opens (player, game, block); another join in that block is ignored. A leave closes
    every session of the player and game still open, so a session ends at the first leave
    after its join. A leave that finds none open does nothing."""
    key = ["player_address", "game_id"]
    leave = F.when(~F.col("is_join"), F.struct("height", "amount"))
    paired = nearest(moves.withColumn("leave", leave), key, ["height", "event_seq"], "leave", "closed",
                     following=True)

    def of_first(value: str, out: str) -> Column:
        return F.min_by(value, "event_seq").alias(out)

    sessions = (paired.filter("is_join")
                .withColumns({"leave_block": F.col("closed.height"), "refund": F.col("closed.amount")})
                .groupBy(*key, F.col("height").alias("join_block"))
                .agg(F.min("event_seq").alias("join_seq"), of_first("leave_block", "leave_block"),
                     of_first("amount", "buy_in_amount"), of_first("refund", "refund")))
    return sessions.select(
        *key, "join_block", "join_seq", "leave_block", "buy_in_amount",
        F.coalesce("refund", F.lit(0)).cast("bigint").alias("cash_out_amount"))


def progress(heights: DataFrame, start: int = 1, every: int = PROGRESS_EVERY) -> DataFrame:
    """One row: the last block scanned at a reporting step, and blocks scanned up to it."""
    last = F.max(F.when(F.col("height") % every == 0, F.col("height")))
    return heights.agg(last.alias("last_scanned_block")).select(
        F.coalesce("last_scanned_block", F.lit(0)).cast("bigint").alias("last_scanned_block"),
        F.coalesce(F.col("last_scanned_block") - start + 1, F.lit(0)).cast("bigint").alias("total_blocks_scanned"))


def dedupe_cards(cards: DataFrame, dedupe: bool = True) -> DataFrame:
    """One row per (hand, card type, position, card): the first one, whole, as a replayed insert leaves it.
    First is lowest block, then lowest of the other columns. `dedupe=False` keeps the rows as they came."""
    if not dedupe:
        return cards
    key = ["game_id", "hand_number", "card_type", "position", "card"]
    rest = ["block_height", *[c for c in cards.columns if c not in (*key, "block_height")]]
    return cards.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*").select(*cards.columns)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """Existing rows plus the incoming ones whose key is new; among several incoming rows of a
    key the first in `order` is inserted."""
    keys = list(keys)
    rest = [c for c in incoming.columns if c not in keys]
    first = (incoming.groupBy(*keys)
             .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*"))
    new = first.join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(new.select(*existing.columns))
