"""Routing decoded events to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.constants import ACTION, HAND_COMPLETED, HAND_STARTED, JOINED, LEFT, ROUTED_TYPES
from riverdeck.functions.attrs import effective_height, lenient_int

_INT_MAX = 2**31 - 1


def route(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("type") == kind)


def event_counts(events: DataFrame) -> DataFrame:
    """Events per routed type; other types are ignored."""
    return events.filter(F.col("type").isin(*ROUTED_TYPES)).groupBy("type").agg(F.count("*").alias("n"))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _whole(name: str) -> Column:
    return lenient_int(F.col(name))


def _fitting(rows: DataFrame, *columns: str) -> DataFrame:
    """Keep rows whose numbers fit a 32-bit column (a wider one fails the event), narrowed."""
    for name in columns:
        rows = rows.filter(F.col(name).between(-_INT_MAX - 1, _INT_MAX)).withColumn(name, F.col(name).cast("int"))
    return rows


def started_hands(events: DataFrame) -> DataFrame:
    """hand_started events as hand rows, with the place they arrived at."""
    rows = route(events, HAND_STARTED).select(
        "height", "event_seq", _text("game_id").alias("game_id"), _whole("hand_number").alias("hand_number"),
        effective_height(F.col("block_height"), F.col("height")).alias("block_height"),
        _text("deck_seed").alias("deck_seed"), _text("deck").alias("deck"))
    return _fitting(rows, "hand_number")


def completed_hands(events: DataFrame) -> DataFrame:
    """hand_completed events as result rows; card lists stay as sent."""
    rows = route(events, HAND_COMPLETED).select(
        "height", "event_seq", _text("game_id").alias("game_id"), _whole("hand_number").alias("hand_number"),
        effective_height(F.col("block_height"), F.col("height")).alias("block_height"),
        _text("community_cards").alias("community_cards"),
        _text("revealed_hole_cards").alias("revealed_hole_cards"), _whole("winner_count").alias("winner_count"))
    return _fitting(rows, "hand_number", "winner_count")


def card_list(text: Column) -> Column:
    """Comma list -> array; no text is no cards. Empty entries keep their place."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def explode_cards(completed: DataFrame, *extra: str) -> DataFrame:
    """One row per revealed card; position is the index in its list, empty entries are skipped.
    `extra` names further columns to keep."""
    lists = F.array(
        F.struct(F.lit("community").alias("card_type"), card_list(F.col("community_cards")).alias("cards")),
        F.struct(F.lit("hole").alias("card_type"), card_list(F.col("revealed_hole_cards")).alias("cards")))
    return (completed
            .select("game_id", "hand_number", "block_height", *extra, F.inline(lists))
            .select("game_id", "hand_number", "block_height", *extra, "card_type",
                    F.posexplode("cards").alias("position", "card"))
            .filter(F.col("card") != "")
            .select("game_id", "hand_number", "block_height", "card", "card_type", "position", *extra))


def actions(events: DataFrame) -> DataFrame:
    """Player actions that name a player and a game."""
    return (route(events, ACTION)
            .filter((F.col("player") != "") & (F.col("game_id") != ""))
            .select(F.col("player").alias("player_address"), "game_id", F.col("height").alias("block_height"),
                    _text("action").alias("action"), _whole("amount").alias("amount")))


def session_events(events: DataFrame) -> DataFrame:
    """Joins and leaves that name a player and a game; amount is buy-in or refund."""
    joined = F.col("type") == JOINED
    return (events.filter(F.col("type").isin(JOINED, LEFT))
            .filter((F.col("player") != "") & (F.col("game_id") != ""))
            .select(F.col("player").alias("player_address"), "game_id", "height", "event_seq",
                    joined.alias("is_join"),
                    F.when(joined, _whole("buy_in_amount")).otherwise(_whole("refund_amount")).alias("amount")))


def dedupe_events(events: DataFrame) -> DataFrame:
    """Drop replayed events. (On a stream `streaming.logs.unseen` does it, without growing state.)"""
    return events.dropDuplicates(["height", "event_seq"])
