"""Events matched to the game state of their time, and what follows from the match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.constants import ACTION, NEW_HAND_ACTION, SHOWDOWN_ACTIONS
from riverdeck.functions.attrs import lenient_int
from riverdeck.operators.events import explode_cards, route
from riverdeck.plans.slices import nearest


def state_asof(events: DataFrame, states: DataFrame) -> DataFrame:
    """Every event of a game with the latest snapshot at or before its block, as `state`
    (null where there is none). `events` needs game_id, height, event_seq; events without a game
    drop out. Of several snapshots of a game in one block, one is chosen by content.

    Only the snapshots' blocks go through the ordered plan; the snapshots join by game and block."""
    payload = [c for c in states.columns if c != "game_id"]
    extra = [c for c in events.columns if c not in ("game_id", "height", "event_seq")]
    one = (states.filter(F.col("game_id").isNotNull()).groupBy("game_id", F.col("as_of_block").alias("_block"))
           .agg(F.max_by(F.struct(*payload), F.xxhash64(*payload)).alias("state")))
    # Snapshots sort before the events of their block.
    marks = states.filter(F.col("game_id").isNotNull()).select(
        "game_id", F.col("as_of_block").alias("height"), F.lit(0).alias("kind"), F.lit(0).alias("event_seq"),
        F.col("as_of_block").alias("_met"),
        *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in extra])
    asked = events.filter(F.col("game_id").isNotNull()).select(
        "game_id", "height", F.lit(1).alias("kind"), "event_seq", F.lit(None).cast("bigint").alias("_met"), *extra)
    placed = nearest(marks.unionByName(asked), ["game_id"], ["height", "kind", "event_seq"], "_met", "_block")
    return placed.filter(F.col("kind") == 1).join(one, ["game_id", "_block"], "left").select(
        "game_id", "height", "event_seq", *extra, "state")


#: What a snapshot must hold for hands and for showdowns, beside its game and block.
HAND_STATE = ["hand_number", "deck"]
SHOWDOWN_STATE = ["hand_number", "round", "community", "players", "winners"]


def _asked(events: DataFrame, *wanted: str) -> DataFrame:
    return (route(events, ACTION)
            .filter(F.col("action").isin(*wanted) & (F.coalesce("game_id", F.lit("")) != ""))
            .select("game_id", "height", "event_seq"))


def new_hand_requests(events: DataFrame) -> DataFrame:
    """Where a new-hand action asks for the snapshot of its time."""
    return _asked(events, NEW_HAND_ACTION)


def showdown_requests(events: DataFrame) -> DataFrame:
    """Where a show, muck or fold asks for the snapshot of its time."""
    return _asked(events, *SHOWDOWN_ACTIONS)


def hands_of(matched: DataFrame, headers: DataFrame) -> DataFrame:
    """new-hand requests with their `state` -> hand rows."""
    return (matched.join(headers, "height", "left")
            .select("height", "event_seq", "game_id",
                    F.coalesce("state.hand_number", F.lit(0)).alias("hand_number"),
                    F.col("height").alias("block_height"),
                    F.coalesce("app_hash", F.lit("")).alias("deck_seed"),
                    F.coalesce("state.deck", F.lit("")).alias("deck"),
                    F.lit("").alias("tx_hash"),
                    F.col("state").isNull().alias("weak")))


def results_of(matched: DataFrame) -> DataFrame:
    """Showdown requests with their `state` -> result rows, where that is a finished showdown."""
    no_cards = F.array().cast("array<string>")
    held = F.flatten(F.transform("state.players", lambda p: F.coalesce(p["holeCards"], no_cards)))
    return (matched
            .filter((F.col("state.round") == "showdown") & (F.size("state.winners") > 0))
            .select("height", "event_seq", "game_id", F.col("state.hand_number").alias("hand_number"),
                    F.col("height").alias("block_height"),
                    F.array_join(F.coalesce("state.community", no_cards), ",").alias("community_cards"),
                    F.array_join(F.coalesce(held, no_cards), ",").alias("revealed_hole_cards"),
                    F.size("state.winners").alias("winner_count")))


def legacy_hands(events: DataFrame, headers: DataFrame, states: DataFrame) -> DataFrame:
    """new-hand actions as hand rows: the block's app hash is the seed; number and deck come
    from the snapshot. Without a snapshot the row is `weak`: hand 0, no deck."""
    return hands_of(state_asof(new_hand_requests(events), states.select("game_id", "as_of_block", *HAND_STATE)), headers)


def showdown_results(events: DataFrame, states: DataFrame) -> DataFrame:
    """Result rows, shaped as `completed_hands`, for show, muck and fold actions that meet a
    finished showdown."""
    return results_of(state_asof(showdown_requests(events), states.select("game_id", "as_of_block", *SHOWDOWN_STATE)))


def showdowns(events: DataFrame, states: DataFrame, dedupe: bool = True) -> DataFrame:
    """Cards revealed at showdowns, one row each. Every trigger of one showdown names the same
    cards; deduped, the first block that showed a card stays (a block has one snapshot)."""
    cards = explode_cards(showdown_results(events, states), "winner_count")
    return first_shown(cards) if dedupe else cards


def first_shown(cards: DataFrame) -> DataFrame:
    """Each revealed card once, at the first block that showed it."""
    return (cards.groupBy("game_id", "hand_number", "card", "card_type", "position")
            .agg(F.min("block_height").alias("block_height"),
                 F.min_by("winner_count", "block_height").alias("winner_count"))
            .select(*cards.columns))


def biggest_pot(states: DataFrame) -> DataFrame:
    """Largest single win of every address over all snapshots."""
    return (states.select(F.explode("winners").alias("w"))
            .filter(F.coalesce("w.address", F.lit("")) != "")
            .groupBy(F.col("w.address").alias("player_address"))
            .agg(F.max(lenient_int(F.col("w.amount"))).alias("biggest_pot_won")))
