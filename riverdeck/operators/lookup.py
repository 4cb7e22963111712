"""Pages, single-key lookups and one-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck.constants import MICRO_UNITS, PAGE_LIMIT
from riverdeck.plans.paging import beside, page, top, top_per_key
from riverdeck.plans.slices import gaps
from riverdeck.sources.tables import newest_part

HAND_KEY = ["game_id", "hand_number"]


def _newest_first() -> list[Column]:
    return [F.desc("block_height"), F.desc("hand_number"), F.asc("game_id")]


def hands_page(hands: DataFrame, game_id: str | None = None, start_block: int = 0, end_block: int = 0,
               limit: int = PAGE_LIMIT, offset: int = 0, with_total: bool = True) -> DataFrame:
    """Hands, newest first. An empty game or a block of 0 or less filters nothing."""
    if game_id:
        hands = hands.filter(F.col("game_id") == game_id)
    if start_block > 0:
        hands = hands.filter(F.col("block_height") >= start_block)
    if end_block > 0:
        hands = hands.filter(F.col("block_height") <= end_block)
    return page(hands, _newest_first(), limit, offset, with_total)


def newest_hands(spark: SparkSession, root: str, end_block: int = 0, limit: int = PAGE_LIMIT, offset: int = 0) -> DataFrame:
    """The page of `hands_page` without a total, from the few files of a stored table (`indexing.write_index`)
    that can hold it; `end_block` as there."""
    part = newest_part(spark, root, "poker_hands", offset + limit, end_block if end_block > 0 else None)
    return hands_page(part, end_block=end_block, limit=limit, offset=offset, with_total=False)


def hands_after(hands: DataFrame, block_height: int, hand_number: int, game_id: str,
                limit: int = PAGE_LIMIT) -> DataFrame:
    """The page that follows a known last row: the same cost at any depth, unlike an offset."""
    block, hand = F.col("block_height"), F.col("hand_number")
    later_game = (hand == hand_number) & (F.col("game_id") > game_id)
    after = (block < block_height) | ((block == block_height) & ((hand < hand_number) | later_game))
    # The first condition alone reaches the scan; the second decides within the block.
    return top(hands.filter(block <= block_height).filter(after), _newest_first(), limit)


def hand_details(hands: DataFrame, results: DataFrame, cards: DataFrame) -> DataFrame:
    """Every hand with its result, if any, and its revealed cards: one row per hand, card type, position
    and card, with the number of times it was revealed; a hand without cards has one row without a card.
    No row grows with the data, whatever a hand was sent."""
    # Placed by hand first: the cards are then counted where they lie, and meet their hand there.
    shown = (cards.select(*HAND_KEY, "card_type", "position", "card").repartition(*HAND_KEY)
             .groupBy(*HAND_KEY, "card_type", "position", "card").agg(F.count("*").alias("times_revealed")))
    outcome = results.select(*HAND_KEY, "community_cards", "winner_count")
    return (hands.join(outcome, HAND_KEY, "left").join(shown, HAND_KEY, "left")
            .select("game_id", "hand_number", "block_height", "deck_seed", "deck", "tx_hash", "indexed_at",
                    F.array_join("community_cards", ",").alias("community_cards"), "winner_count",
                    "card_type", "position", "card", F.coalesce("times_revealed", F.lit(0)).alias("times_revealed")))


def hand_cards(cards: DataFrame, game_id: str, hand_number: int) -> DataFrame:
    """The cards of one hand: hole cards before community cards, each by position."""
    return (cards.filter((F.col("game_id") == game_id) & (F.col("hand_number") == hand_number))
            .select("card", "card_type", "position")
            .orderBy(F.desc("card_type"), F.asc("position"), F.asc("card")))


def recent_actions(actions: DataFrame, player: str | None = None, k: int = 20) -> DataFrame:
    """The last k actions of every player, or of one."""
    if player is not None:
        actions = actions.filter(F.col("player_address") == player)
    newest = [F.desc("block_height"), F.asc("game_id"), F.asc("action"), F.asc("amount"), F.asc("indexed_at")]
    return top_per_key(actions.select("player_address", "game_id", "action", "amount", "block_height", "indexed_at"),
                       ["player_address"], newest, k).drop("game_id")


def recent_sessions(sessions: DataFrame, k: int = 20) -> DataFrame:
    """The last k sessions overall, amounts in whole currency units."""
    def usd(column):
        return column.cast("double") / F.lit(float(MICRO_UNITS))

    latest = top(sessions, [F.desc("join_block"), F.asc("player_address"), F.asc("game_id")], k)
    return latest.select(
        "player_address", "game_id", "join_block", "leave_block",
        usd(F.col("buy_in_amount")).alias("buy_in_usd"), usd(F.col("cash_out_amount")).alias("cash_out_usd"),
        usd(F.col("cash_out_amount") - F.col("buy_in_amount")).alias("profit_usd"))


def _sessions_of(sessions: DataFrame, player: str) -> DataFrame:
    return sessions.filter(F.col("player_address") == player).select(
        "player_address", "game_id", "join_block", "leave_block", "buy_in_amount", "cash_out_amount", "indexed_at")


def sessions_page(sessions: DataFrame, player: str, limit: int = PAGE_LIMIT, offset: int = 0,
                  with_total: bool = True) -> DataFrame:
    """One player's sessions, newest first."""
    return page(_sessions_of(sessions, player), [F.desc("join_block"), F.asc("game_id")], limit, offset, with_total)


def sessions_after(sessions: DataFrame, player: str, join_block: int, game_id: str, limit: int = PAGE_LIMIT) -> DataFrame:
    """The page that follows a known last session of a player: the same cost at any depth."""
    block = F.col("join_block")
    after = (block < join_block) | ((block == join_block) & (F.col("game_id") > game_id))
    return top(_sessions_of(sessions, player).filter(block <= join_block).filter(after),
               [F.desc("join_block"), F.asc("game_id")], limit)


def hand_figures(hands: DataFrame) -> DataFrame:
    """One row. Hands shrink to one row per game before the games are counted."""
    per_game = hands.groupBy("game_id").agg(
        F.count("*").alias("n"), F.min("block_height").alias("lo"), F.max("block_height").alias("hi"),
        F.min("indexed_at").alias("early"), F.max("indexed_at").alias("late"))
    return per_game.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("hands"), F.count("game_id").alias("games"),
        F.min("lo").alias("first_block"), F.max("hi").alias("last_block"),
        F.min("early").alias("first_indexed_at"), F.max("late").alias("last_indexed_at"))


def _all_figures(hands: DataFrame, results: DataFrame, cards: DataFrame) -> DataFrame:
    return beside(hand_figures(hands), results.agg(F.count("*").alias("results")),
                  cards.agg(F.count("*").alias("cards")))


def totals(hands: DataFrame, results: DataFrame, cards: DataFrame) -> DataFrame:
    """One row: hands started and completed, cards revealed, games, block span."""
    return _all_figures(hands, results, cards).select(
        F.col("hands").alias("total_hands_started"), F.col("results").alias("total_hands_completed"),
        F.col("cards").alias("total_cards_revealed"), F.col("games").alias("unique_games"),
        "first_block", "last_block")


def summary_fields() -> list[Column]:
    """The summary over a row of figures (hands, results, cards, games, span and stamps)."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return [F.col("hands").alias("total_hands"), F.col("results").alias("total_completed_hands"),
            F.col("cards").alias("total_revealed_cards"), F.col("games").alias("unique_games"),
            F.concat(shown("first_block"), F.lit("-"), shown("last_block")).alias("block_height_range"),
            F.col("first_indexed_at"), F.col("last_indexed_at")]


def stats_summary(hands: DataFrame, results: DataFrame, cards: DataFrame) -> DataFrame:
    """As `totals`, the span as text, with the first and last ingestion stamps."""
    return _all_figures(hands, results, cards).select(*summary_fields())


def indexing_status(hands: DataFrame, progress: DataFrame, chain_height: int | None = None) -> DataFrame:
    """One row: how far indexing got. Percent is of the chain when its height is known, else
    the scanned share of the blocks up to the last one scanned."""
    done = progress.agg(
        F.coalesce(F.max("last_scanned_block"), F.lit(0)).cast("bigint").alias("last_block_indexed"),
        F.coalesce(F.max("total_blocks_scanned"), F.lit(0)).cast("bigint").alias("blocks_indexed"))
    last = F.col("last_block_indexed").cast("double")
    if chain_height:
        percent = last / F.lit(float(chain_height)) * 100
    else:
        percent = F.when(last > 0, F.col("blocks_indexed").cast("double") / last * 100).otherwise(F.lit(0.0))
    return beside(hand_figures(hands), done).select(
        F.lit(chain_height or 0).cast("bigint").alias("total_blocks"), "blocks_indexed",
        percent.alias("percent_complete"), "last_block_indexed",
        F.coalesce("first_block", F.lit(0)).cast("bigint").alias("first_block_indexed"),
        F.col("hands").alias("total_hands"), F.col("games").alias("total_games"))


def scan_gap_ranges(heights: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Runs of blocks of start..end (default: the span seen) that were never scanned: first_block, last_block.

    Work follows the scanned heights and the number of gaps, not the blocks that are missing."""
    if start is not None and end is not None and start > end:
        return heights.sparkSession.createDataFrame([], "first_block bigint, last_block bigint")
    seen = heights.select("height")
    if start is not None:
        seen = seen.filter(F.col("height") >= start)
    if end is not None:
        seen = seen.filter(F.col("height") <= end)
    fences = [at for at in (start - 1 if start is not None else None, end + 1 if end is not None else None) if at is not None]
    if fences:  # just outside, so that what is missing at the ends lies between two scanned blocks
        seen = seen.unionByName(heights.sparkSession.createDataFrame([(at,) for at in fences], "height bigint"))
    return gaps(seen, "height").select(F.col("lo").alias("first_block"), F.col("hi").alias("last_block"))


def scan_gaps(heights: DataFrame, start: int | None = None, end: int | None = None, width: int = 10_000) -> DataFrame:
    """Blocks of start..end (default: the span seen) that were never scanned, one row each.

    Long gaps are laid out piece by piece over the cluster; no task or row holds all of one."""
    pieces = (scan_gap_ranges(heights, start, end)
              .select("last_block", F.explode(F.sequence(
                  "first_block", "last_block", F.lit(width).cast("bigint"))).alias("at"))
              .repartition("at"))
    return pieces.select(F.explode(F.sequence("at", F.least("last_block", F.col("at") + (width - 1)))).alias("missing_block"))
