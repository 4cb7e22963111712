"""How often cards, ranks and suits turn up.

Fact rows are read once and shrink to one row per distinct card before anything else happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck.constants import CARD_P05, DECK_SIZE, RANKS, SUITS, TIMELINE_WIDTH
from riverdeck.functions.cards import is_standard, suit_name
from riverdeck.plans.paging import top


def _deck_rows(one_row: DataFrame) -> DataFrame:
    """One row -> 52, one per card, keeping its columns."""
    return (one_row.select("*", F.explode(F.array(*[F.lit(r) for r in RANKS])).alias("rank"))
            .select("*", F.explode(F.array(*[F.lit(s) for s in SUITS])).alias("suit"))
            .select(F.concat("rank", "suit").alias("card"), "*"))


def card_domain(spark: SparkSession) -> DataFrame:
    """The 52 cards with rank and suit."""
    return _deck_rows(spark.range(1).select()).select("card", "rank", "suit")


def card_counts(cards: DataFrame) -> DataFrame:
    """Per card: all appearances, community appearances, hole appearances."""
    return cards.groupBy("card").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("card_type") == "community").alias("community"),
        F.count_if(F.col("card_type") == "hole").alias("hole"))


def _by_card(value: Column) -> Column:
    """Aggregate: `value` per card of the 52, as a map of at most 52 entries."""
    return F.map_from_entries(F.collect_list(F.when(is_standard(F.col("card")), F.struct("card", value))))


def card_stats(cards: DataFrame) -> DataFrame:
    """The 52-card summary; cards never seen count 0, cards outside the 52 are left out."""
    seen = card_counts(cards).agg(_by_card(F.struct("total", "community", "hole")).alias("seen"))
    at = F.col("seen")[F.col("card")]
    return _deck_rows(seen).select(
        "card", "rank", "suit",
        *[F.coalesce(at[c], F.lit(0)).cast("bigint").alias(name) for c, name in (
            ("total", "total_appearances"), ("community", "community_appearances"),
            ("hole", "hole_card_appearances"))])


def deal(cards: DataFrame) -> DataFrame:
    """One row: all cards dealt (cards outside the 52 included), distinct cards, and a map of
    appearances per card of the 52. The single scan every figure here starts from."""
    return (cards.groupBy("card").agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_cards"),
                 F.count("card").alias("distinct_cards"), _by_card(F.col("n")).alias("hits")))


def _dealt(cards: DataFrame) -> DataFrame:
    """52 rows: appearances, and the count of all cards dealt."""
    return _deck_rows(deal(cards)).select(
        "card", "rank", "suit",
        F.coalesce(F.col("hits")[F.col("card")], F.lit(0)).cast("bigint").alias("total_appearances"),
        F.col("total_cards").alias("total_cards_dealt"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def _expected(categories: int) -> Column:
    return F.round(F.lit(100.0) / F.lit(float(categories)), 4)


def frequency_fields(appearances: Column, dealt: Column) -> list[Column]:
    """A card's share of all cards, the even share, and how far apart they are, in percent."""
    share = _share(appearances, dealt)
    even = F.lit(1.0) / F.lit(float(DECK_SIZE))
    return [F.round(share * 100, 4).alias("actual_percentage"), _expected(DECK_SIZE).alias("expected_percentage"),
            F.when(dealt > 0, F.round((share - even) * 100, 4)).otherwise(F.lit(0.0)).alias("deviation_percentage")]


def card_frequency(cards: DataFrame) -> DataFrame:
    """Per card of the 52: appearances, share of all cards, and how far off an even share it is."""
    return _dealt(cards).select(
        "card", "rank", "suit", "total_appearances", "total_cards_dealt",
        *frequency_fields(F.col("total_appearances"), F.col("total_cards_dealt")))


def card_lookup(cards: DataFrame, card: str = "") -> DataFrame:
    """Frequency of one card, or of all when none is named."""
    rows = card_frequency(cards)
    return rows.filter(F.col("card") == card) if card else rows


def outliers(cards: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Cards off their even share by more than `threshold` percentage points."""
    limit = threshold if threshold > 0 else 1.0
    return card_frequency(cards).filter(F.abs("deviation_percentage") > limit)


def _grouped(cards: DataFrame, by: str, categories: int) -> DataFrame:
    sums = _dealt(cards).groupBy(by).agg(
        F.sum("total_appearances").alias("total_appearances"), F.max("total_cards_dealt").alias("dealt"))
    share = _share(F.col("total_appearances"), F.col("dealt"))
    return sums.select(by, "total_appearances", F.round(share * 100, 4).alias("actual_percentage"),
                       _expected(categories).alias("expected_percentage"))


def rank_distribution(cards: DataFrame) -> DataFrame:
    return _grouped(cards, "rank", len(RANKS))


def suit_distribution(cards: DataFrame) -> DataFrame:
    return _grouped(cards, "suit", len(SUITS)).select(
        "suit", suit_name(F.col("suit")).alias("suit_name"), "total_appearances", "actual_percentage",
        "expected_percentage")


def unknown_cards(cards: DataFrame) -> DataFrame:
    """Data quality: cards outside the 52, with their counts."""
    return cards.groupBy("card").agg(F.count("*").alias("n")).filter(
        ~F.coalesce(is_standard(F.col("card")), F.lit(False)))


def block_bucket(height: Column, width: int) -> Column:
    return height - height % width


def _bucket_counts(cards: DataFrame, width: int) -> DataFrame:
    """Rows per (block range, card): a hot range shrinks to its distinct cards before shuffling."""
    return (cards.groupBy(block_bucket(F.col("block_height"), width).alias("block_range_start"), "card")
            .agg(F.count("*").alias("n")))


def timeline(cards: DataFrame, width: int = TIMELINE_WIDTH) -> DataFrame:
    """Per block range: cards dealt, distinct cards, coverage of the 52."""
    return (_bucket_counts(cards, width).groupBy("block_range_start")
            .agg(F.sum("n").alias("cards_dealt"), F.count("card").alias("unique_cards"))
            .withColumn("card_coverage_pct",
                        F.round(F.col("unique_cards").cast("double") / F.lit(float(DECK_SIZE)) * 100, 2)))


def timeline_chi_squared(cards: DataFrame, width: int = TIMELINE_WIDTH, critical: float = CARD_P05) -> DataFrame:
    """Per block range: cards and the 52-way chi-squared statistic.

    Only observed cards have rows; each unobserved one adds the expected count itself."""
    expected = F.col("total_cards").cast("double") / F.lit(float(DECK_SIZE))
    gaps = F.aggregate("known", F.lit(0.0), lambda acc, n: acc + (n - expected) * (n - expected) / expected)
    counted = (_bucket_counts(cards, width).groupBy("block_range_start")
               .agg(F.sum("n").alias("total_cards"),
                    # at most 52 numbers per range, sorted so that the sum is reproducible
                    F.sort_array(F.collect_list(F.when(is_standard(F.col("card")), F.col("n").cast("double"))))
                    .alias("known")))
    return (counted
            .withColumn("raw", gaps + (F.lit(DECK_SIZE) - F.size("known")) * expected)
            .select(F.concat_ws("-", F.col("block_range_start").cast("string"),
                                (F.col("block_range_start") + (width - 1)).cast("string")).alias("block_range"),
                    "total_cards", F.round("raw", 4).alias("chi_squared"),
                    (F.col("raw") < critical).alias("passes_test")))


def card_sequences(cards: DataFrame, first: int = 0, second: int = 1, min_count: int = 2,
                   k: int | None = 50) -> DataFrame:
    """How often a community card at one position meets a card at another in the same hand.

    Hands are reduced to (position, card, copies) first, so repeated rows of a hand multiply as numbers and
    never as rows; its cards then meet inside the hand. Cards are read once, for the pairs and for what
    the percentage refers to, the rows at the first position."""
    hand = ["game_id", "hand_number"]
    seen = (cards.filter((F.col("card_type") == "community") & F.col("position").isin(first, second))
            .groupBy(*hand, "position", "card").agg(F.count("*").alias("copies")))

    def at(position: int) -> Column:
        return F.collect_list(F.when(F.col("position") == position, F.struct("card", "copies")))

    # As many entries as there are different cards at a hand's two places.
    hands = seen.groupBy(*hand).agg(at(first).alias("firsts"), at(second).alias("seconds"))
    met = hands.select(F.inline("firsts").alias("first_card", "a"), "seconds").select(
        "first_card", "a", F.posexplode_outer("seconds").alias("nth", "other"))
    counted = met.groupBy("first_card", F.col("other.card").alias("second_card")).agg(
        F.sum(F.col("a") * F.col("other.copies")).alias("occurrences"),
        F.sum(F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("a"))).alias("rows_at_first"))
    base = counted.agg(F.sum("rows_at_first").cast("double")).scalar()
    pairs = (counted.filter(F.col("occurrences") >= min_count)
             .select("first_card", "second_card", "occurrences",
                     F.round(F.col("occurrences").cast("double") / base * 100, 2).alias("percentage")))
    if k is None:
        return pairs
    return top(pairs, [F.desc("occurrences"), F.asc("first_card"), F.asc("second_card")], k)
