"""Is the deal uniform, are deck seeds fresh: tests, seed checks and the combined report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck import constants as c
from riverdeck.functions.cards import DECK, rank_of, suit_of
from riverdeck.functions.chisq import chi_squared_tail, uniform_chi_squared
from riverdeck.operators.distribution import deal, frequency_fields
from riverdeck.operators.lookup import hand_figures, summary_fields
from riverdeck.plans.paging import beside

FREEDOM = {"card": c.DECK_SIZE - 1, "suit": len(c.SUITS) - 1, "rank": len(c.RANKS) - 1}


def _hits(card: Column) -> Column:
    return F.coalesce(F.col("hits")[card], F.lit(0)).cast("bigint")


def _statistics() -> list[Column]:
    """The raw statistics by card, suit and rank, over a row of `deal`."""
    ranks, suits = (F.array(*[F.lit(v) for v in values]) for values in (c.RANKS, c.SUITS))

    def total(over: Column, card) -> Column:
        return F.aggregate(over, F.lit(0).cast("bigint"), lambda acc, v: acc + _hits(card(v)))

    by = {"card": F.transform(F.array(*[F.lit(card) for card in DECK]), _hits),
          "suit": F.transform(suits, lambda s: total(ranks, lambda r: F.concat(r, s))),
          "rank": F.transform(ranks, lambda r: total(suits, lambda s: F.concat(r, s)))}
    return [uniform_chi_squared(by[kind], FREEDOM[kind] + 1, F.col("total_cards")).alias(f"chi_{kind}")
            for kind in FREEDOM]


def uniformity(cards: DataFrame) -> DataFrame:
    """One row: cards dealt, distinct cards, and the raw statistics by card, suit and rank."""
    return deal(cards).select("total_cards", "distinct_cards", *_statistics())


def _verdict(by: str, chi: Column, total: Column) -> Column:
    if by == "card":
        found = (F.when(chi < c.CARD_P05, F.lit(c.CARD_PASS)).when(chi < c.CARD_P01, F.lit(c.CARD_MARGINAL))
                 .otherwise(F.lit(c.CARD_FAIL)))
    elif by == "suit":
        found = F.when(chi < c.SUIT_P05, F.lit(c.SUIT_PASS)).otherwise(F.lit(c.SUIT_FAIL))
    elif by == "rank":
        found = F.when(chi < c.RANK_P05, F.lit(c.RANK_PASS)).otherwise(F.lit(c.RANK_FAIL))
    else:
        raise ValueError(f"unknown grouping {by!r}")
    return F.when(total == 0, F.lit(c.NO_DATA)).otherwise(found)


def chi_squared(cards: DataFrame, by: str = "card") -> DataFrame:
    """One row: the test of an even split by card, suit or rank. The verdict uses the unrounded
    statistic; the shown one has 6 decimals."""
    verdict = _verdict(by, F.col(f"chi_{by}"), F.col("total_cards"))
    shown = F.round(f"chi_{by}", 6).alias("chi_squared")
    freedom = F.lit(FREEDOM[by]).alias("degrees_of_freedom")
    if by == "card":
        return uniformity(cards).select(
            F.lit(c.CARD_TEST_NAME).alias("test_name"), shown, freedom,
            F.col("total_cards").alias("total_observations"), verdict.alias("p_value_hint"))
    return uniformity(cards).select(shown, freedom, verdict.alias("interpretation"))


def _pvalue_struct(by: str, p: Column) -> Column:
    passes = p > 0.05
    return F.struct(
        F.round(f"chi_{by}", 4).alias("chi_squared"), F.lit(FREEDOM[by]).alias("degrees_of_freedom"),
        F.round(p, 6).alias("p_value"), F.when(passes, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"),
        F.when(passes, F.lit(c.PVALUE_PASS)).otherwise(F.lit(c.PVALUE_FAIL)).alias("interpretation"))


def _with_pvalues(row: DataFrame, kinds: list[str]) -> DataFrame:
    return row.withColumns({
        f"p_{by}": chi_squared_tail(F.col(f"chi_{by}"), FREEDOM[by]) for by in kinds})


def chi_squared_pvalue(cards: DataFrame, by: str | None = None) -> DataFrame:
    """The tests with their upper-tail probability; all three groupings, or one."""
    kinds = [by] if by else list(FREEDOM)
    tests = F.array(*[
        F.struct(F.lit(kind).alias("grouping"), *[
            _pvalue_struct(kind, F.col(f"p_{kind}"))[name].alias(name)
            for name in ("chi_squared", "degrees_of_freedom", "p_value", "result", "interpretation")])
        for kind in kinds])
    return _with_pvalues(uniformity(cards), kinds).select(F.inline(tests))


def _seed_games(hands: DataFrame) -> DataFrame:
    """One row per (seed, game): a hot seed spreads over its games."""
    return hands.groupBy("deck_seed", "game_id").agg(
        F.count("*").alias("uses"), F.min("block_height").alias("lo"), F.max("block_height").alias("hi"))


def duplicate_seeds(hands: DataFrame) -> DataFrame:
    """One row per seed used more than once, the empty seed included: uses, first and last block, and
    in how many games. `duplicate_seed_games` lists the games."""
    return (_seed_games(hands).groupBy("deck_seed")
            .agg(F.sum("uses").alias("times_used"), F.min("lo").alias("first_block"),
                 F.max("hi").alias("last_block"), F.count("game_id").alias("game_count"))
            .filter(F.col("times_used") > 1))


def duplicate_seed_games(hands: DataFrame) -> DataFrame:
    """One row per game of a seed used more than once, with its uses there."""
    games = _seed_games(hands).select("deck_seed", "game_id", "uses")
    often = games.groupBy("deck_seed").agg(F.sum("uses").alias("times_used")).filter("times_used > 1").select("deck_seed")
    return games.join(often, "deck_seed", "left_semi")


def duplicate_seed_count(hands: DataFrame) -> DataFrame:
    """One row: how many seeds were used more than once."""
    return (hands.groupBy("deck_seed").agg(F.count("*").alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("duplicate_seeds")))


def seed_uniqueness(hands: DataFrame) -> DataFrame:
    """One row: seeds, distinct seeds, repeats, distinct share in percent; empty seeds left out."""
    used = (hands.filter(F.col("deck_seed") != "").groupBy("deck_seed").agg(F.count("*").alias("n")))
    return (used.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_seeds"),
                     F.count("*").alias("unique_seeds"))
            .select("total_seeds", "unique_seeds",
                    (F.col("total_seeds") - F.col("unique_seeds")).alias("duplicate_count"),
                    F.when(F.col("total_seeds") > 0,
                           F.col("unique_seeds").cast("double") / F.col("total_seeds").cast("double") * 100)
                    .alias("entropy_score")))


HEX = "0123456789abcdef"


def seed_characters(hands: DataFrame, lower: bool = False) -> DataFrame:
    """How often each hex digit occurs in the seeds; `lower` also counts upper-case digits.

    Characters are counted as they come out of each seed, before any shuffle. (Measured: half
    the time of sixteen length differences per seed.)"""
    seed = F.lower("deck_seed") if lower else F.col("deck_seed")
    counts = (hands.filter(F.col("deck_seed") != "")
              .select(F.explode(F.split(seed, "")).alias("char"))
              .groupBy("char").agg(F.count("*").alias("occurrences")))
    digit = F.col("char").isin(*HEX)
    kept = counts.agg(  # one row: the sixteen digits at most
        F.sum(F.when(digit, F.col("occurrences"))).alias("kept"),
        F.collect_list(F.when(digit, F.struct("char", "occurrences"))).alias("digits"))
    return (kept.select("kept", F.inline("digits"))
            .select("char", "occurrences",
                    F.round(F.col("occurrences").cast("double") / F.col("kept").cast("double") * 100, 2)
                    .alias("percentage"),
                    F.round(F.lit(100.0) / F.lit(float(len(HEX))), 2).alias("expected_percentage")))


def randomness_report(cards: DataFrame, hands: DataFrame, min_cards: int = c.MIN_REPORT_CARDS) -> DataFrame:
    """Five named tests, or a single SKIP row below `min_cards`. Cards and hands are each
    scanned once; the rows come from one row of figures."""
    def line(test: str, result: Column, details: Column) -> Column:
        return F.struct(F.lit(test).alias("test_name"), result.alias("result"), details.alias("details"))

    def text(pattern: str, *values: Column) -> Column:
        return F.format_string(pattern, *values)

    total = F.col("total_cards")
    skip = line("INSUFFICIENT DATA", F.lit("SKIP"), text(
        f"Only %d cards indexed. Need at least {min_cards} for statistical significance.", total))
    report = F.array(
        line("Overall Card Distribution", _verdict("card", F.col("chi_card"), total), text(
            f"Chi-squared: %.4f, df: {FREEDOM['card']}, n: %d", F.col("chi_card"), total)),
        line("Suit Distribution", _verdict("suit", F.col("chi_suit"), total), text(
            f"Chi-squared: %.4f, df: {FREEDOM['suit']}", F.col("chi_suit"))),
        line("Rank Distribution", _verdict("rank", F.col("chi_rank"), total), text(
            f"Chi-squared: %.4f, df: {FREEDOM['rank']}", F.col("chi_rank"))),
        line("Seed Uniqueness", F.when(F.col("duplicate_seeds") == 0, F.lit("PASS")).otherwise(F.lit("WARNING")),
             text("%d duplicate seeds found", F.col("duplicate_seeds"))),
        line("Card Coverage",
             F.when(F.col("distinct_cards") == c.DECK_SIZE, F.lit("PASS")).otherwise(F.lit("PARTIAL")),
             text(f"%d of {c.DECK_SIZE} unique cards observed", F.col("distinct_cards"))))
    return (beside(uniformity(cards), duplicate_seed_count(hands))
            .select(F.inline(F.when(total < min_cards, F.array(skip)).otherwise(report))))


def randomness_document(hands: DataFrame, results: DataFrame, cards: DataFrame,
                        threshold: float = 1.0) -> DataFrame:
    """One JSON document: summary, the three tests, outlier cards, number of repeated seeds.
    Cards are scanned once."""
    def described(card: Column) -> Column:
        return F.struct(
            card.alias("card"), rank_of(card).alias("rank"), suit_of(card).alias("suit"),
            _hits(card).alias("total_appearances"), *frequency_fields(_hits(card), F.col("total_cards")))

    described_deck = F.transform(F.array(*[F.lit(card) for card in sorted(DECK)]), described)
    off = F.filter(described_deck, lambda card: F.abs(card["deviation_percentage"]) > threshold)
    tested = _with_pvalues(deal(cards).select(
        F.col("total_cards").alias("cards"), off.alias("outlier_cards"), *_statistics()), list(FREEDOM))
    figures = beside(hand_figures(hands), results.agg(F.count("*").alias("results")), tested,
                     seed_uniqueness(hands).select(F.col("duplicate_count").alias("duplicate_seeds")))
    stamped = figures.withColumns(
        {stamp: F.col(stamp).cast("string") for stamp in ("first_indexed_at", "last_indexed_at")})
    return stamped.select(F.to_json(F.struct(
        F.struct(*summary_fields()).alias("summary"),
        *[_pvalue_struct(by, F.col(f"p_{by}")).alias(f"{by}_chi_squared") for by in FREEDOM],
        "outlier_cards", "duplicate_seeds")).alias("document"))
