"""The published views and functions under their SQL names, for use from `spark.sql`.

Views are plans over the given tables, computed when queried. Ranks and the per-player summary
are the exception: like the tables they stand for, they show the state at their last refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverdeck.functions.loyalty import register_sql_functions
from riverdeck.operators import distribution as d
from riverdeck.operators import lookup, loyalty, players
from riverdeck.operators import randomness as r
from riverdeck.schemas import TABLES
from riverdeck.session import pinned
from riverdeck.sources.tables import read_table


def register_tables(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    """Parquet tables under `root` as views of the same names (default: all known tables)."""
    tables = {name: read_table(spark, root, name) for name in names or TABLES}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def _table_function(spark: SparkSession, name: str, result: DataFrame) -> None:
    """`name()` as a table function giving `result`."""
    result.createOrReplaceTempView(f"{name}_result")
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in result.schema)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) "
              f"RETURN SELECT * FROM {name}_result")


def register_card_views(spark: SparkSession, hands: DataFrame, results: DataFrame, cards: DataFrame) -> None:
    views = {
        "card_distribution_stats": d.card_stats(cards),
        "card_frequency_analysis": d.card_frequency(cards),
        "rank_distribution": d.rank_distribution(cards),
        "suit_distribution": d.suit_distribution(cards),
        "outlier_cards": d.outliers(cards),
        "community_card_sequences": d.card_sequences(cards),
        "distribution_over_time": d.timeline(cards),
        "seed_entropy_analysis": r.duplicate_seeds(hands),
        "seed_entropy_games": r.duplicate_seed_games(hands),
        "seed_character_distribution": r.seed_characters(hands),
        "total_hands_summary": lookup.totals(hands, results, cards),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    _table_function(spark, "calculate_chi_squared", r.chi_squared(cards, "card"))
    _table_function(spark, "suit_chi_squared", r.chi_squared(cards, "suit"))
    _table_function(spark, "rank_chi_squared", r.chi_squared(cards, "rank"))
    _table_function(spark, "generate_randomness_report", r.randomness_report(cards, hands))


def register_player_views(spark: SparkSession, actions: DataFrame, sessions: DataFrame,
                          monthly: DataFrame | None = None, tiers: DataFrame | None = None) -> None:
    """Player summary, profiles, leaderboards and tier figures; call again to refresh them."""
    register_sql_functions(spark)
    stats = pinned(players.player_stats(actions, sessions, monthly, tiers), "player-stats")
    views = {
        "player_stats": stats,
        "player_profiles": players.profiles(stats),
        "player_summary": players.player_summary(stats),
        "vip_distribution": loyalty.vip_distribution(stats),
        "leaderboard_profit": players.leaderboard(stats, "net_profit"),
        "leaderboard_volume": players.leaderboard(stats, "total_hands"),
        "leaderboard_aggression": players.leaderboard(stats, "aggression_factor"),
    }
    if monthly is not None:
        views["leaderboard_monthly"] = players.leaderboard_monthly(monthly, stats)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
