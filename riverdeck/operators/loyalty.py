"""Loyalty tiers: distribution, changes, monthly rake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.constants import TIER_CHANGE_REASON
from riverdeck.functions.loyalty import vip_points, vip_tier


def monthly_stats(rake_rows: DataFrame) -> DataFrame:
    """Per player and month: hands, rake, profit, and the points the rake earns."""
    return (rake_rows.groupBy("player_address", "year", "month")
            .agg(F.sum("hands_played").cast("bigint").alias("hands_played"),
                 F.sum("rake_contributed").alias("rake_contributed"), F.sum("net_profit").alias("net_profit"))
            .withColumn("vip_points_earned", vip_points(F.col("rake_contributed"))))


def month_rake(monthly: DataFrame, year: int, month: int) -> DataFrame:
    """Per player: rake of one month and the tier it earns."""
    return (monthly.filter((F.col("year") == year) & (F.col("month") == month))
            .groupBy("player_address").agg(F.sum("rake_contributed").alias("current_month_rake"))
            .withColumn("vip_tier", vip_tier(F.col("current_month_rake"))))


def vip_tier_changes(current: DataFrame) -> DataFrame:
    """Players whose rake of the month earns another tier than they have. Takes
    (player_address, vip_tier, current_month_rake); a player without a tier never changes."""
    earned = vip_tier(F.col("current_month_rake"))
    return current.filter(F.col("vip_tier") != earned).select(
        "player_address", F.col("vip_tier").alias("old_tier"), earned.alias("new_tier"),
        F.lit(TIER_CHANGE_REASON).alias("reason"))


def apply_vip_tiers(tiers: DataFrame, changes: DataFrame) -> DataFrame:
    """(player_address, vip_tier) after the changes of `vip_tier_changes`."""
    moved = changes.select("player_address", "new_tier")
    return tiers.join(moved, "player_address", "left").select(
        "player_address", F.coalesce("new_tier", "vip_tier").alias("vip_tier"))


def vip_tier_history(changes: DataFrame, changed_at: str | None = None) -> DataFrame:
    """The changes as rows of the history table, stamped now or with the given time; append them with
    `sources.tables.write_table(..., mode="append")`."""
    at = F.lit(changed_at).cast("timestamp_ntz") if changed_at else F.current_timestamp().cast("timestamp_ntz")
    return changes.select("player_address", "old_tier", "new_tier", "reason", at.alias("changed_at"))


def vip_distribution(stats: DataFrame) -> DataFrame:
    """Per tier: players, rake, mean hands, mean profit."""
    def mean(name: str):
        return F.sum(name).cast("double") / F.count(name).cast("double")

    return stats.groupBy("vip_tier").agg(
        F.count("*").alias("player_count"), F.sum("total_rake_contributed").alias("total_rake"),
        mean("total_hands").alias("avg_hands"), mean("net_profit").alias("avg_profit"))
