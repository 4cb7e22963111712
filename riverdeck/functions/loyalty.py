"""Loyalty tier rules as Column functions, and the same rules as SQL functions."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from riverdeck.constants import LOWEST_TIER, RAKE_PER_POINT, TIERS


def integer_div(a: Column, b: Column) -> Column:
    """Truncating integer division."""
    return F.call_function("div", a, b)


def vip_tier(monthly_rake: Column) -> Column:
    """Tier earned by a month's rake; boundaries are inclusive, a missing rake earns the lowest."""
    rungs = F.lit(LOWEST_TIER)
    for name, least, _ in reversed(TIERS[:-1]):
        rungs = F.when(monthly_rake >= least, F.lit(name)).otherwise(rungs)
    return rungs


def rakeback_pct(tier: Column) -> Column:
    share = F.lit(0)
    for name, _, pct in TIERS[:-1]:
        share = F.when(tier == name, F.lit(pct)).otherwise(share)
    return share


def vip_points(rake: Column) -> Column:
    return integer_div(rake, F.lit(RAKE_PER_POINT).cast("bigint"))


def register_sql_functions(spark: SparkSession) -> None:
    """The same rules under their published SQL names."""
    by_rake = " ".join(f"WHEN rake >= {least} THEN '{name}'" for name, least, _ in TIERS[:-1])
    by_tier = " ".join(f"WHEN '{name}' THEN {pct}" for name, _, pct in TIERS[:-1])
    for signature, returned, body in (
        ("get_vip_tier(rake BIGINT)", "STRING", f"CASE {by_rake} ELSE '{LOWEST_TIER}' END"),
        ("get_rakeback_percentage(tier STRING)", "INT", f"CASE tier {by_tier} ELSE 0 END"),
        ("calculate_vip_points(rake BIGINT)", "BIGINT", f"rake div {RAKE_PER_POINT}"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returned} RETURN {body}")
