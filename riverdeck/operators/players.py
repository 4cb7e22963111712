"""Player totals, playing style, leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverdeck.constants import LOWEST_TIER, MICRO_UNITS
from riverdeck.functions.loyalty import integer_div, rakeback_pct, vip_points
from riverdeck.plans.paging import top
from riverdeck.plans.slices import global_rank

# Action name -> column that counts it.
COUNTED = {"bet": "bets", "raise": "raises", "call": "calls", "fold": "folds", "check": "checks",
           "all-in": "allins"}
ACTION_FIGURES = ["total_actions", *COUNTED.values()]


def action_figures() -> list[Column]:
    """Actions in all and by kind, first and last block, of a group of actions."""
    return [F.count("*").alias("total_actions"),
            *[F.count_if(F.col("action") == name).alias(out) for name, out in COUNTED.items()],
            F.min("block_height").alias("first_block"), F.max("block_height").alias("last_block")]


def action_counts(actions: DataFrame) -> DataFrame:
    """Per player: actions in all and by kind, distinct hands, first and last block.

    Rows shrink to one per (player, hand) first, which also is the distinct count: a hot
    player spreads over its hands."""
    per_hand = actions.groupBy("player_address", "game_id", "hand_number").agg(*action_figures())
    return per_hand.groupBy("player_address").agg(
        *[F.sum(out).alias(out) for out in ACTION_FIGURES],
        F.count("*").alias("unique_hands"),
        F.min("first_block").alias("first_block"), F.max("last_block").alias("last_block"))


def session_totals(sessions: DataFrame) -> DataFrame:
    """Per player: money in, money out, hands played."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    return sessions.groupBy("player_address").agg(
        total("buy_in_amount").alias("total_buy_in"), total("cash_out_amount").alias("total_cash_out"),
        total("hands_played").alias("total_hands"))


def player_stats(actions: DataFrame, sessions: DataFrame, monthly: DataFrame | None = None,
                 tiers: DataFrame | None = None, pots: DataFrame | None = None) -> DataFrame:
    """The wide per-player summary, for every player with actions.

    Hands are the sessions' when they report any, else the distinct hands acted in. Rake comes
    from `monthly`, tiers from `tiers`, pots from `biggest_pot`, each when given."""
    return player_summary_of(action_counts(actions), sessions, monthly, tiers, pots)


def player_stats_of(player: str, actions: DataFrame, sessions: DataFrame, *others: DataFrame | None) -> DataFrame:
    """`player_stats` of one player: the filter reaches every scan. No row for a player without actions."""
    own = [None if frame is None else frame.filter(F.col("player_address") == player) for frame in (actions, sessions, *others)]
    return player_stats(*own)


def player_summary_of(counts: DataFrame, sessions: DataFrame, monthly: DataFrame | None = None,
                      tiers: DataFrame | None = None, pots: DataFrame | None = None) -> DataFrame:
    """`player_stats` from action counts, computed or kept."""
    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    bets = F.col("bets") + F.col("allins")
    totals = session_totals(sessions).withColumnRenamed("total_hands", "session_hands")
    joined = counts.join(totals, "player_address", "left")
    if monthly is not None:
        rake = monthly.groupBy("player_address").agg(F.sum("rake_contributed").alias("rake"))
        joined = joined.join(rake, "player_address", "left")
    if tiers is not None:
        joined = joined.join(tiers.select("player_address", "vip_tier"), "player_address", "left")
    if pots is not None:
        joined = joined.join(pots, "player_address", "left")
    aggression = F.when(F.col("calls") > 0, integer_div((bets + F.col("raises")) * 100, F.col("calls"))).otherwise(
        F.lit(0))
    return joined.select(
        "player_address",
        F.coalesce(F.nullif("session_hands", F.lit(0)), "unique_hands").cast("bigint").alias("total_hands"),
        "total_actions", zero("total_buy_in").alias("total_buy_in"), zero("total_cash_out").alias("total_cash_out"),
        (zero("total_cash_out") - zero("total_buy_in")).alias("net_profit"),
        bets.alias("total_bets"), F.col("raises").alias("total_raises"), F.col("calls").alias("total_calls"),
        F.col("folds").alias("total_folds"), F.col("checks").alias("total_checks"),
        aggression.cast("bigint").alias("aggression_factor"),
        F.col("first_block").alias("first_seen_block"), F.col("last_block").alias("last_seen_block"),
        (zero("rake") if monthly is not None else F.lit(0).cast("bigint")).alias("total_rake_contributed"),
        (F.col("vip_tier") if tiers is not None else F.lit(LOWEST_TIER)).alias("vip_tier"),
        (zero("biggest_pot_won") if pots is not None else F.lit(0).cast("bigint")).alias("biggest_pot_won"))


def wide_player_stats(stats: DataFrame, actions: DataFrame, sessions: DataFrame, month: DataFrame,
                      states: DataFrame | None = None) -> DataFrame:
    """The whole player row: the summary with playing style, rake of the current month (`loyalty.month_rake`),
    points and the longest session. Each part is one row per player, so the joins keep the summary's rows."""
    style = play_style(actions, states).drop("total_hands")
    rake = month.select("player_address", "current_month_rake")
    joined = (stats.join(style, "player_address", "left").join(rake, "player_address", "left")
              .join(session_records(sessions), "player_address", "left"))
    return (joined.withColumn("vip_points", vip_points(F.col("total_rake_contributed")))
            .na.fill(0, ["current_month_rake", "longest_session_blocks"]))


def profiles(stats: DataFrame) -> DataFrame:
    """Display form of the summary: money in currency units, aggression as a ratio."""
    def scaled(name: str, by: float) -> Column:
        return F.col(name).cast("double") / F.lit(by)

    unit = float(MICRO_UNITS)
    return stats.select(
        "player_address", "vip_tier", rakeback_pct(F.col("vip_tier")).alias("rakeback_pct"),
        vip_points(F.col("total_rake_contributed")).alias("vip_points"), "total_hands", "total_actions",
        scaled("net_profit", unit).alias("net_profit_usd"), scaled("total_buy_in", unit).alias("total_buy_in_usd"),
        scaled("total_cash_out", unit).alias("total_cash_out_usd"),
        scaled("total_rake_contributed", unit).alias("rake_contributed_usd"),
        scaled("aggression_factor", 100.0).alias("aggression_factor"),
        "total_bets", "total_raises", "total_calls", "total_folds", "total_checks",
        scaled("biggest_pot_won", unit).alias("biggest_pot_usd"), "first_seen_block", "last_seen_block")


def player_overview(sessions: DataFrame, actions: DataFrame, player: str | None = None) -> DataFrame:
    """Per player with sessions: games, actions, money, sessions, mean session length in blocks
    (sessions of length 0 and open ones left out). Asked for one player, an unknown one gets zeros."""
    if player is not None:
        sessions = sessions.filter(F.col("player_address") == player)
        actions = actions.filter(F.col("player_address") == player)
    length = F.nullif(F.col("leave_block") - F.col("join_block"), F.lit(0))
    per_game = sessions.groupBy("player_address", "game_id").agg(
        F.sum("buy_in_amount").alias("ins"), F.sum("cash_out_amount").alias("outs"), F.count("*").alias("n"),
        F.sum(length).alias("blocks"), F.count(length).alias("lengths"))
    played = per_game.groupBy("player_address").agg(
        F.count("game_id").alias("games_played"), F.sum("ins").alias("total_buy_ins"),
        F.sum("outs").alias("total_cash_outs"), F.sum("n").alias("session_count"),
        F.sum("blocks").alias("blocks"), F.sum("lengths").alias("lengths"))
    acted = actions.groupBy("player_address").agg(F.count("*").alias("total_actions"))
    rows = played.join(acted, "player_address", "left")
    if player is not None:
        asked = sessions.sparkSession.range(1).select(F.lit(player).alias("player_address"))
        rows = asked.join(rows, "player_address", "left")
        rows = rows.withColumn("total_actions", F.when(F.col("session_count") > 0, F.col("total_actions")))

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    mean = F.when(F.col("lengths") > 0, F.col("blocks").cast("double") / F.col("lengths").cast("double"))
    return rows.select(
        "player_address", zero("games_played").alias("games_played"), zero("total_actions").alias("total_actions"),
        zero("total_buy_ins").alias("total_buy_ins"), zero("total_cash_outs").alias("total_cash_outs"),
        (zero("total_cash_outs") - zero("total_buy_ins")).alias("net_profit"),
        zero("session_count").alias("session_count"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_session_length"))


def action_distribution(actions: DataFrame) -> DataFrame:
    """Per action: count and share of all actions."""
    counts = actions.groupBy("action").agg(F.count("*").alias("count"))
    every = counts.agg(F.sum("count").cast("double")).scalar()
    return counts.select(
        "action", "count", F.round(F.col("count").cast("double") / every * 100, 2).alias("percentage"))


def player_summary(stats: DataFrame) -> DataFrame:
    """One row over all players: totals, mean profit, players per tier."""
    return stats.agg(
        F.count("*").alias("total_players"), F.count_if(F.col("total_hands") > 0).alias("active_players"),
        F.sum("total_hands").alias("total_hands_played"), F.sum("total_actions").alias("total_actions"),
        F.sum("total_rake_contributed").alias("total_rake"),
        (F.sum("net_profit").cast("double") / F.count("net_profit").cast("double")).alias("avg_profit"),
        *[F.count_if(F.col("vip_tier") == t).alias(f"{t}_players")
          for t in ("diamond", "platinum", "gold", "silver", "bronze")])


# Per leaderboard, the least hands needed and the columns shown.
BOARDS = {
    "net_profit": (1, ["player_address", "net_profit", "total_hands", "total_buy_in", "total_cash_out", "vip_tier"]),
    "total_hands": (1, ["player_address", "total_hands", "total_actions", "net_profit", "vip_tier"]),
    "aggression_factor": (10, ["player_address", "aggression_factor", "total_bets", "total_raises", "total_calls",
                               "total_hands"]),
}


def leaderboard(stats: DataFrame, by: str, min_hands: int | None = None, k: int | None = None) -> DataFrame:
    """Players ranked by net_profit, total_hands or aggression_factor; ties share a rank.

    With `k`, only the first k rows are kept; the rows above a row decide its rank, so ranking
    those k alone gives the same ranks."""
    least, columns = BOARDS[by]
    entered = stats.filter(F.col("total_hands") >= (least if min_hands is None else min_hands)).select(*columns)
    if k is None:
        ranked = global_rank(entered, by, ["player_address"])
    else:
        first = top(entered, [F.desc(by), F.asc("player_address")], k)
        ranked = first.withColumn("rank", F.rank().over(Window.orderBy(F.desc(by))).cast("bigint"))
    if by != "aggression_factor":
        return ranked.select(*columns, "rank")
    return ranked.select(
        "player_address", (F.col("aggression_factor").cast("double") / F.lit(100.0)).alias("af"),
        (F.col("total_bets") + F.col("total_raises")).alias("aggressive_actions"),
        F.col("total_calls").alias("passive_actions"), "total_hands", "rank")


def leaderboard_monthly(monthly: DataFrame, stats: DataFrame) -> DataFrame:
    """Players ranked by rake inside each month."""
    rows = monthly.join(stats.select("player_address", "vip_tier"), "player_address").select(
        "player_address", "year", "month", "hands_played", "rake_contributed", "net_profit", "vip_tier")
    return global_rank(rows, "rake_contributed", ["player_address"], ["year", "month"])


def play_style(actions: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """Per player: hands entered voluntarily and raised before the flop, as counts and as
    hundredths of a percent of the hands played; with `states`, showdowns reached and won too."""
    preflop = F.col("round") == "preflop"
    hands = actions.groupBy("player_address", "game_id", "hand_number").agg(
        F.max(F.coalesce(preflop & F.col("action").isin("bet", "call", "raise", "all-in"), F.lit(False)))
        .alias("entered"),
        F.max(F.coalesce(preflop & F.col("action").isin("raise", "all-in"), F.lit(False))).alias("raised"))
    styles = hands.groupBy("player_address").agg(
        F.count("*").alias("total_hands"), F.count_if("entered").alias("hands_vpip"),
        F.count_if("raised").alias("hands_pfr"))

    def rate(part: str, whole: str) -> Column:
        return F.coalesce(F.when(F.col(whole) > 0, integer_div(F.col(part) * 10000, F.col(whole))), F.lit(0)).cast(
            "bigint")

    styles = styles.select("*", rate("hands_vpip", "total_hands").alias("vpip"),
                           rate("hands_pfr", "total_hands").alias("pfr"))
    if states is None:
        return styles
    shown = showdown_records(states)
    return (styles.join(shown, "player_address", "left").na.fill(0, ["hands_to_showdown", "showdowns_won"])
            .select("*", rate("hands_to_showdown", "total_hands").alias("wtsd"),
                    rate("showdowns_won", "hands_to_showdown").alias("won_at_showdown")))


def showdown_records(states: DataFrame) -> DataFrame:
    """Per player: hands whose cards were shown at a showdown, and how many of those were won."""
    won = F.transform("winners", lambda w: w["address"])
    seats = (states.filter((F.col("round") == "showdown") & (F.size("winners") > 0))
             .select("game_id", "hand_number", won.alias("won"), F.explode("players").alias("p"))
             .filter(F.size("p.holeCards") > 0)
             .groupBy(F.col("p.address").alias("player_address"), "game_id", "hand_number")
             .agg(F.max(F.array_contains("won", F.col("p.address"))).alias("won")))
    return seats.groupBy("player_address").agg(
        F.count("*").alias("hands_to_showdown"), F.count_if("won").alias("showdowns_won"))


def session_records(sessions: DataFrame) -> DataFrame:
    """Per player: longest closed session in blocks."""
    return (sessions.filter(F.col("leave_block").isNotNull()).groupBy("player_address")
            .agg(F.max(F.col("leave_block") - F.col("join_block")).alias("longest_session_blocks")))
