"""Player figures, tiers, paging and lookups."""

import pytest
from pyspark.sql import functions as F

from riverdeck import schemas
from riverdeck.functions import loyalty as fn
from riverdeck.functions.cards import rank_weight, tier_weight
from riverdeck.operators import lookup as k
from riverdeck.operators import loyalty
from riverdeck.operators import players as p


def actions_of(spark, rows):
    """(player, game, hand, block, action, round)."""
    return spark.createDataFrame(
        [(a, g, h, b, act, 0, r, None) for a, g, h, b, act, r in rows], schemas.TABLES["player_actions"])


def sessions_of(spark, rows):
    """(player, game, join, leave, in, out, hands)."""
    return spark.createDataFrame([(*row, None) for row in rows], schemas.TABLES["player_sessions"])


RAKES = [(None, "bronze", 0), (0, "bronze", 0), (49_999_999, "bronze", 0), (50_000_000, "silver", 5),
         (199_999_999, "silver", 5), (200_000_000, "gold", 10), (499_999_999, "gold", 10),
         (500_000_000, "platinum", 15), (1_999_999_999, "platinum", 15), (2_000_000_000, "diamond", 20)]


def test_tier_boundaries_as_columns_and_in_sql(spark):
    frame = spark.createDataFrame([(rake,) for rake, _, _ in RAKES], "rake bigint")
    tier = fn.vip_tier(F.col("rake"))
    assert [tuple(r) for r in frame.select("rake", tier, fn.rakeback_pct(tier)).collect()] == RAKES
    fn.register_sql_functions(spark)
    assert [tuple(r) for r in spark.sql(
        "select rake, get_vip_tier(rake), get_rakeback_percentage(get_vip_tier(rake)) from {f}", f=frame).collect()] == RAKES
    points = spark.createDataFrame([(9_999,), (10_000,), (25_000,)], "rake bigint")
    assert [r[0] for r in points.select(fn.vip_points(F.col("rake"))).collect()] == [0, 1, 2]
    assert [r[0] for r in spark.sql("select calculate_vip_points(rake) from {f}", f=points).collect()] == [0, 1, 2]
    unknown = spark.createDataFrame([("wood",), (None,)], "tier string")
    assert [r[0] for r in unknown.select(fn.rakeback_pct(F.col("tier"))).collect()] == [0, 0]


def test_display_orders(spark):
    ranks = spark.createDataFrame([(r,) for r in "2TAK9"], "r string").orderBy(rank_weight(F.col("r")).desc())
    assert [x.r for x in ranks.collect()] == ["A", "K", "T", "9", "2"]
    tiers = spark.createDataFrame([(t,) for t in ["bronze", "gold", None, "diamond"]], "t string")
    assert [x.t for x in tiers.orderBy(tier_weight(F.col("t")), F.col("t").asc_nulls_last()).collect()] == [
        "diamond", "gold", "bronze", None]


def test_counts_hands_and_aggression(spark):
    actions = actions_of(spark, [
        ("a", "g", 1, 5, "bet", None), ("a", "g", 1, 6, "all-in", None), ("a", "g", None, 7, "raise", None),
        ("a", "g", None, 8, "call", None), ("a", "h", 1, 9, "call", None), ("b", "g", 1, 4, "raise", None)])
    found = {r.player_address: r for r in p.action_counts(actions).collect()}
    a = found["a"]
    assert (a.total_actions, a.bets, a.allins, a.raises, a.calls, a.unique_hands) == (5, 1, 1, 1, 2, 3)
    assert (a.first_block, a.last_block) == (5, 9)
    sessions = sessions_of(spark, [("a", "g", 1, 9, 100, 150, 0), ("c", "g", 1, 2, 5, 5, 9)])
    stats = {r.player_address: r for r in p.player_stats(actions, sessions).collect()}
    assert set(stats) == {"a", "b"}
    assert (stats["a"].total_hands, stats["a"].net_profit, stats["a"].aggression_factor) == (3, 50, 150)
    assert (stats["b"].total_hands, stats["b"].net_profit, stats["b"].aggression_factor) == (1, 0, 0)
    assert {s.vip_tier for s in stats.values()} == {"bronze"}


def test_overview_does_not_multiply_and_unknown_players_get_zeros(spark):
    sessions = sessions_of(spark, [("a", "g", 1, 11, 100, 150, 0), ("a", "g", 20, 20, 10, 0, 0),
                                   ("a", "h", 30, None, 1, 0, 0)])
    actions = actions_of(spark, [("a", "g", 1, 5, "bet", None)] * 4 + [("z", "g", 1, 5, "bet", None)])
    expected = ("a", 2, 4, 111, 150, 39, 3, 10.0)
    assert tuple(p.player_overview(sessions, actions).first()) == expected
    assert tuple(p.player_overview(sessions, actions, "a").first()) == expected
    assert tuple(p.player_overview(sessions, actions, "z").first()) == ("z", 0, 0, 0, 0, 0, 0, 0.0)


def test_leaderboards(spark):
    stats = spark.createDataFrame(
        [("a", 5, 12, 0, 0, "gold", 1, 100, 0, 0, 1), ("b", 5, 9, 0, 0, "gold", 1, 300, 0, 0, 1),
         ("c", 9, 0, 0, 0, None, 1, 900, 0, 0, 1), ("d", 1, 30, 0, 0, None, 1, 50, 2, 3, 4)],
        "player_address string, net_profit bigint, total_hands bigint, total_buy_in bigint, total_cash_out bigint, "
        "vip_tier string, total_actions bigint, aggression_factor bigint, total_bets bigint, total_raises bigint, "
        "total_calls bigint")
    ranks = lambda df: {r.player_address: r["rank"] for r in df.collect()}
    assert ranks(p.leaderboard(stats, "net_profit")) == {"a": 1, "b": 1, "d": 3}
    assert ranks(p.leaderboard(stats, "net_profit", k=2)) == {"a": 1, "b": 1}
    assert ranks(p.leaderboard(stats, "total_hands")) == {"d": 1, "a": 2, "b": 3}
    board = p.leaderboard(stats, "aggression_factor")
    assert ranks(board) == {"a": 1, "d": 2}
    assert board.filter("player_address = 'd'").select("af", "aggressive_actions", "passive_actions").first() == (
        0.5, 5, 4)


def test_tier_changes_show_the_old_tier_and_skip_missing_ones(spark):
    current = spark.createDataFrame(
        [("a", "bronze", 60_000_000), ("b", "silver", 60_000_000), ("c", None, 60_000_000), ("d", "gold", 0)],
        "player_address string, vip_tier string, current_month_rake bigint")
    assert sorted(map(tuple, loyalty.vip_tier_changes(current).collect())) == [
        ("a", "bronze", "silver", "Monthly rake threshold"), ("d", "gold", "bronze", "Monthly rake threshold")]


def test_play_style_with_showdowns(spark):
    actions = actions_of(spark, [
        ("a", "g", 1, 1, "call", "preflop"), ("a", "g", 2, 2, "raise", "preflop"), ("a", "g", 3, 3, "fold", "preflop"),
        ("a", "g", 4, 4, "raise", "flop"), ("a", "g", 5, 4, "bet", None)])
    seat = "struct<address:string,holeCards:array<string>>"
    states = spark.createDataFrame(
        [("g", 1, "showdown", [("a", ["Ah"]), ("b", [])], [("a", "5")]),
         ("g", 1, "showdown", [("a", ["Ah"])], [("a", "5")]), ("g", 2, "showdown", [("a", ["2c"])], [("b", "5")]),
         ("g", 3, "river", [("a", ["2c"])], [("b", "50")]), ("g", 4, "showdown", [("a", ["2c"])], [])],
        f"game_id string, hand_number int, round string, players array<{seat}>, "
        "winners array<struct<address:string,amount:string>>")
    row = p.play_style(actions, states).first().asDict()
    assert row == dict(player_address="a", total_hands=5, hands_vpip=2, hands_pfr=1, vpip=4000, pfr=2000,
                       hands_to_showdown=2, showdowns_won=1, wtsd=4000, won_at_showdown=5000)


HANDS = [("g", n, 100 - n // 2, f"s{n}", "", "", None) for n in range(12)]


def hands_frame(spark):
    return spark.createDataFrame(HANDS, schemas.TABLES["poker_hands"])


def test_pages(spark):
    hands = hands_frame(spark)
    newest = sorted(HANDS, key=lambda h: (-h[2], -h[1]))
    seen = [(r.hand_number, r.total) for r in k.hands_page(hands, limit=5, offset=3).collect()]
    assert seen == [(h[1], 12) for h in newest[3:8]]
    last = newest[3]
    following = k.hands_after(hands, last[2], last[1], last[0], 4).collect()
    assert [r.hand_number for r in following] == [h[1] for h in newest[4:8]]
    assert k.hands_page(hands, "", 0, -1).count() == 12
    assert {r.total for r in k.hands_page(hands, None, 97, 98).collect()} == {4}
    assert k.hands_page(hands, "none").count() == 0
    for limit, offset in ((0, 0), (1001, 0), (1, -1)):
        with pytest.raises(ValueError):
            k.hands_page(hands, limit=limit, offset=offset)


def test_keyset_pages_meet_every_hand_once(spark):
    rows = [(f"g{n % 5}", n // 5, 100 - n // 20, "", "", "", None) for n in range(60)]
    hands = spark.createDataFrame(rows, schemas.TABLES["poker_hands"])
    seen = [tuple(r)[:3] for r in k.hands_page(hands, limit=7).drop("total").collect()]
    while True:
        game, number, height = seen[-1]
        following = k.hands_after(hands, height, number, game, 7).collect()
        if not following:
            break
        seen += [tuple(r)[:3] for r in following]
    assert seen == sorted((r[:3] for r in rows), key=lambda h: (-h[2], -h[1], h[0]))


def test_details_list_cards_once_with_their_copies(spark):
    hands = hands_frame(spark)
    results = spark.createDataFrame([("g", 1, 9, ["Ah", "Kd"], 2, "", None)], schemas.TABLES["hand_results"])
    shown = [("g", 1, 1, "Ah", "community", 0, None)] * 3 + [("g", 1, 1, "2c", "hole", 1, None)] + [
        ("g", 2, 1, "2c", "hole", at, None) for at in range(130)]
    cards = spark.createDataFrame(shown, schemas.TABLES["revealed_cards"])
    found = k.hand_details(hands, results, cards).collect()
    rows = {(r.hand_number, r.card_type, r.position): (r.community_cards, r.winner_count, r.card, r.times_revealed)
            for r in found}
    assert rows[(1, "community", 0)] == ("Ah,Kd", 2, "Ah", 3) and rows[(1, "hole", 1)] == ("Ah,Kd", 2, "2c", 1)
    assert sum(r.hand_number == 2 for r in found) == 130 and rows[(2, "hole", 129)] == (None, None, "2c", 1)
    assert rows[(3, None, None)] == (None, None, None, 0) and len(rows) == len(found)
    assert [tuple(r) for r in k.hand_cards(cards, "g", 1).collect()] == [
        ("2c", "hole", 1)] + [("Ah", "community", 0)] * 3


def test_summaries_of_nothing(spark):
    hands = spark.createDataFrame([], schemas.TABLES["poker_hands"])
    results = spark.createDataFrame([], schemas.TABLES["hand_results"])
    cards = spark.createDataFrame([], schemas.TABLES["revealed_cards"])
    assert tuple(k.totals(hands, results, cards).first()) == (0, 0, 0, 0, None, None)
    assert k.stats_summary(hands, results, cards).first().block_height_range == "-"
    progress = spark.createDataFrame([], schemas.TABLES["indexing_progress"])
    assert tuple(k.indexing_status(hands, progress).first()) == (0, 0, 0.0, 0, 0, 0, 0)
    stats = p.player_stats(actions_of(spark, []), sessions_of(spark, []))
    assert tuple(p.player_summary(stats).first()) == (0, 0, None, None, None, None, 0, 0, 0, 0, 0)
    assert loyalty.vip_distribution(stats).count() == p.leaderboard(stats, "net_profit").count() == 0
    assert p.action_distribution(actions_of(spark, [])).count() == 0


def test_status_percentages(spark):
    progress = spark.createDataFrame([(200, 101)], schemas.TABLES["indexing_progress"])
    hands = hands_frame(spark)
    assert k.indexing_status(hands, progress).first().percent_complete == pytest.approx(50.5)
    row = k.indexing_status(hands, progress, 800).first()
    assert (row.total_blocks, row.percent_complete) == (800, 25.0)


def test_gaps(spark):
    heights = spark.createDataFrame([(h,) for h in (3, 4, 4, 7, 12)], "height bigint")
    gaps = lambda **kw: sorted(r.missing_block for r in k.scan_gaps(heights, **kw).collect())
    assert gaps() == gaps(width=2) == [5, 6, 8, 9, 10, 11]
    assert gaps(start=1, end=5, width=3) == [1, 2, 5]
    assert gaps(start=9, end=5) == []
    assert k.scan_gaps(heights.limit(0)).count() == 0


def test_top_per_key_and_recent_sessions(spark):
    actions = actions_of(spark, [("a", "g", 1, b, "bet", None) for b in range(30)] + [("b", "g", 1, 1, "bet", None)])
    rows = k.recent_actions(actions, k=3).collect()
    assert sorted((r.player_address, r.block_height, r.rn) for r in rows) == [
        ("a", 27, 3), ("a", 28, 2), ("a", 29, 1), ("b", 1, 1)]
    assert {r.player_address for r in k.recent_actions(actions, "b").collect()} == {"b"}
    sessions = sessions_of(spark, [("a", "g", b, None, 2_500_000, 3_000_000, 0) for b in range(25)])
    latest = k.recent_sessions(sessions).collect()
    assert [r.join_block for r in latest] == list(range(24, 4, -1)) and latest[0].profit_usd == 0.5


def test_session_pages_meet_every_session_once(spark):
    sessions = sessions_of(spark, [("a", f"g{n % 4}", n // 3, None, n, 0, 0) for n in range(40)])
    seen = [tuple(r) for r in k.sessions_page(sessions, "a", 7, with_total=False).collect()]
    while True:
        following = k.sessions_after(sessions, "a", seen[-1][2], seen[-1][1], 7).collect()
        if not following:
            break
        seen += map(tuple, following)
    assert [s[1:3] for s in seen] == sorted([(f"g{n % 4}", n // 3) for n in range(40)], key=lambda s: (-s[1], s[0]))
