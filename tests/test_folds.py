"""Folds against row-at-a-time replays of the same events."""

import random

import pytest
from pyspark.sql import functions as F
from test_decode import events_frame

from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.operators.states import legacy_hands, showdowns
from riverdeck.plans import slices


@pytest.fixture(params=[7, slices.SPAN], ids=["many spans", "one span"])
def hot_rows(request, monkeypatch):
    monkeypatch.setattr(slices, "SPAN", request.param)


def chain(seed, blocks=60, per_block=6):
    """Random events of few games and players, so that keys collide."""
    rng = random.Random(seed)
    for height in range(1, blocks + 1):
        for seq in range(rng.randint(0, per_block)):
            kind = rng.choice(["hand_started", "hand_completed", "player_joined_game", "player_left_game",
                               "player_joined_game", "action_performed"])
            row = dict(height=height, event_seq=seq, type=kind, game_id=f"g{rng.randint(0, 1)}")
            if kind.startswith("hand"):
                row.update(hand_number=str(rng.randint(0, 5)), deck_seed=f"s{rng.randint(0, 99)}",
                           deck=f"d{rng.randint(0, 99)}", winner_count=str(rng.randint(0, 3)),
                           community_cards=rng.choice(["", "Ah,Kd", "2c"]),
                           block_height=rng.choice([None, "x", str(rng.randint(1, 99))]))
            else:
                row.update(player=f"p{rng.randint(0, 2)}", action=rng.choice(["bet", "new-hand"]), amount="1",
                           buy_in_amount=str(rng.randint(1, 99)), refund_amount=str(rng.randint(1, 99)))
            yield row


def stated(row):
    text = row.get("block_height")
    return int(text) if text and text.isdigit() else row["height"]


def replay_hands(rows):
    table = {}
    for r in rows:
        if r["type"] != "hand_started":
            continue
        key = (r["game_id"], int(r["hand_number"]))
        if key in table:
            table[key] = (table[key][0], r["deck_seed"], r["deck"])
        else:
            table[key] = (stated(r), r["deck_seed"], r["deck"])
    return table


def replay_sessions(rows):
    table = {}
    for r in rows:
        player, game = r.get("player"), r["game_id"]
        if r["type"] == "player_joined_game":
            table.setdefault((player, game, r["height"]), [None, int(r["buy_in_amount"]), 0])
        elif r["type"] == "player_left_game":
            for (p, g, _), session in table.items():
                if (p, g) == (player, game) and session[0] is None:
                    session[0], session[2] = r["height"], int(r["refund_amount"])
    return {k: tuple(v) for k, v in table.items()}


def sessions_of(frame):
    return {(r.player_address, r.game_id, r.join_block): (r.leave_block, r.buy_in_amount, r.cash_out_amount)
            for r in frame.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_hands_and_partials_equal_replay(spark, seed):
    rows = list(chain(seed))
    started = ev.started_hands(events_frame(spark, rows))
    expected = replay_hands(rows)
    for frame in (folds.fold_hands(started),
                  folds.merge_hands(folds.partial_hands(started.filter("height % 2 = 0")).unionByName(
                      folds.partial_hands(started.filter("height % 2 = 1"))))):
        assert {(r.game_id, r.hand_number): (r.block_height, r.deck_seed, r.deck)
                for r in frame.collect()} == expected


@pytest.mark.parametrize("seed", range(3))
def test_results_equal_replay(spark, seed):
    rows = list(chain(seed))
    table = {}
    for r in (r for r in rows if r["type"] == "hand_completed"):
        key = (r["game_id"], int(r["hand_number"]))
        cards = r["community_cards"].split(",") if r["community_cards"] else []
        table[key] = (table[key][0] if key in table else stated(r), cards, int(r["winner_count"]))
    folded = folds.fold_results(ev.completed_hands(events_frame(spark, rows)))
    assert {(r.game_id, r.hand_number): (r.block_height, r.community_cards, r.winner_count)
            for r in folded.collect()} == table


@pytest.mark.parametrize("seed", range(4))
def test_sessions_equal_replay(spark, hot_rows, seed):
    rows = list(chain(seed))
    assert sessions_of(folds.fold_sessions(ev.session_events(events_frame(spark, rows)))) == replay_sessions(rows)


def test_session_edge_cases(spark, hot_rows):
    moves = [("left", 1, 0), ("joined", 2, 0), ("joined", 2, 1), ("left", 2, 2), ("joined", 2, 3), ("joined", 5, 0),
             ("joined", 6, 0), ("left", 9, 0), ("left", 9, 1), ("joined", 11, 0)]
    rows = [dict(height=h, event_seq=s, type=f"player_{kind}_game", player="p", game_id="g",
                 buy_in_amount=str(h * 10 + s), refund_amount=str(h * 10 + s)) for kind, h, s in moves]
    found = sessions_of(folds.fold_sessions(ev.session_events(events_frame(spark, rows))))
    assert found == replay_sessions(rows) == {
        ("p", "g", 2): (2, 20, 22), ("p", "g", 5): (9, 50, 90), ("p", "g", 6): (9, 60, 90),
        ("p", "g", 11): (None, 110, 0)}


def replay_legacy(rows, states, app_hash):
    """Row-at-a-time inserts: with a snapshot overwrite seed and deck, without one do nothing on conflict."""
    table = {}
    for r in rows:
        if r["type"] == "hand_started":
            key, value, weak = (r["game_id"], int(r["hand_number"])), (stated(r), r["deck_seed"], r["deck"]), False
        elif r["type"] == "action_performed" and r["action"] == "new-hand":
            known = [s for s in states if s[0] == r["game_id"] and s[1] <= r["height"]]
            seed = app_hash(r["height"])
            if known:
                _, _, number, deck = max(known, key=lambda s: s[1])
                key, value, weak = (r["game_id"], number), (r["height"], seed, deck), False
            else:
                key, value, weak = (r["game_id"], 0), (r["height"], seed, ""), True
        else:
            continue
        if key not in table:
            table[key] = value
        elif not weak:
            table[key] = (table[key][0], *value[1:])
    return table


@pytest.mark.parametrize("seed", range(4))
def test_legacy_hands_equal_replay(spark, hot_rows, seed):
    rows = list(chain(seed))
    rng = random.Random(seed)
    states = [("g0", h, rng.randint(0, 5), f"deck{h}") for h in range(20, 60, 7)]
    events = events_frame(spark, rows)
    headers = spark.createDataFrame([(h, f"H{h}") for h in range(1, 61)], "height bigint, app_hash string")
    snapshots = spark.createDataFrame(states, "game_id string, as_of_block bigint, hand_number int, deck string")

    every = ev.started_hands(events).withColumn("weak", F.lit(False)).unionByName(
        legacy_hands(events, headers, snapshots).drop("tx_hash"))
    found = {(r.game_id, r.hand_number): (r.block_height, r.deck_seed, r.deck)
             for r in folds.fold_hands(every).collect()}
    assert found == replay_legacy(rows, states, lambda h: f"H{h}")


@pytest.mark.parametrize("dedupe", [True, False])
def test_showdowns_equal_replay(spark, hot_rows, dedupe):
    rng = random.Random(5)
    asked = [dict(height=h, event_seq=s, type="action_performed", game_id=f"g{rng.randint(0, 1)}",
                  action=rng.choice(["show", "muck", "fold", "bet"])) for h in range(1, 40) for s in range(3)]
    hands = [["Ah", ""], [], None, ["2c"]]
    snapshots = [(f"g{g}", h, rng.randint(0, 4), rng.choice(["showdown", "river"]),
                  rng.choice([["Kd", "", "Ts"], [], None]), [(f"p{i}", rng.choice(hands)) for i in range(2)],
                  [("p0", "1")] * rng.randint(0, 2)) for g in (0, 1) for h in range(2, 40, 5)]
    states = spark.createDataFrame(
        snapshots, "game_id string, as_of_block bigint, hand_number int, round string, community array<string>, "
                   "players array<struct<address:string,holeCards:array<string>>>, "
                   "winners array<struct<address:string,amount:string>>")
    rows = []
    for r in asked:
        known = [s for s in snapshots if s[0] == r["game_id"] and s[1] <= r["height"]]
        if r["action"] == "bet" or not known:
            continue
        _, _, number, stage, community, players, winners = max(known, key=lambda s: s[1])
        if stage == "showdown" and winners:
            held = [card for _, cards in players for card in cards or []]
            for kind, cards in (("community", community or []), ("hole", held)):
                rows += [(r["game_id"], number, r["height"], card, kind, i, len(winners))
                         for i, card in enumerate(cards) if card]
    if dedupe:
        first = {}
        for row in rows:  # heights only grow
            first.setdefault((row[0], row[1], *row[3:6]), row)
        rows = list(first.values())
    found = showdowns(events_frame(spark, asked), states, dedupe)
    assert rows and sorted(map(tuple, found.collect())) == sorted(rows)


def test_progress_counts_from_the_start_block(spark):
    heights = spark.createDataFrame([(h,) for h in range(150, 431)], "height bigint")
    assert tuple(folds.progress(heights, 150).first()) == (400, 251)
    assert tuple(folds.progress(heights.filter("height < 200"), 150).first()) == (0, 0)


def test_card_dedupe(spark):
    rows = [("g", 1, 10, "Ah", "hole", 0), ("g", 1, 12, "Ah", "hole", 0), ("g", 1, 10, "Ah", "hole", 1)]
    cards = spark.createDataFrame(
        rows, "game_id string, hand_number int, block_height bigint, card string, card_type string, position int")
    assert sorted(tuple(r) for r in folds.dedupe_cards(cards).collect()) == sorted([rows[0], rows[2]])
    assert folds.dedupe_cards(cards, dedupe=False).count() == 3


def test_insert_if_absent_keeps_existing_and_first_incoming(spark):
    old = spark.createDataFrame([("a", 1, 0)], "k string, v int, t int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 3, 2), ("b", 4, 1)], "k string, v int, t int")
    assert sorted(tuple(r) for r in folds.insert_if_absent(old, new, ["k"], ["t"]).collect()) == [
        ("a", 1, 0), ("b", 4, 1)]


def test_the_first_card_row_stays_whole(spark):
    rows = [("g", 1, 10, "Ah", "hole", 0, "2026-01-09"), ("g", 1, 20, "Ah", "hole", 0, "2026-01-01"),
            ("g", 1, 5, "Kd", "hole", 1, "2026-01-02")]
    frame = spark.createDataFrame(rows, "game_id string, hand_number int, block_height bigint, card string, "
                                        "card_type string, position int, indexed_at string")
    assert sorted(tuple(r) for r in folds.dedupe_cards(frame).collect()) == sorted([rows[0], rows[2]])
