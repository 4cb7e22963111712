"""Attribute decoding, document reading, routing."""

import base64
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverdeck import schemas
from riverdeck.functions.attrs import effective_height, lenient_int
from riverdeck.operators import events as ev
from riverdeck.sources import blocks

# Plain words that are valid base64 by themselves.
LOOK_ALIKES = ["fold", "call", "show", "muck", "deck", "1000", "50000000", "a" * 64, "Abcd" * 11]


def b64(text):
    return base64.b64encode(text.encode()).decode()


def event(kind, attributes, encoded=False):
    return {"type": kind, "attributes": [
        {"key": b64(k) if encoded else k, "value": b64(v) if encoded else v, "index": True} for k, v in attributes]}


def block(height, txs=None, begin=None, end=None):
    return {"result": {"height": str(height), "txs_results": txs, "begin_block_events": begin,
                       "end_block_events": end}}


def landed(tmp_path, documents):
    path = tmp_path / "blocks"
    path.mkdir()
    (path / "part.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


def decoded(spark, path, encoding="auto"):
    return [(r.height, r.event_seq, r.type, r.attrs)
            for r in blocks.block_events(spark, path, encoding).orderBy("height", "event_seq").collect()]


def test_event_order_and_missing_lists(spark, tmp_path):
    a, b, c, d = (event(k, [("game_id", k)]) for k in "abcd")
    path = landed(tmp_path, [
        block(1, [{"events": [a]}, {"events": None}, {"events": [b]}], [c], [d]),
        block(2, None, None, [a]), block(3, None, None, None), "{broken", block("x", [{"events": [a]}])])
    assert [(h, s, t) for h, s, t, _ in decoded(spark, path)] == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, "d"), (2, 0, "a")]


@pytest.mark.parametrize("encoded", [False, True])
def test_look_alikes_survive_either_encoding(spark, tmp_path, encoded):
    pairs = [("player", "p1"), ("game_id", "g")]
    events = [event("action_performed", [*pairs, ("action", word), ("deck", word)], encoded) for word in LOOK_ALIKES]
    path = landed(tmp_path, [block(1, [{"events": events}])])
    assert [a["action"] for *_, a in decoded(spark, path)] == LOOK_ALIKES
    assert [a["deck"] for *_, a in decoded(spark, path)] == LOOK_ALIKES


def test_an_event_of_one_plain_deck_key_is_plain(spark, tmp_path):
    path = landed(tmp_path, [block(1, [{"events": [event("x", [("deck", "fold")])]}])])
    assert decoded(spark, path)[0][3] == {"deck": "fold"}


def test_last_duplicate_key_wins_and_values_may_stay_undecodable(spark, tmp_path):
    twice = event("x", [("game_id", "old"), ("player", "p"), ("game_id", "new")])
    odd = event("x", [("game_id", "g")], encoded=True)
    odd["attributes"].append({"key": b64("amount"), "value": "not base64!", "index": False})
    path = landed(tmp_path, [block(1, [{"events": [twice, odd, {"type": "x", "attributes": None}]}])])
    assert [a for *_, a in decoded(spark, path)] == [
        {"game_id": "new", "player": "p"}, {"game_id": "g", "amount": "not base64!"}, {}]


def test_forced_encodings(spark, tmp_path):
    path = landed(tmp_path, [block(1, [{"events": [event("x", [("game_id", "fold")], encoded=True)]}])])
    assert decoded(spark, path, "base64")[0][3] == {"game_id": "fold"}
    assert decoded(spark, path, "plain")[0][3] == {b64("game_id"): b64("fold")}
    with pytest.raises(ValueError):
        blocks.block_events(spark, path, "hex")


@settings(max_examples=8, deadline=None, derandomize=True, database=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(
    st.sampled_from(["game_id", "player", "action", "amount", "deck", "deck_seed"]),
    st.text(st.characters(categories=("L", "N", "P", "S", "Zs")), max_size=8)), min_size=1, max_size=5),
    min_size=1, max_size=6))
def test_both_encodings_decode_alike(spark, tmp_path_factory, lists):
    # An event must carry a key that settles the question; "game_id" always does.
    lists = [[*pairs, ("game_id", "g")] for pairs in lists]
    root = tmp_path_factory.mktemp("enc")
    path = landed(root, [block(1, [{"events": [event("x", p) for p in lists]}]),
                         block(2, [{"events": [event("x", p, True) for p in lists]}])])
    rows = decoded(spark, path)
    half = len(lists)
    assert [r[3] for r in rows[:half]] == [dict(p) for p in lists] == [r[3] for r in rows[half:]]


def test_numbers_are_lenient(spark):
    cases = [("5", 5), ("+5", 5), ("-7", -7), ("", 0), (None, 0), ("x", 0), (" 5", 0), ("5.5", 0), ("1e3", 0),
             ("9223372036854775807", 2**63 - 1), ("99999999999999999999", 2**63 - 1),
             ("-99999999999999999999", -(2**63))]
    frame = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r.n for r in frame.select(lenient_int(F.col("t")).alias("n")).collect()] == [n for _, n in cases]


def test_stated_height_counts_only_when_it_parses(spark):
    frame = spark.createDataFrame(
        [("7", 9), ("x", 9), (None, 9), ("99999999999999999999", 9)], "stated string, height bigint")
    assert [r.h for r in frame.select(effective_height(F.col("stated"), F.col("height")).alias("h")).collect()] == [
        7, 9, 9, 9]


def events_frame(spark, rows):
    """Rows are dicts over the decoded event columns."""
    names = schemas.EVENTS.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.EVENTS)


def test_card_positions_keep_their_index(spark):
    done = ev.completed_hands(events_frame(spark, [
        dict(height=1, event_seq=0, type="hand_completed", game_id="g", hand_number="1",
             community_cards="Ah,,2c", revealed_hole_cards=",Kd"),
        dict(height=2, event_seq=0, type="hand_completed", game_id="g", hand_number="2", community_cards="")]))
    found = {(r.card_type, r.position, r.card) for r in ev.explode_cards(done).collect()}
    assert found == {("community", 0, "Ah"), ("community", 2, "2c"), ("hole", 1, "Kd")}


def test_events_without_player_or_game_are_not_actions(spark):
    rows = [dict(height=1, event_seq=i, type="action_performed", player=p, game_id=g, action="bet", amount="3")
            for i, (p, g) in enumerate([("p", "g"), ("", "g"), ("p", ""), (None, "g"), ("p", None)])]
    assert [(r.player_address, r.amount) for r in ev.actions(events_frame(spark, rows)).collect()] == [("p", 3)]


def test_hand_numbers_beyond_the_column_fail_their_event(spark):
    rows = [dict(height=1, event_seq=i, type="hand_started", game_id="g", hand_number=n)
            for i, n in enumerate(["1", "2147483648", "bad"])]
    assert sorted(r.hand_number for r in ev.started_hands(events_frame(spark, rows)).collect()) == [0, 1]


def test_headers_states_and_status(spark, tmp_path):
    def write(name, documents):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.json").write_text("\n".join(json.dumps(d) for d in documents))
        return str(folder)

    heads = write("heads", [{"result": {"block": {"header": {"height": "3", "app_hash": "AB"}, "data": {"txs": []}}}}])
    assert [tuple(r) for r in blocks.headers(spark, heads).collect()] == [(3, "AB")]
    states = write("states", [
        {"game_id": "g", "as_of_block": 4, "game_state": None},
        {"game_id": "g", "as_of_block": 5,
         "game_state": {"handNumber": 2, "round": "flop", "deck": "d", "winners": []}}])
    assert [(r.as_of_block, r.hand_number, r.winners) for r in blocks.game_states(spark, states).collect()] == [
        (5, 2, [])]
    status = write("status", [{"result": {"sync_info": {"latest_block_height": h}}} for h in ("7", "12", "x")])
    assert blocks.chain_height(spark, status).first()[0] == 12


def test_block_range_and_resume(spark):
    rows = events_frame(spark, [dict(height=h, event_seq=0, type="x") for h in range(1, 11)])
    heights = lambda df: sorted(r.height for r in df.collect())
    assert heights(blocks.block_range(rows, 4, 6)) == [4, 5, 6]
    assert heights(blocks.block_range(rows, 8)) == [8, 9, 10]
    none = spark.createDataFrame([], "block_height bigint")
    some = spark.createDataFrame([(10,)], "block_height bigint")
    assert tuple(blocks.resume_point(none, rows, 5).first()) == (0, 5, 10, False)
    assert tuple(blocks.resume_point(some, rows, 5).first()) == (10, 11, 10, True)


def test_a_line_break_makes_no_number(spark):
    frame = spark.createDataFrame([("12\n",), ("12",)], "t string")
    found = frame.select(lenient_int(F.col("t")).alias("n"), effective_height(F.col("t"), F.lit(7).cast("bigint")).alias("h"))
    assert [tuple(r) for r in found.collect()] == [(0, 7), (12, 12)]
