"""Streams against batch: restarts, replays, progress. (Full runs are in test_queries.)"""

import json
import re

import pytest
from pyspark.sql import functions as F
from test_decode import block, event, events_frame
from test_folds import chain, replay_hands, replay_sessions, sessions_of

from riverdeck import schemas, staging
from riverdeck.operators.events import actions
from riverdeck.operators.lookup import scan_gaps
from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.operators.states import legacy_hands, showdown_results
from riverdeck.streaming import counters, hands, ingest, logs, matches, sessions, tables


def land(spark, folder, rows):
    """One more file in the landing folder."""
    events_frame(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))


def tail(spark, folder):
    return spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.fixture
def parts():
    rows = list(chain(7))
    cut = [0, 15, 16, 40, 61]
    return rows, [[r for r in rows if lo <= r["height"] < hi] for lo, hi in zip(cut, cut[1:])]


def test_hands_and_sessions_go_on_after_a_restart(spark, tmp_path, parts):
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for portion in (files[:2], files[2:]):
        for rows_of_file in portion:
            land(spark, landing, rows_of_file)
        hands.start_hands(tail(spark, landing), f"{out}/h", f"{out}/hc").awaitTermination()
        sessions.start_sessions(tail(spark, landing), f"{out}/s", f"{out}/sc").awaitTermination()
    assert logs.last_commit(spark, f"{out}/h") == 3
    found = hands.current_hands(spark, f"{out}/h")
    assert {(r.game_id, r.hand_number): (r.block_height, r.deck_seed, r.deck)
            for r in found.collect()} == replay_hands(rows)
    assert sessions_of(sessions.current_sessions(spark, f"{out}/s")) == replay_sessions(rows)


def test_batches_without_sessions_keep_what_is_open(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    join = dict(height=1, event_seq=0, type="player_joined_game", player="p", game_id="g", buy_in_amount="5")
    leave = dict(height=9, event_seq=0, type="player_left_game", player="p", game_id="g", refund_amount="8")
    other = dict(height=5, event_seq=0, type="hand_started", game_id="g")
    for i, row in enumerate([other, join, other, {**other, "height": 6}, leave, other]):
        land(spark, landing, [row])
        sessions.start_sessions(tail(spark, landing), f"{out}/s", f"{out}/c").awaitTermination()
        expected = {} if i == 0 else {("p", "g", 1): (9, 5, 8) if i >= 4 else (None, 5, 0)}
        assert sessions_of(sessions.current_sessions(spark, f"{out}/s")) == expected


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    out = str(tmp_path)
    rows = spark.createDataFrame([("k", 1)], "k string, v int")
    for _ in range(2):
        logs.write_batch(rows, out, "x", 0)
    logs.commit(spark, out, 0)
    logs.write_batch(rows, out, "x", 1)  # never committed
    assert [tuple(r) for r in logs.read_log(spark, out, "x", rows.schema).collect()] == [("k", 1, 0)]


def put_blocks(landing, name, heights, with_events=True):
    landing.mkdir(exist_ok=True)
    pairs = [("game_id", "g"), ("player", "p")]
    documents = [block(h, [{"events": [event("action_performed", pairs, h % 2 == 1)] * (2 if with_events else 0)}])
                 for h in heights]
    (landing / name).write_text("\n".join(json.dumps(d) for d in documents))


def test_ingest_resumes_and_reports_progress(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    put_blocks(landing, "a.json", [*range(1, 121), 7])
    ingest.start_ingest(spark, str(landing), out, checkpoint).awaitTermination()
    assert ingest.landed_events(spark, out).count() == 240
    assert tuple(ingest.landed_progress(spark, out).first()) == (100, 100)
    put_blocks(landing, "b.json", range(121, 251))
    ingest.start_ingest(spark, str(landing), out, checkpoint).awaitTermination()
    assert ingest.landed_events(spark, out).agg(F.countDistinct("height"), F.count("*")).first() == (250, 500)
    assert tuple(ingest.landed_progress(spark, out).first()) == (200, 200)
    figures = ingest.landed_figures(spark, out, chain_height=500).orderBy("batch_id").collect()
    assert [(r.batch_id, r.blocks, r.last_height, r.events, r.action_performed, r.hand_started) for r in figures] == [
        (0, 120, 120, 240, 240, 0), (1, 130, 250, 260, 260, 0)]
    assert [r.percent for r in figures] == [24.0, 50.0]
    assert figures[1].seconds_left == pytest.approx(250 / figures[1].blocks_per_second) and figures[1].seconds > 0


def test_ingest_drops_replays_of_earlier_batches_and_takes_late_blocks(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    for name, heights in (("a.json", [1, 2, 4]), ("b.json", [2, 3, 4, 5]), ("c.json", [1, 2]), ("d.json", [9])):
        put_blocks(landing, name, heights)
        ingest.start_ingest(spark, str(landing), out, checkpoint).awaitTermination()
    found = ingest.landed_events(spark, out).select("height", "event_seq").collect()
    assert sorted(map(tuple, found)) == [(h, s) for h in (1, 2, 3, 4, 5, 9) for s in (0, 1)]
    gaps = scan_gaps(ingest.landed_heights(spark, out)).collect()
    assert sorted(r.missing_block for r in gaps) == [6, 7, 8]


def test_blocks_without_events_count_as_scanned(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    put_blocks(landing, "a.json", range(150, 231), with_events=False)
    ingest.start_ingest(spark, str(landing), out, str(tmp_path / "c"), start_block=150).awaitTermination()
    assert ingest.landed_events(spark, out).count() == 0
    assert tuple(ingest.landed_progress(spark, out).first()) == (200, 51)
    assert scan_gaps(ingest.landed_heights(spark, out)).count() == 0


def test_landed_events_prune_folders_and_columns(spark, tmp_path):
    out = str(tmp_path / "out")
    put_blocks(tmp_path / "in", "a.json", [1, 2])
    ingest.start_ingest(spark, str(tmp_path / "in"), out, str(tmp_path / "c")).awaitTermination()
    rows = actions(ingest.landed_events(spark, out)).select("player_address")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 4
    assert "(type#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<game_id:string,player:string>" in plan


def test_counters_equal_batch_after_restart(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    schema = schemas.TABLES["revealed_cards"]
    expected = {}
    for number, cards in enumerate((["Ah", "Ah", "10S"], ["Ah", "2c"])):
        rows = [("g", 1, 1, c, "hole" if number else "community", 0, None) for c in cards]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(landing))
        counts = counters.card_counters(
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(landing)))
        counters.start_counters(counts, out, str(tmp_path / "c")).awaitTermination()
        expected = {"Ah": (2, 2, 0)} if number == 0 else {"Ah": (3, 2, 1), "2c": (1, 0, 1)}
        found = counters.current_counts(spark, out, counts.schema, "card").collect()
        assert {r.card: (r.total, r.community, r.hole) for r in found} == expected


def test_replays_are_dropped_and_late_events_kept(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    rows = [dict(height=h, event_seq=s, type="x") for h in (5000, *range(1, 9)) for s in range(3)]
    for part in (rows[:12], rows[6:], rows[:3], rows[4:6] + rows[4:6]):
        land(spark, landing, part)
        ingest.start_dedupe(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    found = ingest.landed_events(spark, out)
    assert sorted((r.height, r.event_seq) for r in found.collect()) == sorted((r["height"], r["event_seq"]) for r in rows)


def test_replayed_joins_open_no_second_session(spark, tmp_path, parts):
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for part in (files[0], files[1], files[0], files[2], [*files[1], *files[2]], *files[3:]):
        land(spark, landing, part)
        sessions.start_sessions(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    found = sessions.current_sessions(spark, out)
    assert sessions_of(found) == replay_sessions(rows)
    assert found.count() == found.select("player_address", "game_id", "join_block").distinct().count()


def forget_last_checkpoint_commit(checkpoint):
    """As if the driver was lost after a batch's own commit row, before Spark noted the batch as done."""
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)


def test_committed_batch_that_reaches_back_runs_again(spark, tmp_path, parts):
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for part in ([*files[0], *files[1]], [*files[1], *files[2], *files[3]]):
        land(spark, landing, part)
        ingest.start_dedupe(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    forget_last_checkpoint_commit(tmp_path / "c")
    ingest.start_dedupe(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    found = ingest.landed_events(spark, out).select("height", "event_seq").collect()
    assert sorted(map(tuple, found)) == sorted((r["height"], r["event_seq"]) for r in rows)


def test_committed_session_batch_that_reaches_back_runs_again(spark, tmp_path, parts):
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for part in ([*files[0], *files[1]], [*files[1], *files[2], *files[3]]):
        land(spark, landing, part)
        sessions.start_sessions(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    forget_last_checkpoint_commit(tmp_path / "c")
    sessions.start_sessions(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    assert sessions_of(sessions.current_sessions(spark, out)) == replay_sessions(rows)


def test_old_commit_rows_go_but_the_high_mark_stays(spark, tmp_path):
    out = str(tmp_path)
    for batch in range(25):
        logs.commit(spark, out, batch, high=100 if batch == 0 else max(100, batch))
    assert logs.high_before(spark, out, 25) == 100 and logs.last_commit(spark, out) == 24


def test_compacted_logs_say_the_same_after_restarts(spark, tmp_path, parts):
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for part in (*files, [], files[0]):
        land(spark, landing, part)
        tables.start_tables(tail(spark, landing), f"{out}/t", f"{out}/tc").awaitTermination()
        hands.start_hands(tail(spark, landing), f"{out}/h", f"{out}/hc").awaitTermination()
        sessions.start_sessions(tail(spark, landing), f"{out}/s", f"{out}/sc").awaitTermination()
        tables.compact_tables(spark, f"{out}/t")
        hands.compact_hands(spark, f"{out}/h")
        sessions.compact_sessions(spark, f"{out}/s")
    completed = ev.completed_hands(events_frame(spark, rows))
    same = lambda a, b: sorted(map(str, a.select(*sorted(b.columns)).collect())) == sorted(
        map(str, b.select(*sorted(b.columns)).collect()))
    assert same(tables.current_results(spark, f"{out}/t"), folds.fold_results(completed))
    assert same(tables.current_cards(spark, f"{out}/t"), folds.dedupe_cards(ev.explode_cards(completed)))
    assert {(r.game_id, r.hand_number): (r.block_height, r.deck_seed, r.deck)
            for r in hands.current_hands(spark, f"{out}/h").collect()} == replay_hands(rows)
    assert sessions_of(sessions.current_sessions(spark, f"{out}/s")) == replay_sessions(rows)
    for name in ("t/results", "t/cards", "h/partials", "s/sessions"):  # the newest batch, beside one base
        assert len(list((tmp_path / "out" / name).glob(f"{logs.BATCH}=*"))) == 1
        assert len(list((tmp_path / "out" / f"{name}-base").glob(f"{logs.BATCH}=*"))) == 1


def test_sessions_restart_after_compaction(spark, tmp_path, parts):
    """The newest batch runs again after the ones before it were merged."""
    rows, files = parts
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        query = sessions.start_sessions(tail(spark, landing), out, str(tmp_path / "c"))
        query.awaitTermination()
        return query

    for part in files[:3]:
        land(spark, landing, part)
        run()
    sessions.compact_sessions(spark, out)
    forget_last_checkpoint_commit(tmp_path / "c")
    land(spark, landing, files[3])
    query = run()
    expected = replay_sessions(rows)
    assert sessions_of(sessions.current_sessions(spark, out)) == expected
    keys = {k[:2] for k, v in expected.items() if v[0] is None}
    recent = {(r["player"], r["game_id"]) for r in rows if r.get("player") and r["height"] >= rows[-1]["height"] - 30}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= len(keys | recent)


def test_late_moves_within_the_window_count(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    join = lambda h: dict(height=h, event_seq=0, type="player_joined_game", player="p", game_id="g", buy_in_amount="5")
    leave = lambda h: dict(height=h, event_seq=1, type="player_left_game", player="p", game_id="g", refund_amount="8")
    for row in (join(1), join(6), leave(9), leave(4), join(100), join(3)):  # the first leave comes late, the last join too late
        land(spark, landing, [row])
        sessions.start_sessions(tail(spark, landing), out, str(tmp_path / "c"), late_blocks=10).awaitTermination()
    assert sessions_of(sessions.current_sessions(spark, out)) == {
        ("p", "g", 1): (4, 5, 8), ("p", "g", 6): (9, 5, 8), ("p", "g", 100): (None, 5, 0)}


STATES = ("game_id string, as_of_block bigint, hand_number int, round string, deck string, community array<string>, "
          "players array<struct<address:string,seat:int,stack:string,holeCards:array<string>,status:string>>, "
          "winners array<struct<address:string,amount:string,cards:array<string>>>")


def test_streamed_matches_equal_batch(spark, tmp_path):
    """Snapshots run behind the events, then ahead; a batch runs again; the log is compacted between."""
    rows = [{**r, "action": ("new-hand", "fold", "show", "bet")[r["event_seq"] % 4]} for r in chain(3) if r["type"] == "action_performed"]
    snapshots = [(f"g{h % 2}", h, h % 5, "showdown" if h % 3 else "river", f"deck{h}", ["Kd", "", "Ts"] if h % 4 else None,
                  [("p", 0, "1", ["Ah", ""] if h % 2 else None, "x")], [("p", "1", None)] * (h % 3)) for h in range(3, 60, 4)]
    out = str(tmp_path / "out")
    all_events, all_states = events_frame(spark, rows), spark.createDataFrame(snapshots, STATES)
    for lo, hi, slo, shi in ((0, 30, 0, 5), (30, 50, 5, 30), (0, 0, 30, 61), (50, 61, 0, 0)):
        all_events.filter(f"height >= {lo} and height < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
        all_states.filter(f"as_of_block >= {slo} and as_of_block < {shi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
        for _ in range(2):
            matches.start_matches(
                spark.readStream.schema(schemas.EVENTS).parquet(str(tmp_path / "e")),
                spark.readStream.schema(all_states.schema).parquet(str(tmp_path / "s")), out, str(tmp_path / "c")).awaitTermination()
            if hi == 50:
                forget_last_checkpoint_commit(tmp_path / "c")
            else:
                break
        matches.compact_matches(spark, out)
    headers = spark.createDataFrame([(h, f"H{h}") for h in range(61)], "height bigint, app_hash string")
    same = lambda a, b: sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
    assert same(matches.current_legacy_hands(spark, out, headers), legacy_hands(all_events, headers, all_states))
    expected = showdown_results(all_events, all_states)
    assert expected.count() > 5 and same(matches.current_showdown_results(spark, out), expected)


def test_closed_hands_leave_the_open_log(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    rows = [dict(height=h, event_seq=s, type=kind, game_id="g", hand_number=str(h), deck_seed=f"s{h}", deck="d")
            for h in range(1, 41) for s, kind in enumerate(("hand_started", "hand_completed"))]
    again = dict(height=41, event_seq=0, type="hand_started", game_id="g", hand_number="5", deck_seed="new", deck="d")
    most = 0
    for part in (rows[:30], rows[30:60], rows[60:], [again]):
        land(spark, landing, part)
        query = hands.start_hands(tail(spark, landing), out, str(tmp_path / "c"), close_after=3)
        query.awaitTermination()
        hands.compact_closing_hands(spark, out)
        most = max(most, hands.open_hands(spark, out).count())
    found = {(r.game_id, r.hand_number): (r.block_height, r.deck_seed, r.deck) for r in hands.current_hands(spark, out, closing=True).collect()}
    assert found == replay_hands([*rows, again])
    # what one batch brought and what had not closed before it, not the 40 hands there were
    assert most <= 36 and hands.closed_hands(spark, out).count() >= 30
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 16
    assert "5" in {str(r.hand_number) for r in hands.open_hands(spark, out).collect()}


def test_unreadable_documents_are_kept_with_their_reason(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    put_blocks(landing, "a.json", [1, 2])
    (landing / "b.json").write_text("\n".join(
        ['{"result": {"height": "x7"}}', '{"result": {}}', '{"error": "timeout"}', '{"result": {"height": "4"', json.dumps(block(5, []))]))
    ingest.start_ingest(spark, str(landing), out, str(tmp_path / "c")).awaitTermination()
    found = ingest.landed_quarantine(spark, out).collect()
    assert sorted(r.reason for r in found) == ["height is no number", "no height", "no result", "not a block-result document"]
    assert {r.file.rsplit("/", 1)[1] for r in found} == {"b.json"}
    assert '{"result": {"height": "4"' in {r.document for r in found}
    assert [(r.blocks, r.unreadable) for r in ingest.landed_figures(spark, out).collect()] == [(3, 4)]
    assert sorted(r.height for r in ingest.landed_heights(spark, out).collect()) == [1, 2, 5]


def test_refill_lands_what_is_missing_once(spark, tmp_path):
    landing, fetched, out = tmp_path / "in", tmp_path / "fetched", str(tmp_path / "out")
    run = lambda: ingest.start_ingest(spark, str(landing), out, str(tmp_path / "c")).awaitTermination()
    refill = lambda: ingest.start_refill(spark, str(fetched), out, str(tmp_path / "r")).awaitTermination()
    events = lambda: sorted((r.height, r.event_seq) for r in ingest.landed_events(spark, out).collect())
    asked = lambda **kw: sorted(map(tuple, ingest.refill_requests(spark, out, **kw).collect()))
    put_blocks(landing, "a.json", [1, 2, 6, 7, 9])
    run()
    assert asked() == [(3, 5), (8, 8)] and asked(end=12) == [(3, 5), (8, 8), (10, 12)]
    put_blocks(fetched, "f.json", [3, 4, 7])  # 7 is there already
    refill()
    assert asked() == [(5, 5), (8, 8)]
    put_blocks(landing, "b.json", [4, 5, 10])  # 4 comes by the main stream after all
    run()
    put_blocks(fetched, "g.json", [8, 3])
    refill()
    assert asked() == [] and events() == [(h, s) for h in range(1, 11) for s in (0, 1)]


def files_read(frame):
    """Batch folders that the scans of a plan keep."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    asked = re.findall(r"batch_id#\d+L? (?:IN \(([\d,]+)\)|= (\d+))", plan)
    return {batch for several, one in asked for batch in (several or one).split(",")}


def test_a_straggler_reads_the_batches_that_hold_its_block(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    event_at = lambda h: dict(height=h, event_seq=0, type="x")
    for heights in ([1, 2, 3], [10, 11], [4, 20, 21], [30]):
        land(spark, landing, [event_at(h) for h in heights])
        ingest.start_dedupe(tail(spark, landing), out, str(tmp_path / "c")).awaitTermination()

    def looked(*heights):
        rows = events_frame(spark, [event_at(h) for h in heights])
        fresh = logs.unseen(rows, out, "events", 9, ["height", "event_seq"], "height", min(heights), 30)
        return sorted(r.height for r in fresh.collect()), files_read(fresh)

    assert looked(2, 40) == ([40], {"0"})
    assert looked(20) == ([], {"2"})
    assert looked(4, 11, 12) == ([12], {"1", "2"})
    assert looked(5, 25) == ([5, 25], set())  # no batch landed them: nothing is read
    assert looked(31, 99) == ([31, 99], set())


def test_small_keys_share_entries_of_the_state_store(spark, tmp_path):
    """A call of Python and an entry per hand or player would cost milliseconds each."""
    rows = [dict(height=h, event_seq=0, type="hand_started", game_id="g", hand_number=str(h), deck_seed="s", deck="d") for h in range(1, 128)]
    joins = [dict(height=1, event_seq=n, type="player_joined_game", player=f"p{n}", game_id="g", buy_in_amount="5") for n in range(6000)]
    land(spark, tmp_path / "in", rows)
    land(spark, tmp_path / "joins", joins)
    query = hands.start_hands(tail(spark, tmp_path / "in"), str(tmp_path / "h"), str(tmp_path / "hc"), close_after=3)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    assert hands.current_hands(spark, str(tmp_path / "h"), closing=True).count() == 127
    query = sessions.start_sessions(tail(spark, tmp_path / "joins"), str(tmp_path / "s"), str(tmp_path / "sc"))
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4096
    assert sessions.current_sessions(spark, str(tmp_path / "s")).count() == 6000


def test_matches_cross_the_spans_of_a_game(spark, tmp_path, monkeypatch):
    """A hot game is cut up by spans of blocks; snapshots of one serve the events of all that follow without any."""
    monkeypatch.setattr(matches, "SPAN", 4)
    asked = [dict(height=h, event_seq=s, type="action_performed", game_id=f"g{s % 2}", player="p", action=("new-hand", "fold")[h % 2])
             for h in range(1, 60) for s in range(2)]
    snapshots = [(f"g{h % 2}", h, h, "showdown", f"deck{h}", ["Kd"], [("p", 0, "1", ["Ah"], "x")], [("p", "1", None)])
                 for h in (3, 6, 8, 9, 10, 31, 32, 33, 50)]
    out, all_events, all_states = str(tmp_path / "out"), events_frame(spark, asked), spark.createDataFrame(snapshots, STATES)
    for lo, hi, slo, shi in ((0, 20, 0, 9), (20, 40, 9, 32), (40, 60, 32, 60)):
        all_events.filter(f"height >= {lo} and height < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
        all_states.filter(f"as_of_block >= {slo} and as_of_block < {shi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
        query = matches.start_matches(
            spark.readStream.schema(schemas.EVENTS).parquet(str(tmp_path / "e")),
            spark.readStream.schema(all_states.schema).parquet(str(tmp_path / "s")), out, str(tmp_path / "c"))
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] > 2  # more entries than games
        matches.compact_matches(spark, out)
    headers = spark.createDataFrame([(h, f"H{h}") for h in range(61)], "height bigint, app_hash string")
    same = lambda a, b: sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
    assert same(matches.current_legacy_hands(spark, out, headers), legacy_hands(all_events, headers, all_states))
    assert same(matches.current_showdown_results(spark, out), showdown_results(all_events, all_states))


def test_documents_are_dealt_out_once(spark, sf_dir, tmp_path):
    """Events move once, by range of blocks; documents land where they are put together, compressed."""
    events = events_frame(spark, list(chain(2)))
    documents = staging.sliced_documents(events, 3)
    assert len(re.findall(r"Exchange \w+partitioning", documents._jdf.queryExecution().executedPlan().toString())) == 1
    documents.write.json(str(tmp_path / "in"))
    parts = [{r[0] for r in spark.read.json(str(f)).select(F.col("result.height").cast("int")).collect()} for f in (tmp_path / "in").glob("part-*")]
    parts = sorted(part for part in map(sorted, parts) if part)
    assert [h for part in parts for h in part] == sorted({r["height"] for r in chain(2)}) and len(parts) == 3
    assert all(f.endswith(".json.gz") for f in spark.read.text(staging.landed_blocks(spark, sf_dir)).inputFiles())
