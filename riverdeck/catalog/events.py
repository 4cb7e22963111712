"""Decoding, routing, folding and state-matching queries over the chain events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverdeck import indexing, staging
from riverdeck.catalog.entry import Entry, over
from riverdeck.constants import ATTRIBUTES
from riverdeck.fixtures import view, with_views
from riverdeck.functions.attrs import decode_attrs, effective_height, is_base64_event, lenient_int
from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.operators import players, states
from riverdeck.schemas import BLOCK_RESULTS
from riverdeck.session import scratch_path
from riverdeck.sources import blocks, tables

EVENTS, LEGACY, MIXED, SHOWDOWN, HANDS, STATES = (
    "fx_events", "fx_legacy_events", "fx_mixed_events", "fx_showdown_events", "fx_poker_hands", "fx_game_states")


NUMBERS = ("amount", "hand_number", "winner_count", "buy_in_amount", "refund_amount", "block_height")


def _raw(spark, sf_dir):
    return blocks.raw_events(spark.read.schema(BLOCK_RESULTS).json(staging.landed_blocks(spark, sf_dir)))


def _decoded(spark, sf_dir):
    return blocks.block_events(spark, staging.landed_blocks(spark, sf_dir))


def _encodings(spark, sf_dir):
    """Every event decoded under the encoding found for it, with that finding."""
    decoded = _raw(spark, sf_dir).withColumn("attrs", decode_attrs(F.col("attributes"))).withColumn(
        "was_base64", is_base64_event(F.col("attributes")))
    return decoded.select("height", "event_seq", "was_base64",
                          *[F.col("attrs")[name].alias(name) for name in ATTRIBUTES])


def _maps(spark, sf_dir):
    pairs = F.transform(F.sort_array(F.map_keys("attrs")), lambda k: F.concat(k, F.lit("="), F.col("attrs")[k]))
    return _decoded(spark, sf_dir).select("height", "event_seq", F.array_join(pairs, ",").alias("attrs"))


def _snapshots(spark, sf_dir):
    found = blocks.game_states(spark, staging.landed_states(spark, sf_dir))
    players_text = F.transform(
        "players", lambda p: F.concat(p["address"], F.lit(":"), F.array_join(p["holeCards"], "+")))
    winners_text = F.transform("winners", lambda w: F.concat(w["address"], F.lit(":"), w["amount"]))
    return found.select("game_id", "as_of_block", "hand_number", "round", "deck",
                        F.array_join("community", ",").alias("community"),
                        F.array_join(players_text, ",").alias("players"),
                        F.array_join(winners_text, ",").alias("winners"))


def _appended(spark, sf_dir):
    root = scratch_path(spark, "appended")
    tables.append_actions(ev.actions(view(spark, sf_dir, EVENTS)), root)
    return tables.read_table(spark, root, "player_actions").select(
        "player_address", "game_id", "block_height", "action", "amount")


def _started(events):
    return folds.fold_hands(ev.started_hands(events))


def _results(events):
    folded = folds.fold_results(ev.completed_hands(events))
    return folded.withColumn("community_cards", F.array_join("community_cards", ","))


def _landed_states(spark, sf_dir):
    return blocks.game_states(spark, staging.landed_states(spark, sf_dir))


def _legacy(spark, sf_dir):
    return states.legacy_hands(
        view(spark, sf_dir, LEGACY), blocks.headers(spark, staging.landed_headers(spark, sf_dir)),
        _landed_states(spark, sf_dir))


def _legacy_fold(spark, sf_dir):
    started = ev.started_hands(view(spark, sf_dir, LEGACY)).withColumn("weak", F.lit(False))
    return folds.fold_hands(started.unionByName(_legacy(spark, sf_dir).drop("tx_hash")))


def _asof(events, snapshots):
    asked = events.select("game_id", "height", "event_seq", "player")
    found = states.state_asof(asked, snapshots)
    return found.select("game_id", "height", "event_seq", "player", "state.as_of_block", "state.hand_number",
                        "state.round", "state.winner_count")


def _showdown_results(spark, sf_dir):
    folded = folds.fold_results(states.showdown_results(view(spark, sf_dir, SHOWDOWN), _landed_states(spark, sf_dir)))
    return folded.withColumn("community_cards", F.array_join("community_cards", ","))


def _index_table(name):
    """One table of a whole indexing run over the mixed chain."""
    def run(spark, sf_dir):
        events = view(spark, sf_dir, MIXED)
        tables_of_run = indexing.index_tables(
            events, events, blocks.headers(spark, staging.landed_headers(spark, sf_dir)),
            _landed_states(spark, sf_dir))
        return tables_of_run[name].drop("indexed_at")

    return run


def _index_results(spark, sf_dir):
    return _index_table("hand_results")(spark, sf_dir).withColumn(
        "community_cards", F.array_join("community_cards", ","))


def _play_style(spark, sf_dir):
    return players.play_style(view(spark, sf_dir, "fx_player_actions"), _landed_states(spark, sf_dir))


HAND_SQL = """
, strong as (select height, event_seq, game_id, cast(hand_number as int) as hand_number,
                    coalesce(try_cast(block_height as bigint), height) as block_height, deck_seed, deck
             from {} where type = 'hand_started')
"""
STARTED_SQL = HAND_SQL.format(EVENTS) + """
select game_id, hand_number, arg_min(block_height, height * 100 + event_seq) as block_height,
       arg_max(deck_seed, height * 100 + event_seq) as deck_seed, arg_max(deck, height * 100 + event_seq) as deck
from strong group by game_id, hand_number
"""
CARDS_SQL = """
, lists as (select game_id, cast(hand_number as int) as hand_number, height as block_height,
                   'community' as card_type, string_split(community_cards, ',') as list
            from fx_events where type = 'hand_completed'
            union all
            select game_id, cast(hand_number as int), height, 'hole', string_split(revealed_hole_cards, ',')
            from fx_events where type = 'hand_completed' and revealed_hole_cards is not null),
  placed as (select * exclude (list), unnest(list) as card, unnest(range(0, len(list))) as position from lists),
  shown as (select game_id, hand_number, block_height, card, card_type, cast(position as int) as position
            from placed where card <> '')
"""
ACTIONS_SQL = """
select player as player_address, game_id, height as block_height, action, cast(amount as bigint) as amount
from fx_events where type = 'action_performed'
"""
RESULTS_SQL = """
, done as (select height * 100 + event_seq as pos, game_id, cast(hand_number as int) as hand_number, height,
                  community_cards, coalesce(try_cast(winner_count as int), 0) as winner_count
           from fx_events where type = 'hand_completed')
select game_id, hand_number, arg_min(height, pos) as block_height, arg_max(community_cards, pos) as community_cards,
       arg_max(winner_count, pos) as winner_count
from done group by game_id, hand_number
"""
SESSION_SQL = """
, moves as (select player as player_address, game_id, height, event_seq, type,
                   cast(coalesce(buy_in_amount, refund_amount, '0') as bigint) as amount
            from fx_events where type in ('player_joined_game', 'player_left_game')),
  joins as (select player_address, game_id, height, min(event_seq) as seq, arg_min(amount, event_seq) as buy_in
            from moves where type = 'player_joined_game' group by player_address, game_id, height),
  paired as (select j.*, m.height as leave_block, m.amount as cash_out,
                    row_number() over (partition by j.player_address, j.game_id, j.height
                                       order by m.height, m.event_seq) as nth
             from joins j left join moves m
               on m.type = 'player_left_game' and m.player_address = j.player_address and m.game_id = j.game_id
              and (m.height > j.height or (m.height = j.height and m.event_seq > j.seq)))
select player_address, game_id, height as join_block, leave_block, buy_in as buy_in_amount,
       coalesce(cash_out, 0) as cash_out_amount
from paired where nth = 1
"""
LEGACY_SQL = """
, asked as (select game_id, height, event_seq from fx_legacy_events where action = 'new-hand'),
  found as (select a.*, s.as_of_block, s.hand_number
            from asked a asof left join fx_game_states s on a.game_id = s.game_id and a.height >= s.as_of_block),
  legacy as (select f.height, f.event_seq, game_id, coalesce(hand_number, 0) as hand_number,
                    f.height as block_height, app_hash as deck_seed, coalesce('d' || hand_number, '') as deck,
                    '' as tx_hash, as_of_block is null as weak
             from found f join fx_headers h on h.height = f.height)
"""
LEGACY_FOLD_SQL = LEGACY_SQL + HAND_SQL.format(LEGACY) + """
, every as (select height * 100 + event_seq as pos, game_id, hand_number, block_height, deck_seed, deck, weak
            from legacy
            union all
            select height * 100 + event_seq, game_id, hand_number, block_height, deck_seed, deck, false from strong)
select game_id, hand_number, arg_min(block_height, pos) as block_height,
       coalesce(arg_max(deck_seed, pos) filter (not weak), arg_min(deck_seed, pos)) as deck_seed,
       coalesce(arg_max(deck, pos) filter (not weak), arg_min(deck, pos)) as deck
from every group by game_id, hand_number
"""
MET_SQL = """
, asked as (select game_id, height, height * 100 + event_seq as pos from fx_showdown_events
            where action in ('show', 'muck', 'fold')),
  met as (select a.game_id, a.height, a.pos, s.as_of_block, s.hand_number, s.round, s.winner_count
          from asked a asof join fx_game_states s on a.game_id = s.game_id and a.height >= s.as_of_block)
"""
SHOWN_SQL = MET_SQL + """
, faces as (select 0 as parity, 'community' as card_type, 0 as position, '2c' as card
            union all select 1, 'community', 0, '2c' union all select 0, 'community', 2, 'Ts'
            union all select 1, 'community', 2, 'Ts' union all select 0, 'hole', 0, 'Ah'
            union all select 0, 'hole', 1, 'Kd' union all select 1, 'hole', 0, '9s')
select game_id, hand_number, min(height) as block_height, card, card_type, cast(position as int) as position,
       arg_min(winner_count, height) as winner_count
from met join faces on parity = as_of_block % 2
where round = 'showdown' and winner_count > 0
group by game_id, hand_number, card, card_type, position
"""
MIXED_SQL = """
, asked as (select game_id, height, height * 100 + event_seq as pos from fx_mixed_events where action = 'fold'),
  met as (select a.game_id, a.height, a.pos, s.as_of_block, s.hand_number, s.winner_count, s.round
          from asked a asof join fx_game_states s on a.game_id = s.game_id and a.height >= s.as_of_block),
  ended as (select game_id, hand_number, height, pos, winner_count, '2c,,Ts' as board,
                   case when as_of_block % 2 = 0 then 'Ah,Kd' else '9s,' end as held
            from met where round = 'showdown' and winner_count > 0
            union all
            select game_id, cast(hand_number as int), height, height * 100 + event_seq,
                   coalesce(try_cast(winner_count as int), 0), community_cards, coalesce(revealed_hole_cards, '')
            from fx_mixed_events where type = 'hand_completed')
"""
STYLE_SQL = """
, acted as (select player_address, game_id, hand_number,
       bool_or(round = 'preflop' and action in ('bet', 'call', 'raise', 'all-in')) as entered,
       bool_or(round = 'preflop' and action in ('raise', 'all-in')) as raised
  from fx_player_actions group by player_address, game_id, hand_number),
  styles as (select player_address, count(*) as total_hands, count(*) filter (entered) as hands_vpip,
                    count(*) filter (raised) as hands_pfr from acted group by player_address),
  shown as (select distinct 'p' || (as_of_block % 15) as player_address, game_id, hand_number
            from fx_game_states where round = 'showdown' and winner_count > 0),
  records as (select player_address, count(*) as hands_to_showdown, count(*) as showdowns_won
              from shown group by player_address)
select player_address, total_hands, hands_vpip, hands_pfr, hands_vpip * 10000 // total_hands as vpip,
       hands_pfr * 10000 // total_hands as pfr, coalesce(hands_to_showdown, 0) as hands_to_showdown,
       coalesce(showdowns_won, 0) as showdowns_won, coalesce(hands_to_showdown, 0) * 10000 // total_hands as wtsd,
       coalesce(showdowns_won * 10000 // hands_to_showdown, 0) as won_at_showdown
from styles left join records using (player_address)
"""

ENTRIES = [
    Entry("decode_block_events", lambda spark, sf: blocks.flatten(_decoded(spark, sf)),
          with_views("select * from fx_events", EVENTS)),
    Entry("attr_base64_decode", _encodings, with_views(
        "select * exclude (type), height % 2 = 1 as was_base64 from fx_events", EVENTS)),
    Entry("attr_map", _maps, with_views("""
, pairs as (unpivot (select * exclude (type) from fx_events)
            on {} into name key value v)
select height, event_seq, string_agg(key || '=' || v, ',' order by key) as attrs from pairs
group by height, event_seq""".format(", ".join(ATTRIBUTES)), EVENTS)),
    Entry("block_headers", lambda spark, sf: blocks.headers(spark, staging.landed_headers(spark, sf)),
          with_views("select * from fx_headers", "fx_headers")),
    Entry("game_state_snapshots", _snapshots, with_views("""
select game_id, as_of_block, hand_number, round, 'd' || hand_number as deck, '2c,,Ts' as community,
       'p' || (as_of_block % 15) || case when as_of_block % 2 = 0 then ':Ah+Kd' else ':9s+' end
         || ',p' || ((as_of_block + 1) % 15) || ':' as players,
       case winner_count when 0 then ''
            when 1 then 'p' || (as_of_block % 15) || ':' || amount
            else 'p' || (as_of_block % 15) || ':' || amount || ',p' || ((as_of_block + 1) % 15) || ':' || amount
       end as winners
from fx_game_states""", STATES)),
    over("block_range", lambda events: blocks.block_range(events, 50, 700), EVENTS,
         "select * from fx_events where height >= 50 and height <= 700"),
    over("block_range_to_latest", lambda events: blocks.block_range(events, 300), EVENTS,
         "select * from fx_events where height >= 300"),
    over("resume_point", lambda hands, events: blocks.resume_point(hands, events, 1), f"{HANDS} {EVENTS}", """
, h as (select coalesce(max(block_height), 0) as last_indexed from fx_poker_hands),
  e as (select coalesce(max(height), 0) as latest_block from fx_events)
select last_indexed, case when last_indexed = 0 then 1 else last_indexed + 1 end as next_block, latest_block,
       case when last_indexed = 0 then 1 else last_indexed + 1 end > latest_block as caught_up
from h cross join e"""),
    over("lenient_int", lambda events: events.select(
        "height", "event_seq", *[lenient_int(F.col(name)).alias(name) for name in NUMBERS]), EVENTS, """
select height, event_seq, {} from fx_events""".format(
        ", ".join(f"coalesce(try_cast({name} as bigint), 0) as {name}" for name in NUMBERS))),
    over("height_override", lambda events: events.select(
        "height", "event_seq", effective_height(F.col("block_height"), F.col("height")).alias("value")), EVENTS, """
select height, event_seq, coalesce(try_cast(block_height as bigint), height) as value from fx_events"""),
    over("event_route", ev.event_counts, EVENTS, "select type, count(*) as n from fx_events group by type"),
    over("cards_explode", lambda events: ev.explode_cards(ev.completed_hands(events)), EVENTS,
         CARDS_SQL + "select * from shown"),
    Entry("append_actions", _appended, with_views(ACTIONS_SQL, EVENTS)),
    over("hands_fold", _started, EVENTS, STARTED_SQL),
    over("results_fold", _results, EVENTS, RESULTS_SQL),
    over("sessions_fold", lambda events: folds.fold_sessions(ev.session_events(events)).drop("join_seq"), EVENTS,
         SESSION_SQL),
    over("state_asof", _asof, f"{EVENTS} {STATES}", """
select e.game_id, e.height, e.event_seq, e.player, s.as_of_block, s.hand_number, s.round, s.winner_count
from fx_events e asof left join fx_game_states s on e.game_id = s.game_id and e.height >= s.as_of_block"""),
    Entry("legacy_new_hand", lambda spark, sf: _legacy(spark, sf).drop("height", "event_seq"), with_views(
        LEGACY_SQL + "select * exclude (height, event_seq) from legacy", LEGACY, "fx_headers", STATES)),
    Entry("hands_fold_legacy", _legacy_fold, with_views(LEGACY_FOLD_SQL, LEGACY, "fx_headers", STATES)),
    Entry("showdown_extract", lambda spark, sf: states.showdowns(
        view(spark, sf, SHOWDOWN), _landed_states(spark, sf)), with_views(SHOWN_SQL, SHOWDOWN, STATES)),
    Entry("showdown_results", _showdown_results, with_views(MET_SQL + """
select game_id, hand_number, arg_min(height, pos) as block_height, '2c,,Ts' as community_cards,
       arg_max(winner_count, pos) as winner_count
from met where round = 'showdown' and winner_count > 0 group by game_id, hand_number""", SHOWDOWN, STATES)),
    Entry("index_hand_results", _index_results, with_views(MIXED_SQL + """
select game_id, hand_number, arg_min(height, pos) as block_height, arg_max(board, pos) as community_cards,
       arg_max(winner_count, pos) as winner_count, '' as tx_hash
from ended group by game_id, hand_number""", MIXED, STATES)),
    Entry("index_revealed_cards", _index_table("revealed_cards"), with_views(MIXED_SQL + """
, lists as (select game_id, hand_number, height, 'community' as card_type, string_split(board, ',') as list from ended
            union all select game_id, hand_number, height, 'hole', string_split(held, ',') from ended),
  placed as (select * exclude (list), unnest(list) as card, unnest(range(0, len(list))) as position from lists)
select game_id, hand_number, min(height) as block_height, card, card_type, cast(position as int) as position
from placed where card <> '' group by game_id, hand_number, card, card_type, position""", MIXED, STATES)),
    Entry("biggest_pot", lambda spark, sf: states.biggest_pot(_landed_states(spark, sf)), with_views("""
, wins as (select 'p' || (as_of_block % 15) as player_address, amount from fx_game_states where winner_count >= 1
           union all
           select 'p' || ((as_of_block + 1) % 15), amount from fx_game_states where winner_count >= 2)
select player_address, max(amount) as biggest_pot_won from wins group by player_address""", STATES)),
    Entry("play_style_showdown", _play_style, with_views(STYLE_SQL, "fx_player_actions", STATES)),
]
