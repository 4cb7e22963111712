"""Streaming queries: tables land portion by portion, the stream takes up each portion where
it left off, and the final state is returned. It must equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverdeck import staging
from riverdeck.catalog.entry import Entry
from riverdeck.catalog.events import (
    ACTIONS_SQL, CARDS_SQL, LEGACY, LEGACY_FOLD_SQL, RESULTS_SQL, SESSION_SQL, SHOWDOWN, SHOWN_SQL, STARTED_SQL, STATES)
from riverdeck.catalog.hands import PROGRESS
from riverdeck.catalog.players import STATS_SQL, STATS_VIEWS
from riverdeck.constants import ROUTED_TYPES
from riverdeck.fixtures import view, with_views
from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.session import scratch_path, slice_count
from riverdeck.sources import blocks
from riverdeck.streaming import counters, hands, ingest, matches, profiles, sessions, tables

BATCHES = 4


def _ingested(spark, sf_dir):
    root = scratch_path(spark, "ingest")
    per_batch = max(1, slice_count(spark) // BATCHES)
    ingest.start_ingest(
        spark, staging.landed_blocks(spark, sf_dir), f"{root}/out", f"{root}/checkpoint",
        files_per_batch=per_batch).awaitTermination()
    return f"{root}/out"


def _figures(spark, sf_dir):
    """The logged figures of all batches, but for the time they took."""
    counts = ["blocks", "events", "unreadable", *ROUTED_TYPES]
    return ingest.landed_figures(spark, _ingested(spark, sf_dir)).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in counts], F.max("last_height").alias("last_height"))


def _refill(spark, sf_dir):
    """The chain lands without one in four stretches of 25 blocks; what is asked for then lands by a second stream,
    and so does a stretch that is there already."""
    root, events = scratch_path(spark, "refill"), view(spark, sf_dir, "fx_events")
    stretch = F.floor(F.col("height") / 25) % 4
    for rows, folder in ((events.filter(stretch != 1), "landing"), (events.filter(stretch.isin(1, 2)), "fetched")):
        staging.block_documents(rows).write.json(f"{root}/{folder}")
    ingest.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    ingest.start_refill(spark, f"{root}/fetched", f"{root}/out", f"{root}/checkpoint-refill").awaitTermination()
    return ingest.landed_events(spark, f"{root}/out")


def _taken_up(frames, spark, name, start):
    """Land each frame and run the stream `start(stream, out, checkpoint)` until it has taken
    it up; gives the output folder."""
    root = scratch_path(spark, name)
    for frame in frames:
        frame.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(frame.schema).parquet(f"{root}/landing")
        start(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _counted(aggregate, name, key):
    def run(spark, sf_dir):
        table = view(spark, sf_dir, name)
        out = _taken_up(
            staging.portions(table, "block_height"), spark, name,
            lambda stream, out, checkpoint: counters.start_counters(aggregate(stream), out, checkpoint))
        return counters.current_counts(spark, out, aggregate(table).schema, key)

    return run


def _hands(spark, sf_dir):
    events = view(spark, sf_dir, "fx_events")
    return hands.current_hands(
        spark, _taken_up(staging.portions(events, "height"), spark, "hands", hands.start_hands))


def _sessions(spark, sf_dir):
    events = view(spark, sf_dir, "fx_events")
    first, *others = staging.portions(events, "height")
    out = _taken_up([first, *others, first], spark, "sessions", sessions.start_sessions)  # the first lands twice
    return sessions.current_sessions(spark, out).drop("join_seq")


def _closing_hands(spark, sf_dir):
    """Hands that close ten blocks after they complete; the open log is compacted after every portion."""
    def start(stream, out, checkpoint):
        query = hands.start_hands(stream, out, checkpoint, close_after=10)
        query.awaitTermination()
        hands.compact_closing_hands(spark, out)
        return query

    events = view(spark, sf_dir, "fx_events")
    return hands.current_hands(spark, _taken_up(staging.portions(events, "height"), spark, "closing", start), closing=True)


def _matched(spark, sf_dir, name):
    """Events and snapshots land in portions of their own, the snapshots one portion behind."""
    root = scratch_path(spark, "matched")
    events, states = view(spark, sf_dir, name), blocks.game_states(spark, staging.landed_states(spark, sf_dir))
    landing = [*staging.portions(events, "height", 2), None], [None, *staging.portions(states, "as_of_block", 2)]
    for event_part, state_part in zip(*landing):
        for frame, folder in ((event_part, "events"), (state_part, "states")):
            (events.limit(0) if frame is None and folder == "events" else states.limit(0) if frame is None else frame
             ).write.mode("append").parquet(f"{root}/{folder}")
        matches.start_matches(spark.readStream.schema(events.schema).parquet(f"{root}/events"),
                              spark.readStream.schema(states.schema).parquet(f"{root}/states"),
                              f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _legacy_hands(spark, sf_dir):
    headers = blocks.headers(spark, staging.landed_headers(spark, sf_dir))
    legacy = matches.current_legacy_hands(spark, _matched(spark, sf_dir, LEGACY), headers)
    started = ev.started_hands(view(spark, sf_dir, LEGACY)).withColumn("weak", F.lit(False))
    return folds.fold_hands(started.unionByName(legacy.drop("tx_hash")))


def _tables(current, compacted=False):
    """The streamed tables, of which `current` reads one; `compacted`, after a base was made halfway."""
    def run(spark, sf_dir):
        def start(stream, out, checkpoint):
            query = tables.start_tables(stream, out, checkpoint)
            query.awaitTermination()
            if compacted:
                tables.compact_tables(spark, out)
            return query

        events = view(spark, sf_dir, "fx_events")
        return current(spark, _taken_up(staging.portions(events, "height"), spark, "tables", start))

    return run


def _player_stats(spark, sf_dir):
    """Player figures refreshed by portions of the actions; the logs are compacted after each."""
    def start(stream, out, checkpoint):
        query = profiles.start_players(stream, out, checkpoint)
        query.awaitTermination()
        profiles.compact_players(spark, out)
        return query

    actions, *others = [view(spark, sf_dir, name) for name in STATS_VIEWS.split()]
    out = _taken_up(staging.portions(actions, "block_height", 4), spark, "players", start)
    return profiles.current_player_stats(spark, out, *others).drop("biggest_pot_won")


def _results(spark, out):
    return tables.current_results(spark, out).withColumn("community_cards", F.array_join("community_cards", ","))


def _deduped(spark, sf_dir):
    """The chain lands in portions, the newest first, and then all of it again; each event is kept once."""
    events = view(spark, sf_dir, "fx_events")
    landed = [*reversed(list(staging.portions(events, "height"))), events]
    return ingest.landed_events(spark, _taken_up(landed, spark, "deduped", ingest.start_dedupe))


ENTRIES = [
    Entry("stream_ingest", lambda spark, sf: ingest.landed_events(spark, _ingested(spark, sf)),
          with_views("select * from fx_events", "fx_events")),
    Entry("stream_progress", lambda spark, sf: ingest.landed_progress(spark, _ingested(spark, sf)),
          with_views(PROGRESS + "select last as last_scanned_block, last as total_blocks_scanned from scanned",
                     "fx_chain_events")),
    Entry("stream_figures", _figures, with_views("""
, kinds as (select count(*) as events, """ + ", ".join(
        f"count(*) filter (type = '{kind}') as {kind}" for kind in ROUTED_TYPES) + """ from fx_events)
select kinds.*, (select count(distinct height) from fx_events) as blocks, (select max(height) from fx_events) as last_height,
       cast(0 as bigint) as unreadable from kinds""", "fx_events")),
    Entry("stream_refill", _refill, with_views("select * from fx_events", "fx_events")),
    Entry("stream_card_counts", _counted(counters.card_counters, "fx_revealed_cards", "card"), with_views("""
select card, count(*) as total, count(*) filter (card_type = 'community') as community,
       count(*) filter (card_type = 'hole') as hole
from fx_revealed_cards where regexp_full_match(card, '[2-9TJQKA][hdcs]') group by card""", "fx_revealed_cards")),
    Entry("stream_player_activity", _counted(counters.player_activity, "fx_player_actions", "player_address"),
          with_views("""
select player_address, count(*) as total_actions, min(block_height) as first_seen_block,
       max(block_height) as last_seen_block from fx_player_actions group by player_address""", "fx_player_actions")),
    Entry("stream_player_stats", _player_stats,
          with_views(STATS_SQL + "select * exclude (biggest_pot_won) from stats", *STATS_VIEWS.split())),
    Entry("stream_hands_fold", _hands, with_views(STARTED_SQL, "fx_events")),
    Entry("stream_sessions", _sessions, with_views(SESSION_SQL, "fx_events")),
    Entry("stream_closing_hands", _closing_hands, with_views(STARTED_SQL, "fx_events")),
    Entry("stream_legacy_hands", _legacy_hands, with_views(LEGACY_FOLD_SQL, LEGACY, "fx_headers", STATES)),
    Entry("stream_showdowns", lambda spark, sf: matches.current_showdowns(spark, _matched(spark, sf, SHOWDOWN)),
          with_views(SHOWN_SQL, SHOWDOWN, STATES)),
    Entry("stream_results_fold", _tables(_results, compacted=True), with_views(RESULTS_SQL, "fx_events")),
    Entry("stream_revealed_cards", _tables(tables.current_cards, compacted=True), with_views(CARDS_SQL + """
, numbered as (select *, row_number() over (partition by game_id, hand_number, card_type, position, card
                                            order by block_height) as nth from shown)
select * exclude (nth) from numbered where nth = 1""", "fx_events")),
    Entry("stream_actions", _tables(tables.current_actions), with_views(ACTIONS_SQL, "fx_events")),
    Entry("stream_dedupe", _deduped, with_views("select * from fx_events", "fx_events")),
]
