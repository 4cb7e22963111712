"""From decoded events to the tables every report reads: a whole indexing run as one job per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.operators.states import legacy_hands, showdown_results
from riverdeck.schemas import TABLES
from riverdeck.session import pinned
from riverdeck.sources.tables import write_ranges, write_table

# Tables laid out by block, so that block-range filters skip files.
BY_BLOCK = {"poker_hands": "block_height", "hand_results": "block_height", "revealed_cards": "block_height",
            "player_actions": "block_height", "player_sessions": "join_block"}


def _shaped(frame: DataFrame, table: str, **constants) -> DataFrame:
    """`frame` with the table's columns and types; `constants` fill the ones it lacks."""
    stamp = F.current_timestamp().cast("timestamp_ntz")
    return frame.select(*[
        (F.col(field.name) if field.name in frame.columns
         else stamp if field.name == "indexed_at"
         else F.lit(constants.get(field.name))).cast(field.dataType).alias(field.name)
        for field in TABLES[table]])


def index_tables(events: DataFrame, heights: DataFrame, headers: DataFrame | None = None,
                 states: DataFrame | None = None, start: int = 1, dedupe: bool = True,
                 land: bool = False) -> dict[str, DataFrame]:
    """The fact tables of a chain, as plans: nothing runs here. With `headers` and `states`, hands and
    showdowns known only from player actions and game snapshots join those announced by their own events.

    `land` writes what results and cards have in common to the scratch folder, so that writing both
    tables matches showdowns once."""
    started = ev.started_hands(events).withColumn("weak", F.lit(False))
    completed = ev.completed_hands(events)
    if states is not None and headers is not None:
        started = started.unionByName(legacy_hands(events, headers, states).drop("tx_hash"))
    if states is not None:
        completed = completed.unionByName(showdown_results(events, states))
    if land:
        completed = pinned(completed, "completed")
    return {
        "poker_hands": _shaped(folds.fold_hands(started), "poker_hands", tx_hash=""),
        "hand_results": _shaped(folds.fold_results(completed), "hand_results", tx_hash=""),
        "revealed_cards": _shaped(folds.dedupe_cards(ev.explode_cards(completed), dedupe), "revealed_cards"),
        "player_actions": _shaped(ev.actions(events), "player_actions"),
        "player_sessions": _shaped(
            folds.fold_sessions(ev.session_events(events)), "player_sessions", hands_played=0),
        "indexing_progress": _shaped(folds.progress(heights, start), "indexing_progress"),
    }


def write_index(tables: dict[str, DataFrame], root: str) -> None:
    for name, table in tables.items():
        write_table(table, root, name, BY_BLOCK.get(name))
        if name == "poker_hands":
            write_ranges(table.sparkSession, root, name, BY_BLOCK[name])
