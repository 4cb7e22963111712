"""Results, revealed cards and actions on a stream.

Each batch logs what it adds: partial results, the first row of each card it shows, its actions. Partials
and first rows merge in any order; events should come from the deduplicated event log, as actions have no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riverdeck.operators import events as ev
from riverdeck.operators import folds
from riverdeck.schemas import ACTION_LOG, CARD_LOG, RESULT_PARTIALS
from riverdeck.streaming import logs


def start_tables(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep all three current from one stream of events, read once per batch and table."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        completed = ev.completed_hands(batch)
        logs.write_batch(folds.partial_results(completed), out, "results", batch_id)
        logs.write_batch(folds.dedupe_cards(ev.explode_cards(completed)), out, "cards", batch_id)
        logs.write_batch(ev.actions(batch), out, "actions", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    return logs.start(events.writeStream, each_batch, checkpoint, trigger)


def current_results(spark: SparkSession, out: str) -> DataFrame:
    return folds.merged_results(logs.read_log(spark, out, "results", RESULT_PARTIALS))


def current_cards(spark: SparkSession, out: str) -> DataFrame:
    return folds.dedupe_cards(logs.read_log(spark, out, "cards", CARD_LOG).select(*CARD_LOG.names))


def current_actions(spark: SparkSession, out: str) -> DataFrame:
    return logs.read_log(spark, out, "actions", ACTION_LOG).select(*ACTION_LOG.names)


def compact_tables(spark: SparkSession, out: str) -> None:
    """One base per table; `current_*` reads it and the batches after it."""
    logs.compact(spark, out, "results", RESULT_PARTIALS, folds.merge_result_partials)
    logs.compact(spark, out, "cards", CARD_LOG, lambda rows: folds.dedupe_cards(rows.select(*CARD_LOG.names)))
    logs.compact(spark, out, "actions", ACTION_LOG, lambda rows: rows)
