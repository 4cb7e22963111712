"""Running counts kept by streaming aggregation.

State is one row per card (52) or per player. Every batch logs the rows it changed; the newest
version of a key is its current count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riverdeck.functions.cards import is_standard
from riverdeck.operators.distribution import card_counts
from riverdeck.streaming import logs


def card_counters(cards: DataFrame) -> DataFrame:
    """Counts of the 52 cards; others have no counter."""
    return card_counts(cards.filter(is_standard(F.col("card"))))


def player_activity(actions: DataFrame) -> DataFrame:
    """Actions and first and last block of every player."""
    return actions.groupBy("player_address").agg(
        F.count("*").alias("total_actions"), F.min("block_height").alias("first_seen_block"),
        F.max("block_height").alias("last_seen_block"))


def start_counters(counts: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run a streaming aggregate (one of the above over a stream) into a log of changed rows."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        logs.write_batch(batch, out, "counts", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    return logs.start(counts.writeStream.outputMode("update"), each_batch, checkpoint, trigger)


def current_counts(spark: SparkSession, out: str, schema: StructType, key: str) -> DataFrame:
    return logs.latest(logs.read_log(spark, out, "counts", schema), [key])


def compact_counts(spark: SparkSession, out: str, schema: StructType, key: str) -> None:
    """Keep the newest version of each key logged so far, in one base."""
    logs.compact(spark, out, "counts", schema, lambda rows: logs.latest(rows, [key]))
