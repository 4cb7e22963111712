"""Landed chain documents: block results, headers, game states, chain status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck import schemas
from riverdeck.constants import ATTRIBUTES
from riverdeck.functions.attrs import decode_attrs


def block_height() -> Column:
    """The block a block-result document names; null if it names none."""
    return F.col("result.height").try_cast("bigint")


def raw_events(documents: DataFrame) -> DataFrame:
    """Block-result documents -> one row per event, numbered in the order
    transactions, begin-block, end-block. Documents that name no block drop out (`streaming.ingest` keeps them)."""
    result = F.col("result")
    none = F.array().cast(schemas.ArrayType(schemas.EVENT))
    in_txs = F.flatten(F.transform(
        F.coalesce(result["txs_results"], F.array().cast(documents.schema["result"].dataType["txs_results"].dataType)),
        lambda tx: F.coalesce(tx["events"], none)))
    listed = F.concat(
        in_txs, F.coalesce(result["begin_block_events"], none), F.coalesce(result["end_block_events"], none))
    return (documents
            .select(block_height().alias("height"), listed.alias("events"))
            .filter(F.col("height").isNotNull())
            .select("height", F.posexplode("events").alias("event_seq", "event"))
            .select("height", "event_seq", F.col("event.type").alias("type"),
                    F.col("event.attributes").alias("attributes")))


def scanned_heights(documents: DataFrame) -> DataFrame:
    """Heights of the readable block-result documents, blocks without events included, and how
    many documents each has."""
    return (documents.select(block_height().alias("height"))
            .filter(F.col("height").isNotNull()).groupBy("height").agg(F.count("*").alias("copies")))


def decode(events: DataFrame, encoding: str = "auto") -> DataFrame:
    """Raw events -> (height, event_seq, type, attrs)."""
    return events.select("height", "event_seq", "type", decode_attrs(F.col("attributes"), encoding).alias("attrs"))


def flatten(decoded: DataFrame) -> DataFrame:
    """Decoded events -> one string column per known attribute: the shape the folds read and
    the landed event table stores, so later jobs scan only the attributes they use."""
    return decoded.select(
        "height", "event_seq", "type", *[F.col("attrs")[name].alias(name) for name in ATTRIBUTES])


def block_events(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    return decode(raw_events(spark.read.schema(schemas.BLOCK_RESULTS).json(path)), encoding)


def headers(spark: SparkSession, path: str) -> DataFrame:
    header = F.col("result.block.header")
    return (spark.read.schema(schemas.BLOCK).json(path)
            .select(header["height"].try_cast("bigint").alias("height"), header["app_hash"].alias("app_hash"))
            .filter(F.col("height").isNotNull()))


def game_states(spark: SparkSession, path: str) -> DataFrame:
    """Landed snapshots; answers without a game state are dropped."""
    state = F.col("game_state")
    return (spark.read.schema(schemas.LANDED_STATE).json(path)
            .filter(state.isNotNull())
            .select("game_id", "as_of_block", state["handNumber"].alias("hand_number"),
                    state["round"].alias("round"), state["deck"].alias("deck"),
                    state["communityCards"].alias("community"), state["players"].alias("players"),
                    state["winners"].alias("winners")))


def chain_height(spark: SparkSession, path: str) -> DataFrame:
    """One row: the highest block any landed status document names."""
    latest = F.col("result.sync_info.latest_block_height").try_cast("bigint")
    return spark.read.schema(schemas.CHAIN_STATUS).json(path).agg(F.max(latest).alias("latest_block"))


def block_range(events: DataFrame, start: int = 1, end: int = 0) -> DataFrame:
    """Events of blocks start..end; end 0 means the latest block there is."""
    chosen = events.filter(F.col("height") >= start)
    return chosen.filter(F.col("height") <= end) if end else chosen


def resume_point(hands: DataFrame, events: DataFrame, start: int = 1) -> DataFrame:
    """One row: where indexing goes on, and whether it has caught up."""
    latest = events.agg(F.coalesce(F.max("height"), F.lit(0)).cast("bigint")).scalar()
    last = hands.agg(F.coalesce(F.max("block_height"), F.lit(0)).cast("bigint").alias("last_indexed"))
    following = F.when(F.col("last_indexed") == 0, F.lit(start)).otherwise(F.col("last_indexed") + 1)
    return last.withColumn("latest_block", latest).select(
        "last_indexed", following.cast("bigint").alias("next_block"), "latest_block",
        (following > F.col("latest_block")).alias("caught_up"))
