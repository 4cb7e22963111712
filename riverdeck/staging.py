"""Landed JSON derived from the given tables, in the documents' own shapes.

Written once per session and data folder, under the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck.constants import ATTRIBUTES
from riverdeck.fixtures import view
from riverdeck.session import scratch_path, slice_count

_staged: dict[tuple[str, str, str], str] = {}


def _staged_once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _staged:
        path = scratch_path(spark, kind)
        write(path)
        _staged[key] = path
    return _staged[key]


def _wire_attributes(encoded: Column) -> Column:
    """Present attributes as key/value pairs, base64 where `encoded`; in some blocks an extra
    stale game_id comes first, which the real one must override."""
    def b64(text: Column) -> Column:
        return F.base64(F.encode(text, "UTF-8"))

    def pair(key: Column, value: Column) -> Column:
        return F.struct(F.when(encoded, b64(key)).otherwise(key).alias("key"),
                        F.when(encoded, b64(value)).otherwise(value).alias("value"),
                        F.lit(True).alias("index"))

    stale = F.when(F.col("height") % 17 == 0, F.array(pair(F.lit("game_id"), F.lit("stale")))).otherwise(
        F.array().cast("array<struct<key:string,value:string,index:boolean>>"))
    present = F.filter(
        F.array(*[pair(F.lit(name), F.col(name)) for name in ATTRIBUTES]), lambda p: p["value"].isNotNull())
    return F.concat(stale, present)


def block_documents(events: DataFrame) -> DataFrame:
    """Decoded events -> block-result documents, one per height. Odd blocks are base64."""
    event = F.struct("type", _wire_attributes(F.col("height") % 2 == 1).alias("attributes"))
    listed = (events.groupBy("height")  # a block of the source data has ten events
              .agg(F.sort_array(F.collect_list(F.struct("event_seq", event.alias("event")))).alias("all")))

    def part(low: int, high: int) -> Column:
        chosen = F.filter("all", lambda e: e["event_seq"].between(low, high))
        return F.transform(chosen, lambda e: e["event"])

    no_begin = F.col("height") % 13 == 0  # such blocks carry no begin list at all
    txs = F.array(F.struct(part(0, 3).alias("events")),
                  F.struct(F.when(no_begin, part(4, 7)).otherwise(part(4, 6)).alias("events")))
    return listed.select(F.struct(
        F.col("height").cast("string").alias("height"), txs.alias("txs_results"),
        F.when(~no_begin, part(7, 7)).alias("begin_block_events"), part(8, 9).alias("end_block_events"),
    ).alias("result"))


def portions(df: DataFrame, position: str, count: int = 3) -> Iterator[DataFrame]:
    """`df` in `count` consecutive ranges of `position`, as it would land over time."""
    lo, hi = df.agg(F.min(position), F.max(position)).first()
    width = (hi - lo) // count + 1
    for low in range(lo, hi + 1, width):
        yield df.filter(F.col(position).between(low, low + width - 1))


def sliced_documents(events: DataFrame, slices: int) -> DataFrame:
    """`block_documents` in slices of the chain. The flat events are dealt out by range, once; blocks are put together
    where their events lie, so the wider documents never move."""
    return block_documents(events.repartitionByRange(slices, "height"))


def landed_blocks(spark: SparkSession, sf_dir: str) -> str:
    """Block-result documents, one file per slice of the chain."""
    def write(path: str) -> None:
        documents = sliced_documents(view(spark, sf_dir, "fx_events"), slice_count(spark))
        documents.write.option("compression", "gzip").json(path)

    return _staged_once(spark, sf_dir, "blocks", write)


def landed_headers(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        header = F.struct(F.col("height").cast("string").alias("height"), "app_hash")
        (view(spark, sf_dir, "fx_headers")
         .select(F.struct(F.struct(header.alias("header")).alias("block")).alias("result"))
         .write.json(path))

    return _staged_once(spark, sf_dir, "headers", write)


def state_documents(states: DataFrame) -> DataFrame:
    """Snapshots with two seated players (one of them showing cards) and 0 to 2 winners."""
    first = F.concat(F.lit("p"), (F.col("as_of_block") % 15).cast("string"))
    second = F.concat(F.lit("p"), ((F.col("as_of_block") + 1) % 15).cast("string"))
    cards = F.when(F.col("as_of_block") % 2 == 0, F.array(F.lit("Ah"), F.lit("Kd"))).otherwise(
        F.array(F.lit("9s"), F.lit("")))

    def seat(address: Column, number: int, held: Column) -> Column:
        return F.struct(address.alias("address"), F.lit(number).alias("seat"), F.lit("0").alias("stack"),
                        held.alias("holeCards"), F.lit("active").alias("status"))

    def winner(address: Column) -> Column:
        return F.struct(address.alias("address"), F.col("amount").cast("string").alias("amount"),
                        cards.alias("cards"))

    no_cards = F.array().cast("array<string>")
    return states.select("game_id", "as_of_block", F.struct(
        F.lit("holdem").alias("type"), F.col("game_id").alias("address"), F.lit(0).alias("dealer"),
        F.array(seat(first, 0, cards), seat(second, 1, no_cards)).alias("players"),
        F.array(F.lit("2c"), F.lit(""), F.lit("Ts")).alias("communityCards"),
        F.concat(F.lit("d"), F.col("hand_number").cast("string")).alias("deck"),
        "round", F.col("hand_number").alias("handNumber"),
        F.slice(F.array(winner(first), winner(second)), F.lit(1), F.col("winner_count")).alias("winners"),
    ).alias("game_state"))


def landed_states(spark: SparkSession, sf_dir: str) -> str:
    """Snapshots, plus one answer without a game state per game (which the reader drops)."""
    def write(path: str) -> None:
        states = state_documents(view(spark, sf_dir, "fx_game_states"))
        empty = states.select("game_id", F.lit(0).cast("bigint").alias("as_of_block")).distinct().withColumn(
            "game_state", F.lit(None).cast(states.schema["game_state"].dataType))
        states.unionByName(empty).write.json(path)

    return _staged_once(spark, sf_dir, "states", write)
