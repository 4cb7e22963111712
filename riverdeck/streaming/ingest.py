"""Landing folder -> event log, scanned heights, unreadable documents, and figures of every batch."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from riverdeck import schemas
from riverdeck.constants import ROUTED_TYPES
from riverdeck.operators.events import dedupe_events
from riverdeck.operators.folds import progress
from riverdeck.operators.lookup import scan_gap_ranges
from riverdeck.session import pinned, scratch_scope
from riverdeck.sources.blocks import block_height, decode, flatten, raw_events, scanned_heights
from riverdeck.streaming import logs

PROGRESS = schemas.TABLES["indexing_progress"]
#: Where a refill stream lands, below the main stream's folder.
REFILL = "refill"
_CORRUPT, _FILE = "_corrupt_record", "_file"


def read_documents(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Block-result documents of a landing folder, as a stream in the order files arrive, each with its file and,
    where it is no such document, with its text."""
    shape = StructType([*schemas.BLOCK_RESULTS.fields]).add(_CORRUPT, StringType())
    return (spark.readStream.schema(shape).option("columnNameOfCorruptRecord", _CORRUPT)
            .option("maxFilesPerTrigger", files_per_batch).json(landing)
            .withColumn(_FILE, F.col("_metadata.file_path")))


def read_blocks(spark: SparkSession, landing: str, encoding: str = "auto", files_per_batch: int = 1000) -> DataFrame:
    """Their decoded events, as a stream."""
    return flatten(decode(raw_events(read_documents(spark, landing, files_per_batch)), encoding))


def unreadable(documents: DataFrame) -> DataFrame:
    """Documents that name no block, with the reason: file, reason, document."""
    reason = F.when(F.col(_CORRUPT).isNotNull(), "not a block-result document").when(
        F.col("result").isNull(), "no result").when(F.col("result.height").isNull(), "no height").otherwise("height is no number")
    return documents.filter(block_height().isNull()).select(
        F.col(_FILE).alias("file"), reason.alias("reason"),
        F.coalesce(_CORRUPT, F.to_json("result"), F.lit("")).alias("document"))


def _without_replays(events: DataFrame, out: str, batch_id: int, copies: int, lo: int, hi: int,
                     high: int | None) -> DataFrame:
    """`events` (of blocks lo..hi) less blocks landed before. Blocks arrive once and in order, so
    these numbers usually show that there is nothing to drop: nothing is shuffled or looked up."""
    if copies > 1:
        events = dedupe_events(events)
    if high is not None and lo <= high:
        known = (logs.read_log(events.sparkSession, out, "heights", schemas.HEIGHTS)
                 .filter((F.col(logs.BATCH) < batch_id) & F.col("height").between(lo, hi))
                 .select("height").distinct())
        events = events.join(known, "height", "left_anti")
    return events.select(*schemas.EVENTS.names)


def _of_kind(kind: str) -> Column:
    return F.count(F.when(F.col("type") == kind, True)).alias(kind)


def start_ingest(spark: SparkSession, landing: str, out: str, checkpoint: str, trigger: dict | None = None,
                 start_block: int = 1, encoding: str = "auto", files_per_batch: int = 1000) -> StreamingQuery:
    """Land decoded events under `out`. Spark's checkpoint remembers what was read, so a restart
    goes on where the last run stopped and rescans nothing; a block that is landed again, in the
    same batch or a later one, is dropped. Documents are parsed once; those that name no block land in
    the quarantine. Figures of each batch are logged beside its events.

    Default trigger: take what has landed, then stop; {"processingTime": "60 seconds"} polls."""
    def each_batch(documents: DataFrame, batch_id: int) -> None:
        begun, session = time.monotonic(), documents.sparkSession
        with scratch_scope(session):
            documents = pinned(documents, "documents")
            logs.write_batch(scanned_heights(documents), out, "heights", batch_id)
            scanned = logs.read_batch(session, out, "heights", batch_id, schemas.HEIGHTS)
            lo, hi, copies, blocks = scanned.agg(F.min("height"), F.max("height"), F.max("copies"), F.count("*")).first()
            high = logs.high_before(session, out, batch_id) if batch_id > 0 else None
            events = flatten(decode(raw_events(documents), encoding))
            if lo is not None:
                events = _without_replays(events, out, batch_id, copies, lo, hi, high)
            landed, refused = Observation(), Observation()
            logs.write_batch(events.observe(landed, F.count("*").alias("events"), *map(_of_kind, ROUTED_TYPES)),
                             out, "events", batch_id, "type")
            logs.write_batch(unreadable(documents).observe(refused, F.count("*").alias("unreadable")),
                             out, "quarantine", batch_id)
        logs.write_batch(progress(scanned, start_block), out, "progress", batch_id)
        figures = {"blocks": blocks, "last_height": hi, "seconds": time.monotonic() - begun, **landed.get, **refused.get}
        row = session.createDataFrame([tuple(figures[name] for name in schemas.FIGURES.names)], schemas.FIGURES)
        logs.write_batch(row.coalesce(1), out, "figures", batch_id)
        logs.commit(session, out, batch_id, max((h for h in (high, hi) if h is not None), default=None))

    return logs.start(
        read_documents(spark, landing, files_per_batch).writeStream, each_batch, checkpoint, trigger)


def start_refill(spark: SparkSession, landing: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Land the documents of blocks that `refill_requests` asked for, beside a running `start_ingest` to the same
    `out`, with a landing folder and checkpoint of its own. Readers of `out` see both; a block that
    both landed counts as the main stream has it."""
    return start_ingest(spark, landing, f"{out}/{REFILL}", checkpoint, **options)


def _refilled(spark: SparkSession, out: str) -> bool:
    return logs.exists(spark, f"{out}/{REFILL}/commits")


def refill_requests(spark: SparkSession, out: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Runs of blocks that neither stream has landed: first_block, last_block, for whatever fetches them."""
    return scan_gap_ranges(landed_heights(spark, out), start, end)


def start_dedupe(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Land a stream of events, each once, under `out`; replays may come in any later batch, and events
    that come late are kept. No state: replays are looked up in what has landed."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch_scope(session):
            rows = pinned(dedupe_events(batch.select(*schemas.EVENTS.names)))
            high = logs.high_before(session, out, batch_id) if batch_id > 0 else None
            lo, hi = rows.agg(F.min("height"), F.max("height")).first()
            fresh = logs.unseen(rows, out, "events", batch_id, ["height", "event_seq"], "height", lo, high)
            logs.write_batch(fresh, out, "events", batch_id, "type")
            logs.write_spans(rows, out, "height", batch_id)
        logs.commit(session, out, batch_id, max((h for h in (high, hi) if h is not None), default=None))

    return logs.start(events.writeStream, each_batch, checkpoint, trigger)


def landed_events(spark: SparkSession, out: str) -> DataFrame:
    """The event log; `type` and the batch number prune folders, the rest prunes columns."""
    main = logs.read_log(spark, out, "events", schemas.EVENTS).drop(logs.BATCH)
    if not _refilled(spark, out):
        return main
    refill = logs.read_log(spark, f"{out}/{REFILL}", "events", schemas.EVENTS).drop(logs.BATCH)
    # The refill's blocks are few: the main stream's are reduced to those before anything is joined to events.
    of_both = logs.read_log(spark, out, "heights", schemas.HEIGHTS).select("height").join(
        logs.read_log(spark, f"{out}/{REFILL}", "heights", schemas.HEIGHTS).select("height"), "height", "left_semi")
    return main.unionByName(refill.join(of_both.distinct(), "height", "left_anti"))


def landed_heights(spark: SparkSession, out: str) -> DataFrame:
    """Every block scanned, as often as it was; for `resume_point` and `scan_gaps`."""
    roots = [out, f"{out}/{REFILL}"] if _refilled(spark, out) else [out]
    found = [logs.read_log(spark, root, "heights", schemas.HEIGHTS).select("height") for root in roots]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def landed_quarantine(spark: SparkSession, out: str) -> DataFrame:
    """Documents that could not be read: file, reason, document, and the batch that met them."""
    return logs.read_log(spark, out, "quarantine", schemas.QUARANTINE)


def landed_progress(spark: SparkSession, out: str) -> DataFrame:
    """One row: the furthest progress any batch reported."""
    return logs.read_log(spark, out, "progress", PROGRESS).agg(
        F.max("last_scanned_block").alias("last_scanned_block"),
        F.max("total_blocks_scanned").alias("total_blocks_scanned"))


def landed_figures(spark: SparkSession, out: str, chain_height: int | None = None) -> DataFrame:
    """One row per batch, whether the query still runs or not: blocks, events, events by kind, unreadable documents,
    seconds, blocks_per_second; with the chain's height also percent, and seconds_left at the batch's rate."""
    found = logs.read_log(spark, out, "figures", schemas.FIGURES).withColumn(
        "blocks_per_second", F.col("blocks") / F.greatest(F.col("seconds"), F.lit(0.001)))
    if not chain_height:
        return found
    reached = F.max("last_height").over(Window.orderBy(logs.BATCH))  # one row per batch
    return found.withColumns({"percent": 100.0 * reached / chain_height, "seconds_left": F.when(
        F.col("blocks") > 0, F.greatest(F.lit(0), F.lit(chain_height) - reached) / F.col("blocks_per_second"))})
