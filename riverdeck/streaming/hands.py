"""The hand fold on a stream.

Each batch logs its own partial fold. Partials merge in any order, so nothing has to be kept
between batches and a hand may be touched again at any time.

With `close_after`, hands are closed: `close_after` blocks after a hand's last hand_completed event its fold goes
to the closed hands, and both its state and its share of the open log end. State then holds open hands
only, and compaction leaves only those in the open log. An event of a closed hand that comes after all, but
not below the watermark, starts a partial of its own, which merges with the closed one when read, and is open
until the hand completes again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverdeck.constants import HAND_COMPLETED, HAND_STARTED
from riverdeck.operators.events import completed_hands, started_hands
from riverdeck.operators.folds import HAND_KEY, merge_hand_partials, merge_hands, partial_hands
from riverdeck.schemas import HAND_PARTIALS, OPEN_HANDS
from riverdeck.streaming import logs
from riverdeck.streaming.keyed import by_height, start, with_state

_NEAR = 6  # so many low bits of the hand number apart, hands of a game share an entry of the state store
_STATE = ("first_height bigint, first_seq int, block_height bigint, last_height bigint, last_seq int, deck_seed string, "
          "deck string, completed bigint")


def closing_step(close_after: int):
    """A step that folds the events of one hand and closes it so many blocks after its completion."""
    def step(key: tuple, state: tuple | None, rows: list, settled: int) -> tuple:
        first, block, last, seed, deck, completed = None, None, None, None, None, -1
        if state is not None:
            first_height, first_seq, block, last_height, last_seq, seed, deck, completed = state
            first, last = ((first_height, first_seq), (last_height, last_seq)) if first_height >= 0 else (None, None)
        started = False
        for height, seq, is_start, block_height, deck_seed, own_deck in rows:
            at = (height, seq)
            if not is_start:
                completed = max(completed, height)
                continue
            started = True
            if first is None or at < first:
                first, block = at, block_height
            if last is None or at > last:
                last, seed, deck = at, deck_seed, own_deck
        closes = completed >= 0 and completed + close_after <= settled
        out = []
        if first and (started or closes):
            ends = [dict(zip(("height", "event_seq"), at)) for at in (first, last)]
            out = [(*key, ends[0], block, ends[1], seed, deck, int(closes))]
        if closes:
            return None, None, out
        kept = (*(first or (-1, -1)), block if first else -1, *(last or (-1, -1)), seed, deck, completed)
        return kept, completed + close_after if completed >= 0 else None, out

    return step


def _hand_events(events: DataFrame) -> DataFrame:
    """Starts and completions of hands, in one shape."""
    events = events.filter(F.col("type").isin(HAND_STARTED, HAND_COMPLETED))
    columns = ["height", "event_seq", "is_start", "block_height", "deck_seed", "deck"]
    starts = started_hands(events).withColumn("is_start", F.lit(True))
    ends = completed_hands(events).withColumns({
        "is_start": F.lit(False), "deck_seed": F.lit(None).cast("string"), "deck": F.lit(None).cast("string")})
    return starts.select(*HAND_KEY, *columns).unionByName(ends.select(*HAND_KEY, *columns))


def start_hands(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                close_after: int | None = None, late_blocks: int = 0) -> StreamingQuery:
    """Log partial folds. `close_after` (default: never) closes hands, and needs events in block order but for
    `late_blocks`; what comes later than that is dropped."""
    if close_after is not None:
        return _start_closing(events, out, checkpoint, trigger, close_after, late_blocks)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        logs.write_batch(partial_hands(started_hands(batch)), out, "partials", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    return logs.start(events.writeStream, each_batch, checkpoint, trigger)


def _start_closing(events: DataFrame, out: str, checkpoint: str, trigger: dict | None, close_after: int,
                   late_blocks: int) -> StreamingQuery:
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        logs.write_batch(batch.filter("closed = 0").drop("closed"), out, "partials", batch_id)
        logs.write_batch(batch.filter("closed = 1").drop("closed"), out, "closed", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    near = F.xxhash64("game_id", F.shiftright("hand_number", _NEAR))  # hands of near numbers are open together
    changed = with_state(
        by_height(_hand_events(events), late_blocks), HAND_KEY, closing_step(close_after), OPEN_HANDS, _STATE, near)
    return start(changed, each_batch, checkpoint, trigger)


def compact_hands(spark: SparkSession, out: str) -> None:
    """Merge the partials logged so far into one base."""
    logs.compact(spark, out, "partials", HAND_PARTIALS, merge_hand_partials)


def compact_closing_hands(spark: SparkSession, out: str) -> None:
    """Merge the partials logged so far into one base, without those of hands that have closed since.

    A closed fold holds all that the partials of its hand said up to the batch it closed in; a partial
    logged after that belongs to a late event, and stays."""
    closed = logs.read_log(spark, out, "closed", HAND_PARTIALS).groupBy(*HAND_KEY).agg(
        F.max(logs.BATCH).alias("closed_in"))

    def still_open(rows: DataFrame) -> DataFrame:
        met = rows.join(closed, HAND_KEY, "left")
        return merge_hand_partials(met.filter(F.col("closed_in").isNull() | (F.col(logs.BATCH) > F.col("closed_in"))))

    logs.compact(spark, out, "partials", HAND_PARTIALS, still_open)


def open_hands(spark: SparkSession, out: str) -> DataFrame:
    """The partials of the open log, with the batch (or base) that holds them."""
    return logs.read_log(spark, out, "partials", HAND_PARTIALS)


def closed_hands(spark: SparkSession, out: str) -> DataFrame:
    """Hands that have closed, as they closed."""
    return merge_hands(logs.read_log(spark, out, "closed", HAND_PARTIALS))


def current_hands(spark: SparkSession, out: str, closing: bool = False) -> DataFrame:
    """All hands; `closing` where the stream closes them."""
    partials = logs.read_log(spark, out, "partials", HAND_PARTIALS)
    if closing:
        partials = partials.unionByName(logs.read_log(spark, out, "closed", HAND_PARTIALS))
    return merge_hands(partials)
