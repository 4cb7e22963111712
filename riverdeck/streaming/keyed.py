"""Keyed state over a chain: block height as event time, one second to a block.

Blocks arrive in order, each stream at its own pace. A row more than `late_blocks` below the highest
block its stream had shown before the batch is dropped; where several streams meet, the slowest decides. So what an operator has to remember of the past is a window of blocks, and what arrives
again later than that needs no memory at all.

An operator is a step: (key, state or None, rows of a batch, settled block) -> (state or None, block, rows
out). A state of None is removed from the state store; `block` is the one whose settling calls the step again
without rows, None for never.

A call of Python costs milliseconds, whatever it is given. Where keys are many and small, they share their calls and
their entry in the state store by buckets: a bucket's step runs key by key inside one call.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StructType

from riverdeck.streaming import logs

AT, BLOCK, BUCKET = "_at", "_block", "_bucket"
#: What keyed state needs of a session, whoever built it: a store on executor disk that logs changes. A block
#: settles when the next ones arrive, so no batch is run for the passing of the watermark alone.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
Step = Callable[[tuple, "tuple | None", list, int], "tuple[tuple | None, int | None, list]"]


def by_height(rows: DataFrame, late_blocks: int = 0, height: str = "height") -> DataFrame:
    """Rows of a stream with their block as event time."""
    return rows.withColumns({AT: F.timestamp_seconds(F.col(height)), BLOCK: F.col(height)}).withWatermark(
        AT, f"{late_blocks + 1} seconds")


def in_bucket(step: Step, arrived: dict[tuple, list], held: list, settled: int) -> tuple[list, int | None, list]:
    """`step` for the keys of a bucket that have rows or are due: (key, due, state) of those that keep any, the block
    whose settling calls the next of them, and the rows out. Keys that rest keep what they have."""
    before = {tuple(key): (due, state) for key, due, state in held}
    kept, found = [], []
    for key in [*before, *(key for key in arrived if key not in before)]:
        due, state = before.get(key, (None, None))
        if key in arrived or due is not None and due <= settled:
            state, due, rows = step(key, state, arrived.get(key, []), settled)
            found += rows
        if state is not None:
            kept.append((key, due, state))
    return kept, min((due for _, due, _ in kept if due is not None), default=None), found


def with_state(rows: DataFrame, keys: Sequence[str], step: Step, out: StructType, state: str,
               bucket: Column | None = None) -> DataFrame:
    """`step` over the rows (`by_height`) of each key. It gets and gives plain tuples; those of the rows hold the
    columns that are neither keys nor the event time, none of them null but strings, and lie above the settled block
    (Spark's own late filter is a batch behind). `bucket`, a number that all rows of a key share, says which keys are
    stepped together; keys are not null then."""
    columns = [c for c in rows.columns if c not in (*keys, AT, BLOCK)]
    names = out.names

    def run(key, frames: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        now = held.getCurrentWatermarkMs()
        settled = now // 1000 if now > 0 else -1
        arrived = [] if held.hasTimedOut else [
            row for frame in frames for row in frame[frame[BLOCK] > settled][columns].itertuples(index=False, name=None)]
        kept, block, found = step(key, held.get if held.exists else None, arrived, settled)
        if kept is not None:
            held.update(kept)
            if block is not None:
                held.setTimeoutTimestamp(max(block * 1000, now + 1))
        elif held.exists:
            held.remove()
        if found:
            yield pd.DataFrame(found, columns=names, dtype=object)

    def run_bucket(_, frames: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        now = held.getCurrentWatermarkMs()
        settled = now // 1000 if now > 0 else -1
        arrived: dict[tuple, list] = {}
        for frame in () if held.hasTimedOut else frames:
            frame = frame[frame[BLOCK] > settled]
            for key, row in zip(*(frame[part].itertuples(index=False, name=None) for part in (list(keys), columns))):
                arrived.setdefault(key, []).append(row)
        kept, block, found = in_bucket(step, arrived, held.get[0] if held.exists else [], settled)
        if kept:
            held.update((kept,))
            if block is not None:
                held.setTimeoutTimestamp(max(block * 1000, now + 1))
        elif held.exists:
            held.remove()
        if found:
            yield pd.DataFrame(found, columns=names, dtype=object)

    # Executors' Pythons need not have this package: the code of the step travels with the query.
    for module in (__name__, step.__module__):
        cloudpickle.register_pickle_by_value(sys.modules[module])
    if bucket is None:
        return rows.groupBy(*keys).applyInPandasWithState(run, out, state, "update", "EventTimeTimeout")
    entry = StructType().add("key", StructType([rows.schema[k] for k in keys])).add("due", LongType()).add(
        "state", StructType.fromDDL(state))
    return rows.withColumn(BUCKET, bucket).groupBy(BUCKET).applyInPandasWithState(
        run_bucket, out, StructType().add("held", ArrayType(entry)), "update", "EventTimeTimeout")


def start(changed: DataFrame, each_batch, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """`logs.start` for rows that `with_state` gives. A query copies the settings when it starts; the session
    gets its own back."""
    conf = changed.sparkSession.conf
    before = {name: conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        conf.set(name, value)
    try:
        return logs.start(changed.writeStream.outputMode("update"), each_batch, checkpoint, trigger)
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)
