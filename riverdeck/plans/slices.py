"""Ordered work per key without giving a hot key to one task.

A plain window puts a whole key into one task, so a key holding a third of the rows takes a
third of the job's time there. `nearest` cuts every key into spans of its order, `global_rank`
into range slices over (key, order). The window runs inside a piece, and what must cross its
border is carried over by a table with a row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverdeck.session import pinned, slice_count

SLICE = "_slice"
SPAN = 10_000  # blocks, or other units of an order, that one window covers


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with their range-slice number over (keys, order), one slice to a partition.

    `order` must make rows of a key distinct, or equal rows pile up in one slice. The numbers
    hold within one job; pin the frame before using them a second time. Placing rows by number
    lets windows over (slice, keys) start right there, where hashing the numbers would put
    several slices into one task."""
    slices = slice_count(df.sparkSession)
    return (df.repartitionByRange(slices, *[F.col(k).asc() for k in keys], *order)
            .withColumn(SLICE, F.spark_partition_id())
            .repartitionById(slices, F.col(SLICE)))


def nearest(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
            following: bool = False, span: int | None = None) -> DataFrame:
    """`out` = nearest non-null `value` at or before each row of its key, in `order`; with
    `following`, at or after. Key columns must not be null; `order` starts with a number.

    Windows run over (key, span of that number), so a key is dealt out over the spans it has rows
    in. What a span hands on is one value; a second window carries it over the spans of the key, of
    which there is one row each. One plan at every size, and nothing runs before an action."""
    keys, number, width = list(keys), order[0], span or SPAN
    # A frame that runs to the end of the partition costs quadratic time, so look backwards
    # over the reversed order instead.
    way = (lambda c: F.col(c).desc()) if following else (lambda c: F.col(c).asc())
    within = Window.partitionBy(*keys, SLICE).orderBy(*[way(c) for c in order])
    seen = F.last(value, ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sliced = df.withColumn(SLICE, F.floor(F.col(number) / width))
    pick = F.min_by if following else F.max_by
    edges = sliced.groupBy(*keys, SLICE).agg(
        pick(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_edge"))
    earlier = Window.partitionBy(*keys).orderBy(way(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, SLICE, F.last("_edge", ignorenulls=True).over(earlier).alias("_carried"))
    return sliced.withColumn("_seen", seen).join(carried, [*keys, SLICE], "left").select(
        *df.columns, F.coalesce("_seen", "_carried").alias(out))


def _runs(df: DataFrame, number: str, width: int) -> DataFrame:
    sliced = df.select(F.col(number).cast("bigint").alias("_at"), F.floor(F.col(number) / width).alias(SLICE))
    run = F.col("_at") - F.dense_rank().over(Window.partitionBy(SLICE).orderBy("_at"))  # the same for all of a run
    return sliced.withColumn("_run", run).groupBy(SLICE, "_run").agg(F.min("_at").alias("lo"), F.max("_at").alias("hi"))


def islands(df: DataFrame, number: str, span: int | None = None) -> DataFrame:
    """Runs of consecutive values of a whole `number`: (lo, hi) per run, cut at the spans' borders.

    Each run costs a row, whatever its length. Work is dealt out by span; repeated values do not matter."""
    return _runs(df, number, span or SPAN).select("lo", "hi")


def gaps(df: DataFrame, number: str, span: int | None = None) -> DataFrame:
    """What lies between neighbouring runs of a whole `number`: (lo, hi) of each gap.

    Neighbours are found within spans, where rows lie by span already, and between spans, of which
    there is one row each. Rows move once, however many gaps there are and however long."""
    runs = _runs(df, number, span or SPAN)

    def between(rows: DataFrame, window: Window) -> DataFrame:
        return (rows.withColumn("_before", F.lag("hi").over(window)).filter(F.col("lo") > F.col("_before") + 1)
                .select((F.col("_before") + 1).alias("lo"), (F.col("lo") - 1).alias("hi")))

    spans = runs.groupBy(SLICE).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return between(runs, Window.partitionBy(SLICE).orderBy("lo")).unionByName(between(spans, Window.orderBy(SLICE)))


def global_rank(df: DataFrame, by: str, tie_break: Sequence[str], keys: Sequence[str] = (),
                out: str = "rank") -> DataFrame:
    """rank() over (partition by `keys` order by `by` desc), ties sharing a rank.

    `by` must not be null; `tie_break` only makes the slicing order unique."""
    keys = list(keys)
    inside = Window.partitionBy(SLICE, *keys).orderBy(F.col(by).desc())
    local = pinned(
        cut(df, keys, [F.col(by).desc(), *[F.col(c).asc() for c in tie_break]])
        .withColumn("_local", F.rank().over(inside).cast("bigint")), "slices")

    # Per slice and key: how many rows it holds, and where its last (lowest) value starts.
    summary = local.groupBy(SLICE, *keys).agg(
        F.count("*").alias("_rows"), F.min(by).alias("_lowest"), F.max("_local").alias("_starts"))
    # One row per slice and key it holds; without keys, one row per slice in all.
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(summary.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))), "offsets")
    # A value that ends one slice may go on in the next: its rank is where it first appeared.
    spanning = pinned(offsets.groupBy(*keys, F.col("_lowest").alias(by))
                      .agg(F.min(F.col("_before") + F.col("_starts")).alias("_spanned")), "spanning")
    # Both are written: Spark sees their sizes, and broadcasts them only under its own threshold.
    return (local.join(offsets.select(SLICE, *keys, "_before"), [SLICE, *keys], "left")
            .join(spanning, [*keys, by], "left")
            .select(*df.columns, F.coalesce(
                "_spanned", F.col("_local") + F.coalesce("_before", F.lit(0))).cast("bigint").alias(out)))
