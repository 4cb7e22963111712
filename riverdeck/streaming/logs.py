"""Batch-numbered parquet logs: the sink every stream here writes.

Batch N goes to its own folder and is overwritten when Spark repeats the batch, so output is
exactly-once. A commit row is written last; readers only see committed batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructType

from riverdeck.plans.slices import SPAN, islands
from riverdeck.session import remove

BATCH = "batch_id"
_KEPT = 10
_SPANS = StructType().add("lo", LongType()).add("hi", LongType())
_COMMITS = StructType().add("rows_from", LongType()).add("high", LongType())


def write_batch(df: DataFrame, root: str, name: str, batch_id: int, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/{name}/{BATCH}={batch_id}")


def read_batch(spark: SparkSession, root: str, name: str, batch_id: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{name}/{BATCH}={batch_id}")


def commit(spark: SparkSession, root: str, batch_id: int, high: int | None = None) -> None:
    """Make a batch visible. `high` notes the highest position landed so far, where there is one."""
    one = spark.range(1).select(
        F.lit(batch_id).cast("bigint").alias("rows_from"), F.lit(high).cast("bigint").alias("high"))
    one.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/{BATCH}={batch_id}")
    remove(spark, f"{root}/commits/{BATCH}={batch_id - _KEPT}")  # only the newest says anything


def last_commit(spark: SparkSession, root: str) -> int | None:
    """The newest committed batch: one number, read from the last few commit rows."""
    commits = spark.read.schema(_COMMITS).parquet(f"{root}/commits")
    return commits.agg(F.max("rows_from")).first()[0]


def high_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The highest position that batches before this one landed."""
    commits = spark.read.schema(_COMMITS).parquet(f"{root}/commits")
    return commits.filter(F.col("rows_from") < batch_id).agg(F.max("high")).first()[0]


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _compacted(spark: SparkSession, root: str, name: str) -> int:
    """The last batch that the log's base holds; -1 without a base."""
    marks = f"{root}/{name}-bases"
    if not exists(spark, marks):
        return -1
    return spark.read.schema(_COMMITS).parquet(marks).agg(F.max("rows_from")).first()[0]


def read_log(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """All committed rows with their batch number: the base, if there is one, and the batches after it."""
    newest, upto = last_commit(spark, root), _compacted(spark, root, name)
    numbered = StructType([*schema.fields]).add(BATCH, LongType())
    rows = spark.read.schema(numbered).parquet(f"{root}/{name}").filter(
        (F.col(BATCH) > upto) & (F.col(BATCH) <= (-1 if newest is None else newest)))
    if upto < 0:
        return rows
    base = spark.read.schema(numbered).parquet(f"{root}/{name}-base").filter(F.col(BATCH) == upto)
    return base.unionByName(rows)


def compact(spark: SparkSession, root: str, name: str, schema: StructType,
            merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge all committed batches but the newest into the log's base, so that reading costs no more for
    a long history. `merge` takes rows with their batch number to rows of `schema` that say as much.

    A base counts once its mark is written; batches and bases before it go after that. Run it between
    batches or beside them, but not beside a reader that started earlier."""
    newest, upto = last_commit(spark, root), _compacted(spark, root, name)
    if newest is None or newest - 1 <= upto:
        return
    rows = read_log(spark, root, name, schema).filter(F.col(BATCH) < newest)
    merge(rows).select(*schema.names).write.mode("overwrite").parquet(f"{root}/{name}-base/{BATCH}={newest - 1}")
    mark = spark.range(1).select(F.lit(newest - 1).cast("bigint").alias("rows_from"), F.lit(None).cast("bigint").alias("high"))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}-bases/{BATCH}={newest - 1}")
    for batch in range(upto + 1, newest):
        remove(spark, f"{root}/{name}/{BATCH}={batch}")
    remove(spark, f"{root}/{name}-base/{BATCH}={upto}")
    remove(spark, f"{root}/{name}-bases/{BATCH}={upto}")


def write_spans(rows: DataFrame, root: str, position: str, batch_id: int) -> None:
    """Note which positions a batch landed, as runs of consecutive ones: the index that `unseen` looks into."""
    write_batch(islands(rows, position, span=SPAN), root, "spans", batch_id)


def unseen(rows: DataFrame, root: str, name: str, batch_id: int, keys: Sequence[str], position: str, lo: int | None,
           high: int | None) -> DataFrame:
    """`rows` of a batch, from position `lo` on, less those whose `keys` stand in what batches before it left in
    the log `name`, of which `high` is the highest position. A batch that runs again does not meet its own rows.

    Positions arrive in order but for replays and late rows. Only rows at or below `high` can repeat; which
    batches hold their positions the index says exactly, and only those batches, and of them only the
    positions asked for, are read. A position that no batch landed is looked up nowhere."""
    if high is None or lo is None or lo > high:
        return rows
    spark = rows.sparkSession
    within = rows.filter(F.col(position) <= high)
    asked = within.select(F.col(position).alias("_at")).distinct().withColumn("_span", F.floor(F.col("_at") / SPAN))
    landed = read_log(spark, root, "spans", _SPANS).filter(
        (F.col(BATCH) < batch_id) & (F.col("hi") >= lo)).withColumn("_span", F.floor(F.col("lo") / SPAN))
    met = asked.join(landed, "_span").filter(F.col("_at").between(F.col("lo"), F.col("hi")))
    # A row per batch that holds any of them.
    found = met.groupBy(BATCH).agg(F.min("_at").alias("first"), F.max("_at").alias("last")).collect()
    if not found:
        return rows
    schema = StructType([rows.schema[key] for key in keys])
    reached = (min(r["first"] for r in found), max(r["last"] for r in found))
    known = read_log(spark, root, name, schema).filter(
        F.col(BATCH).isin([r[BATCH] for r in found]) & F.col(position).between(*reached)).select(*keys).distinct()
    return rows.filter(F.col(position) > high).unionByName(within.join(known, list(keys), "left_anti"))


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key in a log of changed rows."""
    rest = [c for c in rows.columns if c not in (*keys, BATCH)]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("_row")).select(*keys, "_row.*"))


def start(writer: DataStreamWriter, each_batch, checkpoint: str, trigger: dict | None):
    """Start a stream whose micro-batches go to `each_batch(frame, batch_id)`."""
    return (writer.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
