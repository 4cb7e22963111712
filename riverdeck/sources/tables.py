"""Parquet tables: typed readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riverdeck import schemas


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str, order: str | None = None, mode: str = "overwrite") -> None:
    """Write a table; with `order` (a block height, say) files cover separate ranges of it, so
    range filters skip whole files by their statistics."""
    laid_out = df.repartitionByRange(F.col(order)).sortWithinPartitions(order) if order else df
    laid_out.write.mode(mode).parquet(f"{root}/{name}")


def write_ranges(spark: SparkSession, root: str, name: str, order: str) -> None:
    """Note beside a table which range of `order` each of its files covers: file, lo, hi, rows. One column is read,
    once; `newest_part` then finds the files that a page can come from."""
    where = F.col("_metadata.file_path").alias("file")
    (read_table(spark, root, name).select(where, F.col(order).alias("at")).groupBy("file")
     .agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("rows"))
     .coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}-ranges"))


def newest_part(spark: SparkSession, root: str, name: str, rows: int, upto: int | None = None) -> DataFrame:
    """The files of a table that can hold its `rows` highest rows in the order of `write_ranges`, or of those not
    above `upto`; all files where the table has no more rows.

    Files wholly at or above a threshold hold enough rows already, so lower ones can't matter. Written files
    cover separate ranges, so those that reach the threshold are few."""
    ranges = spark.read.parquet(f"{root}/{name}-ranges")
    inside = ranges if upto is None else ranges.filter(F.col("hi") <= upto)
    # A row per file, of which those come to the driver that the page needs: `rows` at most, as no file is empty.
    threshold, held = None, 0
    for lo, n in inside.orderBy(F.desc("lo")).select("lo", "rows").limit(rows).collect():
        threshold, held = lo, held + n
        if held >= rows:
            break
    if held >= rows:
        ranges = ranges.filter(F.col("hi") >= threshold)
    if upto is not None:
        ranges = ranges.filter(F.col("lo") <= upto)
    files = [r.file for r in ranges.select("file").collect()]
    if not files:
        return read_table(spark, root, name).limit(0)
    return spark.read.schema(schemas.TABLES[name]).parquet(*files)


def append_actions(actions: DataFrame, root: str) -> None:
    """Append action rows; no key, no dedupe."""
    actions.write.mode("append").parquet(f"{root}/player_actions")


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """Write a frame as CSV part files with header, and return it read back. Texts come back as they
    were: quotes are doubled, line breaks stay inside quotes, blanks stay, an empty text is "" and a
    null is nothing."""
    how = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""', "multiLine": True,
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}
    df.write.mode("overwrite").options(**how).csv(path)
    # The reader tells "" from nothing, but would then take "" for its null text: have it say something else.
    empty = uuid.uuid4().hex
    found = df.sparkSession.read.schema(df.schema).options(**{**how, "emptyValue": empty}).csv(path)
    return found.select(*[
        F.when(F.col(f.name) == empty, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema])
