"""The corpus pipeline: quality rules, near copies, personal data, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverdeck.catalog.entry import Entry
from riverdeck.llm.mixing import mix
from riverdeck.llm.packing import pack
from riverdeck.llm.pii import redact
from riverdeck.llm.quality import keep_good
from riverdeck.llm.simhash import drop_near_copies
from riverdeck.session import pinned


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or thinned out to their sources' targets."""
    return mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, with their ids, and their places in training sequences."""
    return pack(docs, with_ids=True)


STAGES = [("quality", quality_stage), ("near_copies", near_copy_stage), ("personal_data", personal_data_stage),
          ("mixing", mix_stage), ("packing", packing_stage)]
#: SQL can't express fingerprints, the label model or packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and reread as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ENTRY = Entry("pipeline", run, ORACLE_SQL)
