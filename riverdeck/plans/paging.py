"""Pages, top-k, and one-row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverdeck.constants import PAGE_LIMIT, PAGE_MAX


def page(df: DataFrame, order: Sequence[Column], limit: int = PAGE_LIMIT, offset: int = 0,
         with_total: bool = True) -> DataFrame:
    """One page in `order` (which must be total), each row with the unpaged row count as `total`, which takes
    a second scan; leave it out where nobody reads it."""
    if not 1 <= limit <= PAGE_MAX:
        raise ValueError(f"limit must be 1..{PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    rows = df.orderBy(*order).offset(offset).limit(limit)
    return rows.withColumn("total", df.agg(F.count("*")).scalar()) if with_total else rows


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows; Spark keeps k rows per partition, never a full sort."""
    return df.orderBy(*order).limit(k)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                out: str = "rn") -> DataFrame:
    """The first k rows of every key. The limit is applied on both sides of the shuffle, so a
    hot key sends k rows per input partition, not all of them."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window).cast("bigint")).filter(F.col(out) <= k)


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames (global aggregates) side by side; the others become scalar subqueries."""
    for i, other in enumerate(others):
        first = first.withColumn(f"_{i}", other.select(F.struct("*")).scalar())
    kept = [c for c in first.columns if not (c.startswith("_") and c[1:].isdigit())]
    return first.select(*kept, *[F.col(f"_{i}")[c].alias(c) for i, o in enumerate(others) for c in o.columns])
