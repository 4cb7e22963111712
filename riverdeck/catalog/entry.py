"""One registered query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riverdeck.fixtures import view, with_views


@dataclass(frozen=True)
class Entry:
    """`run(spark, sf_dir)` gives the result; `sql` is the same result as plain SQL, or None."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def over(name: str, build: Callable[..., DataFrame], views: str, sql: str | None) -> Entry:
    """A query that calls `build` with fixture views (space-separated names, in order).
    `sql` reads the same views by name."""
    names = views.split()

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(*[view(spark, sf_dir, n) for n in names])

    return Entry(name, run, None if sql is None else with_views(sql, *names))
