"""Column helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once per row, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have: `name` behind as many underscores as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hashed_share(hash64: Column, share: float) -> Column:
    """Whether a signed 64-bit hash lies in the lowest `share` of its range; no share is too small for it."""
    return hash64 <= F.lit(min(2 ** 63 - 1, -2 ** 63 + int(share * 2 ** 64)))
