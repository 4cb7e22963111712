"""Chi-squared helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_chi_squared(counts: Column, categories: int, total: Column) -> Column:
    """Deviation of `counts` (an array, one entry per category) from an even split of `total`.

    Sums squared deviations rather than squared counts: the latter overflow 64 bits at
    billions of cards and cancel badly in doubles. `total` may exceed the sum of `counts`."""
    expected = total.cast("double") / F.lit(float(categories))
    summed = F.aggregate(counts, F.lit(0.0), lambda acc, n: acc + (n - expected) * (n - expected) / expected)
    return F.when(total > 0, summed).otherwise(F.lit(0.0))


_TERMS = 250


def chi_squared_tail(x: Column, df: int) -> Column:
    """P(chi-squared with `df` > x), the upper incomplete gamma function of df / 2 at x / 2.

    Below a + 1 (a = df / 2) it is one less the lower function's series, which is small there; above, the upper
    function's continued fraction, evaluated from its far end. Both are settled to the last digits after 250
    steps for up to some hundred degrees of freedom, so the tail keeps its relative accuracy however small."""
    half, a = x / 2.0, df / 2.0
    lead = F.exp(F.lit(a) * F.log(half) - half - F.lit(math.lgamma(a)))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        F.struct((lead / a).alias("term"), (lead / a).alias("sum")),
        lambda acc, n: F.struct(
            (acc["term"] * half / (n + a)).alias("term"),
            (acc["sum"] + acc["term"] * half / (n + a)).alias("sum")),
        lambda acc: acc["sum"])
    fraction = F.aggregate(
        F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1)), half + F.lit(2.0 * _TERMS + 1.0 - a),
        lambda acc, n: half + (2.0 * n - 1.0 - a) - n * (n - F.lit(a)) / acc)
    return (F.when(x <= 0, F.lit(1.0)).when(half < a + 1.0, F.greatest(F.lit(0.0), F.lit(1.0) - series))
            .otherwise(lead / fraction))
