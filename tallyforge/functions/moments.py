"""Moments and row statistics built from native aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a sum of squares below this counts as zero, as in the skew of pandas.
SPREAD_FLOOR = 1e-14


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def adjusted_skewness(column: Column) -> Column:
    """Bias-adjusted skewness: NULL below 3 values or when undefined, 0 for a constant."""
    n = F.count(column).cast("double")
    bias = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    spread = F.var_pop(column) * n
    flat = F.coalesce(spread < SPREAD_FLOOR, F.lit(True))
    return F.when(n >= 3, F.when(flat, 0.0).otherwise(nan_to_null(F.skewness(column) * bias)))


def row_statistics(columns: Sequence[Column]) -> dict[str, Column]:
    """Mean, sample deviation, minimum, maximum and range across columns, NULLs skipped."""
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    mean = F.try_divide(total, present)
    squares = reduce(lambda a, b: a + b, [F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in columns])
    deviation = F.when(present > 1, F.sqrt(F.try_divide(squares, present - 1)))
    low, high = F.least(*columns), F.greatest(*columns)
    return {
        "mean": nan_to_null(mean),
        "std": nan_to_null(deviation),
        "min": low,
        "max": high,
        "range": nan_to_null(high - low),
    }
