"""Exact quantiles of large groups and the box summary built on them.

A quantile needs one or two order statistics. A mergeable sketch per group (KLL) brackets each of them within a few
thousandths of the rows. One pass then counts the rows below each bracket and, value by value, those inside; the
rank is found among these counts. So an input is read twice for its quantiles, whatever its values, and neither a large group
nor a value that fills a third of it gathers in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.moments import nan_to_null
from tallyforge.operators.ranks import holding
from tallyforge.session import settle

BINS = 4096
#: Size of a sketch, and how far a bracket reaches beyond a rank, as a share of the rows: ten standard errors of that size.
SKETCH, REACH = 4096, 0.003


def unpivot_features(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row ``(by, feature, value)`` per present value."""
    cells = F.array(
        *[F.struct(F.lit(f).alias("feature"), nan_to_null(F.col(f).cast("double")).alias("value")) for f in features]
    )
    return df.select(*by, F.inline(cells)).filter(F.col("value").isNotNull())


def _bin(value: Column) -> Column:
    """Bin of a value between ``low`` and ``high``; infinite ends count as the largest double."""
    top = F.lit(sys.float_info.max)
    finite = lambda c: F.greatest(F.least(c, top), -top) / 2
    low, high = finite(F.col("low")), finite(F.col("high"))
    place = F.floor(F.try_divide(finite(value) - low, high - low) * BINS)
    return F.when(place.isNotNull(), F.least(place, F.lit(BINS - 1))).otherwise((value > F.col("low")).cast("bigint"))


def _brackets(sketches: DataFrame, keys: Sequence[str], fractions: Sequence[float], reach: float) -> DataFrame:
    """Per group and fraction the ranks around it and values that enclose them: columns ``rank_i``, ``part_i``, ``low_i``, ``high_i``."""
    columns = []
    for i, fraction in enumerate(fractions):
        at = (F.col("n") - 1) * F.lit(float(fraction))
        rank = F.floor(at) + 1
        value = lambda share: F.kll_sketch_get_quantile_double("sketch", F.lit(share))
        below, above = float(fraction) - reach, float(fraction) + reach
        # The whole range encloses every rank; it is also taken for groups that are no larger than a sketch.
        small = F.col("n") <= SKETCH
        least = F.col("low") if below <= 0 else F.when(small, F.col("low")).otherwise(value(below))
        most = F.col("high") if above >= 1 else F.when(small, F.col("high")).otherwise(value(above))
        columns += [
            rank.alias(f"rank_{i}"), (at - F.floor(at)).alias(f"part_{i}"),
            least.alias(f"low_{i}"), most.alias(f"high_{i}"),
        ]
    return sketches.select(*keys, "n", *columns)


def _from_brackets(long: DataFrame, keys: Sequence[str], brackets: DataFrame, count: int) -> DataFrame:
    """``(keys, n, found, q0, q1, ...)``; ``found`` is false where a rank lies outside its bracket. Fractions ascend."""
    value = F.col("value")
    lows, highs = [F.col(f"low_{i}") for i in range(count)], [F.col(f"high_{i}") for i in range(count)]
    # How many brackets begin at or before the value; what is inside one of them keeps its value.
    zone = sum((value >= low).cast("int") for low in lows)
    inside = F.lit(False)
    for low, high in zip(lows, highs):
        inside = inside | value.between(low, high)
    bounds = brackets.select(*keys, *(f"{side}_{i}" for i in range(count) for side in ("low", "high")))
    cells = settle(
        long.join(bounds, keys).groupBy(*keys, zone.alias("zone"), F.when(inside, value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )
    below = cells.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col("zone") <= i, F.col("n"))), F.lit(0)).alias(f"below_{i}") for i in range(count)])
    sides = [
        F.struct(
            F.lit(i).alias("q"), F.lit(side).alias("side"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"), F.col(f"part_{i}").alias("part"),
            (F.least(F.col(f"rank_{i}") + side, F.col("n")) - F.col(f"below_{i}")).alias("rank"),
        )
        for i in range(count) for side in (0, 1)
    ]
    wanted = brackets.join(below, keys).select(*keys, F.col("n").alias("size"), F.inline(F.array(*sides)))
    ranges = [F.struct(F.lit(i).alias("q"), lows[i].alias("low"), highs[i].alias("high")) for i in range(count)]
    near = cells.filter(F.col("value").isNotNull()).join(brackets, keys).select(*keys, cells["n"].alias("n"), "value", F.inline(F.array(*ranges)))
    near = near.filter(value.between(F.col("low"), F.col("high"))).select(*keys, "q", "value", "n", _bin(value).alias("bin"))
    place = [*keys, "q"]
    bins = holding(near.groupBy(*place, "bin").agg(F.sum("n").alias("n")), place, "bin", wanted.select(*place, "side", "rank")).drop("n")
    spots = holding(near, [*place, "bin"], "value", bins).select(*place, "side", "value")
    both = wanted.join(spots, [*place, "side"], "left").groupBy(*keys, F.col("size").alias("n"), "q", "part").agg(
        F.max(F.when(F.col("side") == 0, value)).alias("v0"), F.max(F.when(F.col("side") == 1, value)).alias("v1"), F.count("value").alias("sides"),
    )
    line = F.when(F.col("part") == 0, F.col("v0")).otherwise(nan_to_null(F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")))
    return both.groupBy(*keys, "n").agg(
        (F.min("sides") == 2).alias("found"), *[F.max(F.when(F.col("q") == i, line)).alias(f"q{i}") for i in range(count)]
    )


def exact_quantiles(long: DataFrame, keys: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles per group: ``(keys, n, q0, q1, ...)`` in the given order.

    ``long`` has the keys and a non-null double ``value``. A bracket that misses its rank, which chance all but rules out, is
    widened and counted again, so the result is exact in any case.
    """
    keys, ascending = list(keys), sorted(set(fractions))
    sketches = settle(
        long.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch"),
        )
    )
    reach = REACH
    while True:
        result = settle(_from_brackets(long, keys, _brackets(sketches, keys, ascending, reach), len(ascending)))
        if reach >= 1 or result.filter("not found").isEmpty():
            break
        reach *= 16
    return result.select(*keys, "n", *[F.col(f"q{ascending.index(f)}").alias(f"q{i}") for i, f in enumerate(fractions)])


def _with_fences(df: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    keys = ["feature", target]
    long = unpivot_features(df.dropna(subset=[target]), features, [target])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    boxes = (
        exact_quantiles(long, keys, [0.25, 0.5, 0.75])
        .select(*keys, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
        .select("*", (F.col("q1") - reach).alias("lower_fence"), (F.col("q3") + reach).alias("upper_fence"))
    )
    return long.join(boxes, keys), boxes


def box_summary(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Quartiles, fences at 1.5 interquartile ranges, whiskers and outlier count per feature and class."""
    rows, boxes = _with_fences(df, features, target)
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    whiskers = rows.groupBy("feature", target).agg(
        F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
    )
    return whiskers.join(boxes, ["feature", target])


def box_outliers(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The points beyond the fences."""
    rows, _ = _with_fences(df, features, target)
    beyond = ~F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return rows.filter(beyond).select("feature", target, "value")
