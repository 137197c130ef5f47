"""Profiles of a table: class balance, skew, correlation, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.labels import decode_label
from tallyforge.functions.moments import adjusted_skewness, nan_to_null
from tallyforge.operators.quantiles import unpivot_features
from tallyforge.session import settle
from tallyforge.spec import IMBALANCE_LIMIT, SKEW_LIMIT

# Texts of the two recommendations.
BALANCE, NO_BALANCE = "use_class_weight_balanced", "class_weight_not_required"


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, NULL left out, in class order."""
    return df.dropna(subset=[target]).groupBy(target).agg(F.count(F.lit(1)).alias("rows")).orderBy(target)


def class_shares(df: DataFrame, target: str) -> DataFrame:
    """Share of each class among the rows that have one."""
    counts = settle(df.dropna(subset=[target]).groupBy(target).agg(F.count(F.lit(1)).alias("rows")))
    share = F.try_divide(F.col("rows"), counts.agg(F.sum("rows")).scalar())
    return counts.select(target, share.alias("share")).orderBy(target)


def imbalance(distribution: DataFrame, target: str, minority: object = None, limit: float = IMBALANCE_LIMIT) -> DataFrame:
    """One row: share of the minority class, largest to smallest class, recommendation."""
    least = F.count_if(F.lit(False)) if minority is None else F.sum(F.when(F.col(target) == F.lit(minority), F.col("rows")))
    ratio = F.coalesce(F.try_divide(F.max("rows"), F.min("rows")), F.lit(0.0))
    return distribution.agg(
        F.coalesce(F.try_divide(least, F.sum("rows")), F.lit(0.0)).alias("minority_share"),
        ratio.alias("majority_to_minority_ratio"),
        F.when(ratio > limit, BALANCE).otherwise(NO_BALANCE).alias("recommendation"),
    )


def skew_report(df: DataFrame, columns: Sequence[str], limit: float = SKEW_LIMIT) -> DataFrame:
    """Adjusted skewness per column, one pass; undefined ones are left out."""
    wide = df.agg(
        F.array(*[F.struct(F.lit(c).alias("feature"), adjusted_skewness(F.col(c)).alias("skewness")) for c in columns]).alias("s")
    )
    rows = wide.select(F.inline("s")).filter(F.col("skewness").isNotNull())
    return rows.withColumn("high", F.abs("skewness") > limit)


def _co_moments(columns: Sequence[str], shifts: Sequence[float]):
    """Per task one array: for each ordered pair of columns, over rows with both, how many there are, how many infinite, and the sums of x, x*x and x*y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, len(columns), len(columns)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) - np.array(shifts)
            present, infinite = (~np.isnan(x)).astype(np.float64), np.isinf(x).astype(np.float64)
            x = np.where(np.isfinite(x), x, 0.0)
            total += [present.T @ present, infinite.T @ present, x.T @ present, (x * x).T @ present, x.T @ x]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    return run


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns over the rows that have both; NULL when undefined.

    The co-moments of all pairs are one array per task, from matrix products over Arrow batches, and arrays are added up
    in two steps by a vector aggregate, so the plan does not grow with the number of pairs. Values are shifted by the mean of
    their column first.
    """
    if len(columns) < 2:
        raise ValueError("Correlation needs at least two columns")
    count = len(columns)
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    middle = lambda c: F.coalesce(F.when(F.min(finite(c)) == F.max(finite(c)), F.min(finite(c))).otherwise(F.avg(finite(c))), F.lit(0.0))
    shifts = list(values.agg(*[middle(c).alias(c) for c in values.columns]).first())
    none = df.sparkSession.range(1).select(F.array_repeat(F.lit(0.0), 5 * count * count).alias("sums"))  # for a table without rows
    parts = values.mapInArrow(_co_moments(columns, shifts), "sums array<double>").unionByName(none).select(array_to_vector("sums").alias("sums"))
    some = parts.groupBy((F.spark_partition_id() % 256).alias("part")).agg(Summarizer.sum(F.col("sums")).alias("sums"))
    whole = some.agg(Summarizer.sum(F.col("sums")).alias("sums")).select(vector_to_array("sums").alias("s"))
    names = F.array(*[F.lit(c) for c in columns])
    square = count * count
    cell = lambda kind, i, j: F.get(F.col("s"), F.lit(kind * square) + i * count + j)
    i, j = F.floor(F.col("pair") / count).cast("int"), (F.col("pair") % count).cast("int")
    pairs = whole.select("s", F.explode(F.sequence(F.lit(0), F.lit(square - 1))).alias("pair")).select(
        F.get(names, i).alias("feature_x"), F.get(names, j).alias("feature_y"), (i == j).alias("same"), cell(0, i, j).alias("n"), (cell(1, i, j) + cell(1, j, i)).alias("infinite"),
        cell(2, i, j).alias("x"), cell(2, j, i).alias("y"), cell(3, i, j).alias("xx"), cell(3, j, i).alias("yy"), cell(4, i, j).alias("xy"),
    )
    n = F.col("n")

    def spread(square: str, single: str) -> Column:
        """Sum of squared deviations; what rounding leaves of a constant counts as none."""
        out = F.col(square) - F.try_divide(F.col(single) * F.col(single), n)
        return F.when(out > 1e-13 * F.col(square), out)

    shared = F.try_divide(F.col("xy") - F.try_divide(F.col("x") * F.col("y"), n), F.sqrt(spread("xx", "x")) * F.sqrt(spread("yy", "y")))
    value = F.when((F.col("infinite") == 0) & F.col("same") & shared.isNotNull(), 1.0).when(F.col("infinite") == 0, nan_to_null(shared))
    return pairs.select("feature_x", "feature_y", value.alias("correlation"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """Counts in equal-width bins from least to greatest value; the greatest is in the last bin."""
    finite = df.select(*[F.when(F.abs(c) < float("inf"), F.col(c)).alias(c) for c in columns])
    ends = finite.agg(
        F.array(
            *[F.struct(F.lit(c).alias("feature"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")) for c in columns]
        ).alias("ends")
    ).select(F.inline("ends"))
    width = F.col("high") - F.col("low")
    # ``ends`` holds one row per listed column.
    place = F.floor(F.try_divide(F.col("value") - F.col("low"), width) * bins)
    return (
        unpivot_features(finite, columns)
        .join(F.broadcast(ends), "feature")
        .withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)) + 1)
        .groupBy("feature", "bin", "low", "high")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "feature", "bin", (F.col("low") + width * (F.col("bin") - 1) / bins).alias("bin_start"),
            (F.col("low") + width * F.col("bin") / bins).alias("bin_end"), "rows",
        )
    )


#: Cells per bandwidth, powers kept per cell, and bandwidths within which a value counts.
CELLS, POWERS, WITHIN = 4, 13, 9


def density_curves(df: DataFrame, features: Sequence[str], target: str, points: int = 90) -> DataFrame:
    """Gaussian kernel density per feature and class at evenly spaced points.

    Groups with fewer than two values or without spread have no curve. Values are folded into cells of a quarter of a
    bandwidth, each kept as the sums of the first 13 powers of the distances from its middle: one aggregate over the rows, which
    makes no rows of its own. The kernel sum of a cell at a point is its expansion in Hermite polynomials, whose
    first left-out term is below 1e-15 of a value's share; a cell adds only to points within nine bandwidths.
    """
    keys = ["feature", target]
    long = unpivot_features(df.dropna(subset=[target]), features, [target])
    sizes = settle(
        long.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
        .filter((F.col("n") >= 2) & ~F.isnan("std") & (F.col("std") > 1e-12))
        .withColumn("bandwidth", 1.06 * F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .filter(F.col("bandwidth") > 1e-12)
    )
    last = max(points - 1, 1)
    low, high, width = F.col("low"), F.col("high"), F.col("bandwidth")
    x = low + (high - low) * F.col("point") / last
    place = F.floor((F.col("value") - low) / width * CELLS)
    middle = low + (F.col("cell") + 0.5) * width / CELLS
    own = [*keys, "low", "high", "bandwidth"]
    placed = long.join(sizes, keys).select(*own, "value", place.alias("cell")).select(*own, "cell", ((F.col("value") - middle) / width).alias("t"))
    powers = [F.lit(1.0)]
    for _ in range(POWERS - 1):
        powers.append(powers[-1] * F.col("t"))
    cells = placed.groupBy(*own, "cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])
    # exp(yt - t*t/2) = sum of He_k(y) t^k / k!, sorted by powers of y.
    factor = lambda j, m: (-1) ** m / (math.factorial(j) * math.factorial(m) * 2**m)
    sorted_ = [sum(F.col(f"m{j + 2 * m}") * factor(j, m) for m in range((POWERS - 1 - j) // 2 + 1)).alias(f"c{j}") for j in range(POWERS)]
    step = (high - low) / last
    first = F.greatest(F.lit(0), F.ceil((middle - WITHIN * width - low) / step)).cast("int")
    final = F.least(F.lit(points - 1), F.floor((middle + WITHIN * width - low) / step)).cast("int")
    reached = cells.select(*own, middle.alias("middle"), *sorted_, first.alias("first"), final.alias("final")).filter("first <= final")
    y = (x - F.col("middle")) / width
    series = reduce(lambda total, j: total * F.col("y") + F.col(f"c{j}"), range(POWERS - 2, -1, -1), F.col(f"c{POWERS - 1}"))
    masses = (
        reached.withColumn("point", F.explode(F.sequence("first", "final"))).withColumn("y", y)
        .groupBy(*keys, "point").agg(F.sum(F.exp(-0.5 * F.col("y") * F.col("y")) * series).alias("mass"))
    )
    scale = F.col("n") * width * math.sqrt(2 * math.pi)
    grid = sizes.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(masses, [*keys, "point"], "left").select(
        *keys, "point", x.alias("x"), (F.coalesce("mass", F.lit(0.0)) / scale).alias("density")
    )


def pair_points(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The points of every pair of distinct features, once per pair, with their class. Meant for a sample of the rows."""
    cells = [
        F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), F.col(a).alias("x"), F.col(b).alias("y"))
        for a, b in combinations(features, 2)
    ]
    return df.dropna(subset=list(features)).select(target, F.inline(F.array(*cells)))


def named_class_counts(df: DataFrame, target: str, names: Mapping[int, str]) -> DataFrame:
    """Rows per class with the class name instead of its id."""
    counts = class_distribution(df, target)
    return counts.select(target, decode_label(F.col(target), names).alias("label"), "rows")


def stage_table(clean: DataFrame, engineered: DataFrame, target: str, split: str = "is_test") -> DataFrame:
    """Feature count and split sizes before and after the derived columns."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        n_features = len([c for c in df.columns if c not in (target, split)])
        return df.agg(
            F.lit(name).alias("stage"), F.lit(n_features).cast("bigint").alias("feature_count"),
            F.count_if(~F.col(split)).alias("train_rows"), F.count_if(split).alias("test_rows"),
        )

    both = stage(clean, "cleaned").unionByName(stage(engineered, "engineered"))
    before = F.first("feature_count").over(Window.orderBy("stage"))
    return both.withColumn("feature_delta", F.col("feature_count") - before)
