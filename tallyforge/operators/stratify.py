"""Exact, repeatable splits, caps, folds and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.ordering import order_hash, row_text
from tallyforge.operators.ranks import CutPlan, assign_segments, plan_cuts
from tallyforge.session import settle, spread
from tallyforge.spec import SEED, TEST_SHARE


def mark_split(
    df: DataFrame, target: str, test_share: float = TEST_SHARE, seed: int = SEED,
    key: Sequence[str] | None = None, into: str = "is_test",
) -> DataFrame:
    """Add a flag that is true on the test rows of a stratified split.

    Per class ``floor(n * (1 - test_share))`` rows go to train, at least one to either side when
    the class has more than one row; a single row goes to test.
    """
    if not 0 < test_share < 1:
        raise ValueError("test_share must lie between 0 and 1")

    def train_rows(sizes: DataFrame) -> DataFrame:
        cut = F.floor(F.col("n") * F.lit(1 - test_share))
        inner = F.greatest(F.lit(1), F.least(cut, F.col("n") - 1))
        return sizes.select(target, F.lit(0).alias("cut"), F.when(F.col("n") > 1, inner).otherwise(cut).alias("rank"))

    marked = assign_segments(df, [target], train_rows, 1, key=key, seed=seed, into=into)
    return marked.withColumn(into, F.col(into) > 0)


def stratified_split(
    df: DataFrame, target: str, test_share: float = TEST_SHARE, seed: int = SEED, key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows: disjoint, complete, exact per class."""
    marked = mark_split(df, target, test_share, seed, key, into="_is_test")
    return marked.filter("NOT _is_test").drop("_is_test"), marked.filter("_is_test").drop("_is_test")


def cap_sizes(sizes: DataFrame, target: str, max_rows: int) -> DataFrame:
    """Rows to keep per class so that shares hold and the total is at most ``max_rows``.

    Shares are rounded half to even with a floor of one row. An excess is taken from the lowest
    classes first, each down to one row; a shortfall stays.
    """
    everything = Window.partitionBy()
    lower = Window.orderBy(target).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(everything)
    share = F.greatest(F.rint(F.col("n") / F.col("total") * F.lit(max_rows)).cast("bigint"), F.lit(1))
    shares = sizes.withColumn("total", total).withColumn("share", share).withColumn("spare", F.col("share") - 1)
    excess = F.greatest(F.lit(0), F.sum("share").over(everything) - max_rows)
    trimmed = F.greatest(
        F.lit(0), F.least(F.col("spare"), F.col("excess") - F.coalesce(F.sum("spare").over(lower), F.lit(0)))
    )
    keep = F.least(F.col("n"), F.col("share") - F.col("trimmed"))
    untouched = F.lit(max_rows <= 0) | (F.col("total") <= max_rows)
    return (
        shares.withColumn("excess", excess)
        .withColumn("trimmed", trimmed)
        .select(target, "n", F.when(untouched, F.col("n")).otherwise(keep).cast("bigint").alias("keep"))
    )


def cap_plan(df: DataFrame, target: str, max_rows: int, seed: int = SEED, key: Sequence[str] | None = None) -> CutPlan:
    """Which rows a cap keeps (segment 0), as boundaries that other tables with the same key and class can be tested against."""

    def kept(sizes: DataFrame) -> DataFrame:
        return cap_sizes(sizes, target, max_rows).select(target, F.lit(0).alias("cut"), F.col("keep").alias("rank"))

    return plan_cuts(df, [target], kept, 1, key=key, seed=seed)


def capped(plan: CutPlan, df: DataFrame) -> DataFrame:
    """Rows of a table that a plan of ``cap_plan`` keeps; no row is moved."""
    return plan.mark(df, "_beyond").filter("_beyond = 0").drop("_beyond")


def stratified_cap(
    df: DataFrame, target: str, max_rows: int, seed: int = SEED, key: Sequence[str] | None = None
) -> DataFrame:
    """At most about ``max_rows`` rows with the class shares kept; no limit when ``max_rows`` <= 0."""
    if max_rows <= 0:
        return df
    df = spread(df)
    return capped(cap_plan(df, target, max_rows, seed, key), df)


def paired_cap(
    df: DataFrame, other: DataFrame, target: str, max_rows: int, seed: int = SEED, key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The same rows of two tables that share key and class, capped as ``stratified_cap`` caps the first.

    Both are tested against one plan, so neither is shuffled. Only where rows with equal keys lie at a cut, the second
    table is joined to the chosen keys instead.
    """
    if max_rows <= 0:
        return df, other
    plan = cap_plan(df, target, max_rows, seed, key)
    chosen = capped(plan, df)
    if plan.by_row or not key:
        return chosen, paired_rows(chosen, other, list(key or df.columns))
    return chosen, plan.mark_other(other, "_beyond").filter("_beyond = 0").drop("_beyond")


def paired_rows(chosen: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``other`` whose key was chosen, for a second table with the same rows."""
    return other.join(chosen.select(*key).distinct(), list(key), "left_semi")


def stratified_folds(
    df: DataFrame, target: str, k: int, seed: int = SEED, key: Sequence[str] | None = None, into: str = "fold"
) -> DataFrame:
    """Add a fold number from 0 to ``k - 1``; sizes differ by at most one, per class and in total.

    Class by class, rows are dealt to the folds in turn, each class going on where the one
    before it stopped.
    """
    if k < 2:
        raise ValueError("k must be at least 2")

    def fold_ends(sizes: DataFrame) -> DataFrame:
        lower = Window.orderBy(target).rowsBetween(Window.unboundedPreceding, -1)
        start = F.coalesce(F.sum("n").over(lower), F.lit(0))
        dealt = sizes.withColumn("start", start).select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cut"))
        upto = lambda position: F.floor((position - 1 - F.col("cut") + k) / k)  # turns of a fold before a position
        size = upto(F.col("start") + F.col("n")) - upto(F.col("start"))
        ends = F.sum(size).over(Window.partitionBy(target).orderBy("cut").rowsBetween(Window.unboundedPreceding, 0))
        return dealt.select(target, "cut", ends.alias("rank")).filter(F.col("cut") < k - 1)

    return assign_segments(df, [target], fold_ends, k - 1, key=key, seed=seed, into=into)


def seeded_sample(df: DataFrame, n: int, seed: int = SEED, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows when there are fewer."""
    size = lambda sizes: sizes.select(F.lit(0).alias("cut"), F.lit(n).alias("rank"))
    marked = assign_segments(df, [], size, 1, key=key, seed=seed, into="_beyond")
    return marked.filter("_beyond = 0").drop("_beyond")


def seeded_shuffle(df: DataFrame, seed: int = SEED, key: Sequence[str] | None = None, position: str = "position") -> DataFrame:
    """Whole table in the order of the seeded hash, with the place of each row in it, from 1.

    Rows are dealt by ranges of the hash and sorted within them, once, into the shared folder; a row's place is its number within its
    range and the sizes of the ranges before. Rows with equal keys follow in the order of a hash over all columns.
    """
    place = F.monotonically_increasing_id()
    ordered = df.withColumn("_order", order_hash(df, key, seed)).orderBy("_order", F.md5(row_text(df))).drop("_order")
    rows = settle(ordered.withColumn("_place", place).withColumn("_range", F.shiftright("_place", 33)))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")))
    number = F.col("_start") + F.col("_place") - F.shiftleft("_range", 33) + 1
    return rows.join(starts, "_range").select(*df.columns, number.alias(position))


def split_faults(whole: DataFrame, train: DataFrame, test: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows are not all in exactly one side: shared between both, lost or added."""
    part = lambda df, name: df.select(*key, F.lit(name).alias("part"))
    parts = part(whole, "whole").unionByName(part(train, "train")).unionByName(part(test, "test"))
    count = lambda name: F.count_if(F.col("part") == name)
    return (
        parts.groupBy(*key)
        .agg(count("whole").alias("in_whole"), count("train").alias("in_train"), count("test").alias("in_test"))
        .filter(
            ((F.col("in_train") > 0) & (F.col("in_test") > 0)) | (F.col("in_whole") != F.col("in_train") + F.col("in_test"))
        )
    )
