"""Compare runs, stages and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.evaluation import label_grid

# Limits of the fit diagnosis.
GAP_LIMIT, SCORE_FLOOR = 0.03, 0.90


def compare_classes(order: DataFrame, base: DataFrame, tuned: DataFrame, on: Sequence[str] = ("label",)) -> DataFrame:
    """Metrics of two models side by side, in class order; what is absent counts as 0."""
    keys = list(on)
    metrics = ("precision", "recall", "f1_score")
    side = lambda df, name: df.select(
        *keys, *[F.col(m).alias(f"{name}_{m}") for m in metrics], F.col("support").alias(f"{name}_support")
    )
    joined = order.join(side(base, "baseline"), keys, "left").join(side(tuned, "tuned"), keys, "left")
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"{n}_{m}"), F.lit(0.0)).alias(f"{n}_{m}") for n in ("baseline", "tuned") for m in metrics],
        F.coalesce("tuned_support", "baseline_support", F.lit(0).cast("bigint")).alias("support"),
    )


def has_shape(cells: DataFrame, labels: Sequence[int]) -> bool:
    """Whether a long matrix has exactly the cells of the label order."""
    grid = label_grid(cells.sparkSession, labels).select("actual", "predicted")
    mine = cells.select("actual", "predicted")
    return grid.join(mine, ["actual", "predicted"], "left_anti").isEmpty() and (
        mine.join(grid, ["actual", "predicted"], "left_anti").isEmpty()
    )


def confusion_delta(base: DataFrame, tuned: DataFrame, on: Sequence[str] = ("actual", "predicted")) -> DataFrame:
    """Cell by cell difference of two long confusion matrices."""
    keys = list(on)
    a = base.select(*keys, F.col("rows").alias("base_rows"))
    b = tuned.select(*keys, F.col("rows").alias("tuned_rows"))
    zero = F.lit(0).cast("bigint")
    change = F.coalesce("tuned_rows", zero) - F.coalesce("base_rows", zero)
    return a.join(b, keys, "full_outer").select(*keys, change.alias("delta"))


def delta_bounds(delta: DataFrame) -> DataFrame:
    """Symmetric bounds around zero that hold every difference."""
    bound = F.coalesce(F.max(F.abs("delta")), F.lit(0).cast("bigint"))
    return delta.agg((-bound).alias("lower"), bound.alias("upper"))


def stage_changes(metrics: DataFrame, by: Sequence[str] = ("metric",), stage: str = "stage") -> DataFrame:
    """Change of each metric against the stage before, in percentage points."""
    before = F.lag("value").over(Window.partitionBy(*by).orderBy(stage))
    return metrics.withColumn("change_pp", (F.col("value") - before) * 100)


def fit_verdict(cv_score: Column, test_score: Column, test_accuracy: Column) -> Column:
    """Overfit, underfit, healthy, or unknown without a cross-validation score."""
    return (
        F.when(F.coalesce(cv_score, F.lit(0.0)) <= 0, "unknown")
        .when(cv_score - test_score > GAP_LIMIT, "overfit")
        .when((test_score < SCORE_FLOOR) | (test_accuracy < SCORE_FLOOR), "underfit")
        .otherwise("healthy")
    )


def diagnose_fit(runs: DataFrame) -> DataFrame:
    """Generalisation gap and verdict per run, from ``cv_f1``, ``test_f1`` and ``accuracy``."""
    known = F.col("cv_f1") > 0
    return runs.withColumn(
        "gap", F.when(known, F.col("cv_f1") - F.col("test_f1")).otherwise(0.0)
    ).withColumn("verdict", fit_verdict(F.col("cv_f1"), F.col("test_f1"), F.col("accuracy")))


def score_per_second(score: Column, seconds: Column) -> Column:
    """Score per second of fitting, 0 when no time was taken."""
    return F.coalesce(F.when(seconds > 0, F.try_divide(score, seconds)), F.lit(0.0))
