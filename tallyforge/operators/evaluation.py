"""Classification metrics; all of them derive from one count per (actual, predicted)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import settle


def prediction_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per pair of true and predicted class: the only pass over the predictions."""
    pairs = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
    return settle(pairs.agg(F.count(F.lit(1)).alias("rows")))


def label_grid(spark: SparkSession, labels: Sequence[int]) -> DataFrame:
    """Every cell of the matrix over a given label order."""
    values = F.array(*[F.lit(v).cast("bigint") for v in labels])
    return (
        spark.range(1)
        .select(F.posexplode(values).alias("row", "actual"))
        .select("*", F.posexplode(values).alias("column", "predicted"))
    )


def confusion_cells(counts: DataFrame, labels: Sequence[int]) -> DataFrame:
    """Confusion matrix in long form, zeros included; pairs outside the order are left out."""
    grid = label_grid(counts.sparkSession, labels)
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "row", "column", "actual", "predicted", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
    )


def observed_class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class seen in the truth or the predictions."""
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("rows").alias("support"), F.lit(0).cast("bigint").alias("chosen")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("rows").alias("chosen")),
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return (
        counts.select(hit.alias("hits"), F.inline(sides))
        .groupBy("label")
        # Each pair is listed once per side, so a hit is counted twice.
        .agg((F.sum("hits") / 2).alias("hits"), F.sum("support").alias("support"), F.sum("chosen").alias("chosen"))
        .select(
            "label",
            ratio(F.col("hits"), F.col("chosen")).alias("precision"),
            ratio(F.col("hits"), F.col("support")).alias("recall"),
            ratio(2 * F.col("hits"), F.col("chosen") + F.col("support")).alias("f1_score"),
            "support",
        )
    )


def class_metrics(counts: DataFrame, labels: Sequence[int]) -> DataFrame:
    """Metrics of each class of the label order; a class never seen has zeros."""
    order = counts.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(v).cast("bigint") for v in labels])).alias("label")
    )
    zero = F.lit(0.0)
    return order.join(observed_class_metrics(counts), "label", "left").select(
        "label",
        *[F.coalesce(F.col(m), zero).alias(m) for m in ("precision", "recall", "f1_score")],
        F.coalesce("support", F.lit(0).cast("bigint")).alias("support"),
    )


def accuracy(counts: DataFrame) -> DataFrame:
    """Share of rows predicted right, over all rows."""
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0))
    return counts.agg(F.coalesce(F.try_divide(hits, F.sum("rows")), F.lit(0.0)).alias("accuracy"))


def macro_f1(counts: DataFrame) -> DataFrame:
    """Unweighted mean F1 over the classes seen in the truth or the predictions."""
    return observed_class_metrics(counts).agg(F.coalesce(F.avg("f1_score"), F.lit(0.0)).alias("f1_macro"))


def error_metrics(cells: DataFrame, per_class: DataFrame) -> DataFrame:
    """One row: error rate under its four names and the balanced error; all 0 without rows."""
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0))
    right = F.try_divide(hits, F.sum("rows"))
    recall = per_class.agg(F.avg("recall")).scalar()
    error = F.coalesce(1 - F.col("right"), F.lit(0.0))
    balanced = F.when(F.col("right").isNotNull(), 1 - F.coalesce(F.col("mean_recall"), F.col("right")))
    return (
        cells.agg(right.alias("right"))
        .select("right", recall.alias("mean_recall"))
        .select(
            *[error.alias(n) for n in ("error_rate", "zero_one_loss", "hamming_loss", "mean_classification_error")],
            F.coalesce(balanced, F.lit(0.0)).alias("balanced_error_rate"),
        )
    )


def evaluation_row(counts: DataFrame, labels: Sequence[int]) -> DataFrame:
    """One row: accuracy, macro F1, nested confusion matrix and metrics per class."""
    lines = (
        confusion_cells(counts, labels)
        .groupBy("row")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("column", "rows"))), lambda c: c["rows"]).alias("line"))
    )
    matrix = lines.agg(F.transform(F.sort_array(F.collect_list(F.struct("row", "line"))), lambda c: c["line"]))
    entry = F.struct(F.col("label").cast("string"), F.struct("precision", "recall", "f1_score", "support"))
    per_class = class_metrics(counts, labels).agg(F.map_from_entries(F.collect_list(entry)))
    return accuracy(counts).select(
        "accuracy",
        macro_f1(counts).scalar().alias("f1_macro"),
        matrix.scalar().alias("confusion_matrix"),
        per_class.scalar().alias("per_class_metrics"),
    )


def dataset_info(train: DataFrame, test: DataFrame, features: Sequence[str], variant: str) -> DataFrame:
    """One row: variant, shapes and features of a split."""
    shape = lambda rows: F.array(rows, F.lit(len(features)).cast("bigint"))
    return train.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(variant).alias("dataset_variant"),
        shape(F.col("n")).alias("train_shape"),
        shape(test.agg(F.count(F.lit(1))).scalar()).alias("test_shape"),
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
        F.lit(len(features)).cast("bigint").alias("n_features"),
    )
