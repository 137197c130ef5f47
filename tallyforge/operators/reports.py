"""Report documents as one-row tables with nested columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.operators.profiling import imbalance, skew_report
from tallyforge.session import settle
from tallyforge.spec import TableSpec

# Texts of the reports.
COMPLETED = "completed"
DROP_STRATEGY = "drop_rows_with_missing_values"
DECISION_BASIS = "majority_to_minority_ratio_gt_2.0"
SKIPPED, NOT_RUN = "skipped_no_processed_data", "not_run"


def utc_now() -> Column:
    """Current time in UTC as ISO text."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def integer_map(values: Mapping[str, int]) -> Column:
    pairs = chain.from_iterable((F.lit(str(k)), F.lit(v).cast("bigint")) for k, v in values.items())
    return F.create_map(*pairs).cast("map<string,bigint>")


def class_maps(counts: DataFrame, target: str) -> DataFrame:
    """One row: total, counts per class and shares per class.

    ``counts`` has one row per class of the label mapping.
    """
    entries = lambda value: F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(target).cast("string"), value))))
    share = F.try_divide(F.col("rows"), F.sum("rows").over(Window.partitionBy()))
    return counts.withColumn("share", share).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), entries(F.col("rows")).alias("counts"), entries(F.col("share")).alias("shares")
    )


def preparation_report(
    quality: DataFrame,
    split: DataFrame,
    spec: TableSpec,
    *,
    source: str,
    dropped: Sequence[str],
    clean_features: Sequence[str],
    added: Sequence[str],
    files: Mapping[str, str],
) -> DataFrame:
    """One row: rows removed and why, skew, classes of both splits, features, imbalance.

    ``quality`` is the one-row quality report, ``split`` the clean table with the flag ``is_test``.
    """
    target = spec.target
    engineered = [*clean_features, *added]
    # All class figures come from one small count per side and class.
    cells = settle(split.groupBy(target, "is_test").agg(F.count(F.lit(1)).alias("rows")))
    side = lambda test: class_maps(cells.filter(F.col("is_test") == test), target).select(F.struct("*")).scalar()
    whole = cells.groupBy(target).agg(F.sum("rows").alias("rows"))
    balance = imbalance(whole, target, spec.labels.get(spec.minority_label), spec.imbalance_limit)
    skew = skew_report(split, [c for c in spec.numeric if c in split.columns], spec.skew_limit).agg(
        F.struct(
            F.collect_list("feature").alias("columns"),
            F.map_from_entries(F.collect_list(F.struct("feature", "skewness"))).alias("values"),
        )
    )
    base = quality.select(
        "*", side(False).alias("tr"), side(True).alias("te"), balance.select(F.struct("*")).scalar().alias("im"), skew.scalar().alias("sk")
    )
    splits = [
        F.col("tr.rows").alias("train_rows"), F.col("te.rows").alias("test_rows"),
        F.col("tr.counts").alias("train_class_counts"), F.col("te.counts").alias("test_class_counts"),
        F.col("tr.shares").alias("train_class_proportions"), F.col("te.shares").alias("test_class_proportions"),
    ]
    count = lambda names: F.lit(len(names)).cast("bigint")
    dataset = lambda names: F.struct(texts(names).alias("feature_columns"), count(names).alias("feature_count"), *splits)
    feature_counts = [
        count(clean_features).alias("feature_count_before"), count(engineered).alias("feature_count_after"),
        count(added).alias("feature_count_delta"),
    ]
    return base.select(
        F.lit(source).alias("selected_csv"),
        "rows_initial", "rows_after_cleaning", "rows_removed_missing", "rows_removed_malformed", "rows_removed_total",
        # The share of all removed rows, whatever the reason.
        F.col("removal_pct").alias("rows_removed_missing_pct"),
        F.lit(DROP_STRATEGY).alias("missing_value_strategy"),
        F.col("missing_by_column").alias("missing_values_by_column"),
        F.col("malformed_by_column").alias("malformed_values_by_column"),
        F.struct(
            F.col("rows_removed_missing").alias("missing"), F.col("rows_removed_malformed").alias("malformed"),
            F.col("rows_removed_total").alias("total"),
        ).alias("rows_removed_by_reason"),
        texts(dropped).alias("dropped_columns"),
        F.lit(target).alias("target_column"),
        integer_map(spec.labels).alias("target_encoding"),
        F.col("sk.columns").alias("skew_check_columns"),
        F.col("sk.values").alias("skew_values"),
        F.map_filter("sk.values", lambda _, v: F.abs(v) > spec.skew_limit).alias("high_skew_columns"),
        texts([]).alias("transformations_applied"),
        dataset(clean_features).alias("clean_dataset"),
        F.struct(
            F.lit(COMPLETED).alias("status"), texts(added).alias("engineered_columns"),
            count(engineered).alias("engineered_feature_count"), *feature_counts,
            texts(clean_features).alias("feature_columns_before"), texts(engineered).alias("feature_columns_after"),
        ).alias("feature_engineering"),
        F.struct(
            F.lit(spec.test_share).alias("test_size"), F.lit(spec.seed).alias("random_state"), *splits,
            F.col("tr.rows").alias("engineered_train_rows"), F.col("te.rows").alias("engineered_test_rows"),
        ).alias("split"),
        dataset(engineered).alias("engineered_dataset"),
        F.struct(
            "rows_initial", "rows_after_cleaning", *feature_counts,
            texts(added).alias("engineered_columns_added"), texts([]).alias("engineered_columns_removed"),
        ).alias("dataset_comparison"),
        F.struct(
            F.col("im.minority_share").alias("qso_share"), F.col("im.majority_to_minority_ratio"), F.col("im.recommendation"),
            F.lit(DECISION_BASIS).alias("decision_basis"),
        ).alias("imbalance_assessment"),
        F.struct(*[F.lit(v).alias(k) for k, v in files.items()]).alias("output_files"),
        utc_now().alias("created_at_utc"),
    )


def preparation_summary(report: DataFrame) -> DataFrame:
    """One row with the five figures that metric reports repeat; those without a value are left out."""
    counts = ("rows_removed_missing", "rows_removed_malformed", "rows_removed_total")
    sizes = ("feature_count_before", "feature_count_after")
    pairs = [(F.lit(c), F.col(c)) for c in counts] + [(F.lit(s), F.col(f"dataset_comparison.{s}")) for s in sizes]
    figures = F.create_map(*chain.from_iterable(pairs)).cast("map<string,bigint>")
    return report.select(F.map_filter(figures, lambda _, v: v.isNotNull()).alias("preprocessing_summary"))


def summary_json(report: DataFrame) -> DataFrame:
    """The summary as JSON text."""
    return preparation_summary(report).select(F.to_json("preprocessing_summary").alias("summary"))


def baseline_report(evaluation: DataFrame, info: DataFrame, summary: DataFrame, labels: Mapping[str, int], spec: TableSpec, **more: Column) -> DataFrame:
    """One row: status, time, mapping, summary, dataset and metrics of a model."""
    return evaluation.select(
        F.lit(COMPLETED).alias("status"),
        utc_now().alias("timestamp_utc"),
        F.lit(spec.seed).alias("random_state"),
        F.array(*[F.lit(v).cast("bigint") for v in spec.label_order]).alias("class_label_order"),
        integer_map(labels).alias("class_mapping"),
        summary.scalar().alias("preprocessing_summary"),
        info.select(F.struct("*")).scalar().alias("info"),
        *[value.alias(name) for name, value in more.items()],
        "accuracy", "f1_macro", "confusion_matrix", "per_class_metrics",
    ).select(
        "status", "timestamp_utc", "random_state", "class_label_order", "class_mapping", "preprocessing_summary",
        F.col("info.split_files"), F.col("info.dataset_variant"),
        F.struct(F.col("info.train_shape").alias("train"), F.col("info.test_shape").alias("test")).alias("dataset_shapes"),
        F.col("info.feature_columns"), F.col("info.n_features"), *more,
        "accuracy", "f1_macro", "confusion_matrix", "per_class_metrics",
    )


def search_columns(n_iter: int, folds: int, parallelism: int) -> dict[str, Column]:
    """Search settings as report columns."""
    return {
        "n_iter_used": F.lit(n_iter), "cv_splits": F.lit(folds), "n_jobs": F.lit(parallelism),
        "scoring": F.lit("f1_macro"), "search_backend": F.lit("spark_mllib"),
    }


def result_columns(best_params: Column, best_score: float, top: DataFrame) -> dict[str, Column]:
    """Search results as report columns; ``top`` is the short list of best trials."""
    fields = [
        "rank", "mean_test_score", "std_test_score", "mean_fit_time", "std_fit_time", "mean_score_time",
        "std_score_time", "params",
    ]
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("mean_test_score")).alias("order"), "trial", F.struct(*fields).alias("row"))))
    listed = top.agg(F.transform(ranked, lambda t: t["row"])).scalar()
    return {"best_params": best_params, "best_cv_score": F.lit(float(best_score)), "top_5_results": listed}


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    return spark.range(1).select(*[value.alias(name) for name, value in columns.items()])


def best_params_report(spark: SparkSession, search: Mapping[str, Column], results: Mapping[str, Column]) -> DataFrame:
    return one_row(spark, status=F.lit(COMPLETED), timestamp_utc=utc_now(), **search, **results)


def top_trials_report(spark: SparkSession, search: Mapping[str, Column], results: Mapping[str, Column]) -> DataFrame:
    chosen = {k: v for k, v in (search | results).items() if k in ("scoring", "n_iter_used", "top_5_results")}
    return one_row(spark, status=F.lit(COMPLETED), timestamp_utc=utc_now(), **chosen)


def importance_report(importance: DataFrame) -> DataFrame:
    """One row: features by importance, largest first. ``importance`` has one row per feature."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("order"), "feature", "importance")))
    listed = F.transform(ranked, lambda t: F.struct(t["feature"].alias("feature"), t["importance"].alias("importance")))
    return importance.agg(listed.alias("feature_importance")).select(
        F.lit(COMPLETED).alias("status"), utc_now().alias("timestamp_utc"), F.lit("mdi").alias("method"), "feature_importance"
    )


def tuned_names(prefix: str) -> dict[str, str]:
    """File names of a tuned stage; the stage without a prefix has the plain names."""
    if not prefix:
        return {"metrics": "tuned_metrics.json", "best": "best_params.json", "top": "top_trials.json"}
    return {"metrics": f"{prefix}_metrics.json", "best": f"best_params_{prefix}.json", "top": f"top_trials_{prefix}.json"}


def placeholders(spark: SparkSession, required: Sequence[str]) -> dict[str, DataFrame]:
    """Documents written when there is nothing to train on."""
    skipped = one_row(spark, status=F.lit(SKIPPED), required_files=texts(required), timestamp_utc=utc_now())
    idle = one_row(spark, status=F.lit(NOT_RUN))
    return {
        "baseline_metrics.json": skipped, "tuned_metrics.json": skipped,
        "best_params.json": idle, "feature_importance.json": idle,
    }
