"""Prepared tables to models, metric documents and a model registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.models.forest import BASELINE, BINS, LAYOUT, evaluate_forest, feature_importance, train_forest
from tallyforge.models.registry import model_entry, save_model, write_registry
from tallyforge.models.search import BALANCED_SPACE, SPACE, random_search
from tallyforge.operators.artifacts import class_mapping, needs_balancing
from tallyforge.operators.evaluation import dataset_info, evaluation_row
from tallyforge.operators.features import engineer
from tallyforge.operators.quality import feature_columns
from tallyforge.operators.reports import (
    baseline_report, best_params_report, importance_report, placeholders, preparation_summary, result_columns,
    search_columns, texts, top_trials_report, tuned_names,
)
from tallyforge.operators.stratify import stratified_cap
from tallyforge.plans.prepare import REPORT
from tallyforge.sources.documents import read_document, read_document_text, write_document
from tallyforge.sources.tables import CLEAN_PAIR, ENGINEERED_PAIR, read_split, write_parquet
from tallyforge.spec import SKY_OBJECTS, TableSpec

SUMMARY = (
    "rows_removed_missing bigint, rows_removed_malformed bigint, rows_removed_total bigint, "
    "dataset_comparison struct<feature_count_before:bigint,feature_count_after:bigint>, "
    "feature_engineering struct<status:string,engineered_columns:array<string>,engineered_feature_count:bigint,"
    "feature_count_before:bigint,feature_count_after:bigint,feature_count_delta:bigint,"
    "feature_columns_before:array<string>,feature_columns_after:array<string>>"
)


def _params(values: dict[str, object]) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])


def _nothing() -> Column:
    """Empty JSON object."""
    return F.create_map().cast("map<string,string>")


def _settings(spark: SparkSession, folder: str, spec: TableSpec) -> tuple[DataFrame | None, dict[str, int], bool]:
    """Report, label mapping and balancing advice; defaults without a report."""
    try:
        text = read_document_text(spark, f"{folder}/{REPORT}")
    except FileNotFoundError:
        return None, dict(spec.labels), False
    row = text.select(class_mapping(F.col("payload"), spec.labels).alias("m"), needs_balancing(F.col("payload")).alias("b")).first()
    return read_document(spark, f"{folder}/{REPORT}", SUMMARY), dict(row["m"]), row["b"]


def train(
    spark: SparkSession,
    prepared: str,
    output: str,
    spec: TableSpec = SKY_OBJECTS,
    *,
    n_iter: int = 20,
    folds: int = 5,
    max_rows: int = 0,
    parallelism: int = 4,
    space: dict[str, list] | None = None,
    baseline: dict[str, object] = BASELINE,
    key: Sequence[str] | None = None,
    max_bins: int = BINS,
    partitions: int = LAYOUT,
) -> dict[str, DataFrame]:
    """Fit the baseline, a tuned model on the clean and one on the engineered features.

    Returns the metric reports by stage. Without prepared tables only placeholders are written.
    """
    try:
        clean_train, clean_test, clean_names = read_split(spark, prepared, [CLEAN_PAIR, ENGINEERED_PAIR])
    except FileNotFoundError:
        required = [f"{prepared}/{name}" for pair in (CLEAN_PAIR, ENGINEERED_PAIR) for name in pair[:2]]
        documents = placeholders(spark, required)
        for name, df in documents.items():
            write_document(df, f"{output}/{name}")
        return documents
    full_train, full_test, full_names = read_split(spark, prepared, [ENGINEERED_PAIR, CLEAN_PAIR])

    report, labels, unbalanced = _settings(spark, prepared, spec)
    summary = preparation_summary(report) if report is not None else spark.range(1).select(_nothing().alias("preprocessing_summary"))
    space = space or (BALANCED_SPACE if unbalanced else SPACE)
    if max_rows > 0:
        # One sample serves both stages: the derived columns are computed on the sampled rows.
        path = f"{output}/_sampled.parquet"
        write_parquet(stratified_cap(clean_train, spec.target, max_rows, spec.seed, key), path)
        clean_train = spark.read.parquet(path)
        full_train = engineer(clean_train, spec) if clean_names != full_names else clean_train

    reports: dict[str, DataFrame] = {}
    entries = []

    def keep(stage: str, name: str, model, mode: str) -> None:
        path = f"{output}/{name}"
        save_model(model, path)
        entries.append(model_entry(stage, model, path, mode, labels))

    def metrics(model, train_df: DataFrame, test_df: DataFrame, pair, **more: Column) -> DataFrame:
        features = feature_columns(train_df, spec.target)
        files = F.struct(F.lit(pair[0]).alias("train"), F.lit(pair[1]).alias("test")).alias("split_files")
        info = dataset_info(train_df, test_df, features, pair[2]).select(files, "*")
        counts = evaluate_forest(model, test_df, spec.target)
        return baseline_report(evaluation_row(counts, spec.label_order), info, summary, labels, spec, **more)

    features = feature_columns(clean_train, spec.target)
    model = train_forest(clean_train, features, spec.target, baseline, spec.seed, max_bins, partitions)
    reports["baseline"] = metrics(model, clean_train, clean_test, clean_names)
    write_document(reports["baseline"], f"{output}/baseline_metrics.json")
    keep("baseline", "model_baseline", model, "clean" if clean_names[2] == "cleaned" else "engineered")

    for prefix, train_df, test_df, pair in (
        ("clean_tuned", clean_train, clean_test, clean_names), ("", full_train, full_test, full_names),
    ):
        features = feature_columns(train_df, spec.target)
        found = random_search(
            train_df, features, spec.target, n_iter=n_iter, folds=folds, space=space, seed=spec.seed, key=key,
            parallelism=parallelism, max_bins=max_bins, partitions=partitions,
        )
        search = search_columns(max(1, n_iter), max(2, folds), parallelism)
        results = result_columns(_params(found.best_params), found.best_score, found.top())
        engineering = _nothing() if prefix or report is None else report.select("feature_engineering").scalar()
        stage = prefix or "tuned"
        reports[stage] = metrics(found.model, train_df, test_df, pair, feature_engineering=engineering, **search, **results)
        names = tuned_names(prefix)
        write_document(reports[stage], f"{output}/{names['metrics']}")
        write_document(best_params_report(spark, search, results), f"{output}/{names['best']}")
        write_document(top_trials_report(spark, search, results), f"{output}/{names['top']}")
        mode = "engineered" if pair[2] == "engineered" else "clean"
        keep(stage, f"model_{prefix}" if prefix else "model", found.model, mode)

    write_document(importance_report(feature_importance(found.model, full_train)), f"{output}/feature_importance.json")
    write_registry(spark, entries, output)
    return reports
