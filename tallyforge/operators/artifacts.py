"""Read decisions out of report documents and check that documents agree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.parsing import bound, json_integer, json_number
from tallyforge.session import spread
from tallyforge.spec import IMBALANCE_LIMIT

# Where a report may hold the advice and the ratio, in this order.
ADVICE_PATHS = ("$.imbalance_recommendation", "$.imbalance_assessment.recommendation")
RATIO_PATHS = (
    "$.majority_minority_ratio", "$.imbalance_ratio",
    "$.class_balance.majority_minority_ratio", "$.imbalance_assessment.majority_to_minority_ratio",
)
MAPPING_PATHS = ("$.class_mapping", "$.target_encoding")
METRIC_KEYS = ("accuracy", "f1_macro", "confusion_matrix", "per_class_metrics")
# Messages of the consistency check.
ISSUES = {
    "baseline": "baseline_metrics.json status is not completed.",
    "tuned": "tuned_metrics.json status is not completed.",
    "importance": "feature_importance.json status is not completed.",
    "order": "Missing class_label_order in tuned metrics.",
    "matrix": "Confusion matrix shape does not match class_label_order.",
    "engineered": "Feature column sets do not match the engineered baseline/tuned comparison metadata.",
    "features": "Feature column order differs between baseline and tuned metrics.",
}


def needs_balancing(report: Column, limit: float = IMBALANCE_LIMIT) -> Column:
    """Whether a JSON report advises class weights: by text, else by its ratio, else not."""

    def advises(document: Column) -> Column:
        def tells(path: str) -> Column:
            # Only a text counts as advice, not an object that holds the word.
            is_text = F.schema_of_variant(F.try_variant_get(document, path, "variant")) == "STRING"
            says = F.lower(F.try_variant_get(document, path, "string")).contains("balanced")
            return F.coalesce(is_text & says, F.lit(False))

        given = [F.try_variant_get(document, path, "variant") for path in RATIO_PATHS]
        ratio = json_number(F.coalesce(*[F.when(~F.is_variant_null(value), value) for value in given]))
        return tells(ADVICE_PATHS[0]) | tells(ADVICE_PATHS[1]) | F.coalesce(ratio > limit, F.lit(False))

    return F.coalesce(bound(F.try_parse_json(report), advises), F.lit(False))


def class_mapping(report: Column, default: Mapping[str, int]) -> Column:
    """Label to id as the report says; a number loses its fraction, entries that are no integer are skipped."""
    def ids(document: Column) -> Column:
        given = [F.try_variant_get(document, path, "variant") for path in MAPPING_PATHS]
        chosen = F.coalesce(*[F.when(~F.is_variant_null(value), value) for value in given])
        return F.transform_values(F.try_variant_get(chosen, "$", "map<string,variant>"), lambda _, v: json_integer(v))

    parsed = F.map_filter(bound(F.try_parse_json(report), ids), lambda _, v: v.isNotNull())
    known = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v).cast("bigint")) for k, v in default.items()))
    return F.when(F.size(F.map_keys(parsed)) > 0, parsed).otherwise(known)


def missing_features(base: Column, tuned: Column) -> Column:
    """Features of the first list that the second lacks."""
    return F.array_except(base, tuned)


def is_feature_subset(base: Column, tuned: Column) -> Column:
    return F.size(missing_features(base, tuned)) == 0


def artifact_issues(df: DataFrame, baseline: str, tuned: str, importance: str, into: str = "issues") -> DataFrame:
    """Add the messages about three JSON documents that do not fit together.

    Every document is parsed once; the rest works on its top-level values.
    """
    df = spread(df)
    rest = [c for c in df.columns if c not in (baseline, tuned, importance)]
    names = {baseline: "_b", tuned: "_t", importance: "_i"}
    value = lambda document, key: F.try_element_at(document, F.lit(key))
    opened = df.select(*rest, *[F.from_json(c, "map<string,string>").alias(short) for c, short in names.items()])
    order, matrix = value("_t", "class_label_order"), value("_t", "confusion_matrix")
    features = {s: F.coalesce(value(s, "feature_columns"), F.lit("[]")) for s in ("_b", "_t")}
    as_list = lambda text: F.from_json(text, "array<string>")
    facts = opened.select(
        *rest,
        *[(~F.coalesce(value(s, "status") == "completed", F.lit(False))).alias(f"_open{s}") for s in names.values()],
        F.size(F.coalesce(as_list(order), F.array())).alias("_order"),
        F.size(F.coalesce(as_list(matrix), F.array())).alias("_matrix"),
        F.coalesce(~matrix.startswith("["), F.lit(False)).alias("_no_matrix"),
        (features["_b"] != features["_t"]).alias("_differ"),
        F.coalesce(F.get_json_object(value("_t", "feature_engineering"), "$.status") == "completed", F.lit(False)).alias("_engineered"),
        *[as_list(text).alias(f"_features{s}") for s, text in features.items()],
    )
    subset = F.coalesce(is_feature_subset(F.col("_features_b"), F.col("_features_t")), F.lit(False))
    tests = {
        "baseline": F.col("_open_b"),
        "tuned": F.col("_open_t"),
        "importance": F.col("_open_i"),
        "order": F.col("_order") == 0,
        "matrix": F.col("_no_matrix") | (F.col("_matrix") != F.col("_order")),
        "engineered": F.col("_differ") & F.col("_engineered") & ~subset,
        "features": F.col("_differ") & ~F.col("_engineered"),
    }
    messages = F.array_compact(F.array(*[F.when(test, F.lit(ISSUES[name])) for name, test in tests.items()]))
    return facts.select(*rest, messages.alias(into))


def metrics_available(payload: Column) -> Column:
    """Whether a JSON payload holds any metric."""
    return F.coalesce(F.arrays_overlap(F.json_object_keys(payload), F.array(*[F.lit(k) for k in METRIC_KEYS])), F.lit(False))


def payload_available(payload: Column) -> Column:
    """Whether a JSON payload is an object with any key."""
    return F.coalesce(F.size(F.json_object_keys(payload)), F.lit(0)) > 0


def missing_artifacts(artifacts: DataFrame, expected: Mapping[str, bool], by: Sequence[str] = ("run",)) -> DataFrame:
    """Expected documents that a run lacks.

    ``artifacts`` has the run, ``artifact`` and ``payload``; ``expected`` maps a name to whether
    it must hold metrics.
    """
    usable = F.lit(False)
    for name, with_metrics in expected.items():
        test = metrics_available if with_metrics else payload_available
        usable = usable | ((F.col("artifact") == name) & test(F.col("payload")))
    names = F.array(*[F.lit(n) for n in expected])
    wanted = artifacts.select(*by).distinct().select(*by, F.explode(names).alias("artifact"))
    return wanted.join(artifacts.filter(usable), [*by, "artifact"], "left_anti")
