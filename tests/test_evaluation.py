import json

import pytest
from pyspark.sql import functions as F

from tallyforge import SKY_OBJECTS
from tallyforge.operators import artifacts, comparison, evaluation, reports, trials


@pytest.fixture(scope="module")
def counts(spark):
    pairs = list(zip([0, 0, 1, 1, 2], [0, 1, 1, 1, 0]))
    return evaluation.prediction_counts(spark.createDataFrame(pairs, "y bigint, p bigint"), "y", "p")


ORDER = [0, 1, 2]


def test_metrics(counts):
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in evaluation.confusion_cells(counts, ORDER).collect()}
    assert [[cells[a, p] for p in ORDER] for a in ORDER] == [[1, 1, 0], [0, 2, 0], [1, 0, 0]]
    rows = {r["label"]: r for r in evaluation.class_metrics(counts, ORDER).collect()}
    assert tuple(rows[0])[1:] == (0.5, 0.5, 0.5, 2)
    assert tuple(rows[1])[1:] == (pytest.approx(2 / 3), 1.0, pytest.approx(0.8), 2)
    assert tuple(rows[2])[1:] == (0.0, 0.0, 0.0, 1)
    assert evaluation.accuracy(counts).first()[0] == pytest.approx(0.6)
    assert evaluation.macro_f1(counts).first()[0] == pytest.approx(0.433333, abs=1e-6)
    errors = evaluation.error_metrics(evaluation.confusion_cells(counts, ORDER), evaluation.class_metrics(counts, ORDER)).first()
    assert errors["error_rate"] == errors["hamming_loss"] == pytest.approx(0.4) and errors["balanced_error_rate"] == pytest.approx(0.5)


def test_evaluation_row(counts):
    row = evaluation.evaluation_row(counts, ORDER).first()
    assert row["confusion_matrix"] == [[1, 1, 0], [0, 2, 0], [1, 0, 0]]
    assert row["per_class_metrics"]["1"].asDict() == {"precision": pytest.approx(2 / 3), "recall": 1.0, "f1_score": pytest.approx(0.8), "support": 2}
    turned = evaluation.evaluation_row(counts, [2, 1, 0]).first()
    assert turned["confusion_matrix"] == [[0, 0, 1], [0, 2, 0], [0, 1, 1]]


def test_labels_outside_the_order_count_in_the_macro_mean(spark):
    df = spark.createDataFrame([(0, 0), (7, 0)], "y bigint, p bigint")
    counts = evaluation.prediction_counts(df, "y", "p")
    assert evaluation.macro_f1(counts).first()[0] == pytest.approx((2 / 3 + 0) / 2)
    assert sum(r["rows"] for r in evaluation.confusion_cells(counts, ORDER).collect()) == 1


def test_nothing_to_evaluate(counts):
    empty = counts.limit(0)
    errors = evaluation.error_metrics(evaluation.confusion_cells(empty, ORDER), evaluation.class_metrics(empty, ORDER)).first()
    assert set(errors.asDict().values()) == {0.0}
    assert evaluation.accuracy(empty).first()[0] == 0.0 and evaluation.macro_f1(empty).first()[0] == 0.0


def test_deltas(spark, counts):
    cells = evaluation.confusion_cells(counts, ORDER)
    other = evaluation.confusion_cells(evaluation.prediction_counts(spark.createDataFrame([(0, 0)] * 4, "y bigint, p bigint"), "y", "p"), ORDER)
    delta = comparison.confusion_delta(cells, other)
    assert {r["delta"] for r in delta.collect()} == {3, -1, -2, 0}
    assert tuple(comparison.delta_bounds(delta).first()) == (-3, 3)
    assert comparison.has_shape(cells, ORDER)
    assert not comparison.has_shape(cells, [0, 1]) and not comparison.has_shape(cells, [0, 1, 2, 3])


@pytest.mark.parametrize(("cv", "f1", "acc", "verdict"), [
    (0.0, 0.95, 0.95, "unknown"), (0.99, 0.95, 0.95, "overfit"), (0.90, 0.89, 0.95, "underfit"), (0.97, 0.96, 0.97, "healthy"),
    (0.97, 0.96, 0.80, "underfit"),
])
def test_diagnosis(spark, cv, f1, acc, verdict):
    row = comparison.diagnose_fit(spark.createDataFrame([(cv, f1, acc)], "cv_f1 double, test_f1 double, accuracy double")).first()
    assert row["verdict"] == verdict


def test_rates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "s double, t double")
    assert [r[0] for r in df.select(comparison.score_per_second(F.col("s"), F.col("t"))).collect()] == [0.5, 0.0, 0.0]


def _trials(spark, best, tuned="{}"):
    df = spark.createDataFrame([(1, best if isinstance(best, str) else json.dumps(best), tuned)], "run int, best string, tuned string")
    return trials.trial_table(df, "best", "tuned").collect()


def test_trial_table(spark):
    items = [{"rank": r, "mean_test_score": m, "mean_fit_time": 2, "params": {"n_estimators": i}} for i, (r, m) in enumerate([(2, 0.5), (1, 0.8), (2, 0.7), (9, 0.1), (3, 0.4), (4, 0.2)])]
    rows = _trials(spark, {"top_5_results": [], "top_results": [3, *items]})
    assert [r["n_estimators"] for r in rows] == ["1", "2", "0", "4", "5"]
    assert rows[0]["source"] == "saved-top5" and rows[0]["f1_per_fit_second"] == pytest.approx(0.4)
    alias = _trials(spark, {"cv_results_top5": [{"cv_macro_f1": "0.25", "mean_test_score": None, "best_params": {"max_depth": 3}, "class_weight": "balanced"}]})
    # A key that is there counts even without a value.
    assert (alias[0]["rank"], alias[0]["cv_macro_f1"], alias[0]["max_depth"], alias[0]["class_weight"]) == (1, 0.0, "3", "balanced")


def test_trial_table_without_trials(spark):
    row = _trials(spark, {"best_cv_score": 0.75}, '{"best_params": {"n_estimators": 300}}')[0]
    assert (row["source"], row["rank"], row["cv_macro_f1"], row["n_estimators"], row["f1_per_fit_second"]) == ("best-only", 1, 0.75, "300", 0.0)
    for broken in ("", "[1]", "{", "null"):
        assert _trials(spark, broken)[0]["source"] == "best-only"


def test_ranks(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7), (3, 0.1)], "trial int, mean_test_score double")
    assert {r["trial"]: r["rank"] for r in trials.rank_trials(df).collect()} == {0: 3, 1: 1, 2: 1, 3: 4}
    assert [r["trial"] for r in trials.top_trials(df, 2).collect()] == [1, 2]


@pytest.mark.parametrize(("report", "flag"), [
    ({"imbalance_recommendation": "use Balanced"}, True), ({"imbalance_assessment": {"recommendation": "use_class_weight_balanced"}}, True),
    ({"imbalance_assessment": {"recommendation": "class_weight_not_required", "majority_to_minority_ratio": 2.5}}, True),
    ({"imbalance_ratio": 2.0}, False), ({"majority_minority_ratio": "x", "imbalance_ratio": 5}, False), ({}, False),
    ({"majority_minority_ratio": None, "class_balance": {"majority_minority_ratio": 3}}, True), ({"imbalance_recommendation": {"a": "balanced"}}, False),
])
def test_balancing(spark, report, flag):
    df = spark.createDataFrame([(json.dumps(report),)], "r string")
    assert df.select(artifacts.needs_balancing(F.col("r"))).first()[0] is flag


@pytest.mark.parametrize(("report", "mapping"), [
    ({"class_mapping": {"A": 1, "B": "2", "C": None}}, {"A": 1, "B": 2}), ({"target_encoding": {"X": 5}}, {"X": 5}),
    ({"class_mapping": {"A": "q"}, "target_encoding": {"X": 5}}, {"D": 0}), ({"class_mapping": [1]}, {"D": 0}), ({}, {"D": 0}),
])
def test_mapping(spark, report, mapping):
    df = spark.createDataFrame([(json.dumps(report),)], "r string")
    assert df.select(artifacts.class_mapping(F.col("r"), {"D": 0})).first()[0] == mapping


def test_artifacts(spark):
    good = {"status": "completed", "feature_columns": ["a"], "class_label_order": [0, 1], "confusion_matrix": [[1, 0], [0, 1]]}
    make = lambda b, t, i: artifacts.artifact_issues(
        spark.createDataFrame([tuple(json.dumps(d) for d in (b, t, i))], "b string, t string, i string"), "b", "t", "i").first()["issues"]
    assert make(good, good, good) == []
    assert len(make({}, {}, {})) == 4
    assert make(good, good | {"feature_columns": ["b"]}, good) == [artifacts.ISSUES["features"]]
    engineered = good | {"feature_columns": ["b", "a"], "feature_engineering": {"status": "completed"}}
    assert make(good, engineered, good) == []
    assert make(good | {"feature_columns": ["z"]}, engineered, good) == [artifacts.ISSUES["engineered"]]
    documents = spark.createDataFrame([(1, "m", '{"accuracy": 1}'), (2, "m", "{}"), (2, "p", '{"x": 1}')], "run int, artifact string, payload string")
    missing = artifacts.missing_artifacts(documents, {"m": True, "p": False})
    assert {tuple(r) for r in missing.collect()} == {(1, "p"), (2, "m")}


def test_report_names(spark):
    assert reports.tuned_names("") == {"metrics": "tuned_metrics.json", "best": "best_params.json", "top": "top_trials.json"}
    assert reports.tuned_names("a")["best"] == "best_params_a.json"
    documents = reports.placeholders(spark, ["x", "y"])
    assert documents["tuned_metrics.json"].first()["required_files"] == ["x", "y"]
    assert documents["best_params.json"].first()["status"] == "not_run"
    assert SKY_OBJECTS.label_order == [0, 1, 2]
