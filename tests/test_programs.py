import json
import random

import pytest
from pyspark.sql import functions as F

from tallyforge import SKY_OBJECTS
from tallyforge.models import forest, scoring, search
from tallyforge.models.registry import find_model, load_model, read_registry
from tallyforge.plans.prepare import prepare
from tallyforge.plans.score import score_file
from tallyforge.plans.train import train
from tallyforge.sources import documents, tables
from tallyforge.streaming.scoring import read_stream, score_stream
from tests.conftest import write_csv

HEADER = ["obj_ID", *SKY_OBJECTS.numeric, "MJD", "class", "extra"]
SHIFT = {"STAR": 0.0, "GALAXY": 3.0, "QSO": 6.0}
SPACE = {"n_estimators": [3, 5], "max_depth": [2, 3], "min_samples_split": [2], "max_features": ["sqrt"], "class_weight": [None, "balanced"]}


def sky_rows(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.choices(list(SHIFT), [6, 3, 1])[0]
        rows.append([i, *[round(rng.gauss(SHIFT[label], 1), 4) for _ in SKY_OBJECTS.numeric], 5, label, i % 4])
    return rows


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Raw folder, prepared tables and trained models of one small run."""
    root = tmp_path_factory.mktemp("world")
    rows = sky_rows(400)
    rows[0][3], rows[1][-2], rows[2][4] = "NA", "COMET", "1.0f"
    write_csv(root / "raw" / "b.csv", [["x"], [1]])
    write_csv(root / "raw" / "a one.csv", [HEADER, *rows])
    prepare(spark, str(root / "raw"), str(root / "prepared"), first_only=True)
    train(spark, str(root / "prepared"), str(root / "models"), n_iter=2, folds=2, space=SPACE, max_rows=200,
          baseline=forest.BASELINE | {"n_estimators": 5, "max_depth": 4}, parallelism=2)
    return root


def read_json(path):
    parts = [p for p in path.iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    return json.loads(parts[0].read_text())


def test_prepared_tables(spark, world):
    clean_train, clean_test, names = tables.read_split(spark, str(world / "prepared"), [tables.CLEAN_PAIR, tables.ENGINEERED_PAIR])
    assert names == tables.CLEAN_PAIR
    assert clean_train.columns == [*SKY_OBJECTS.numeric, "extra", "class"]
    full = spark.read.parquet(str(world / "prepared" / "train.parquet"))
    assert len(full.columns) == 10 + 19 and full.count() == clean_train.count()
    assert clean_train.count() + clean_test.count() == 397
    assert clean_train.intersect(clean_test).isEmpty()


def test_preparation_report(world):
    report = read_json(world / "prepared" / "preprocessing_report.json")
    assert report["selected_csv"] == "a one.csv" and report["dropped_columns"] == ["obj_ID", "MJD"]
    assert (report["rows_initial"], report["rows_after_cleaning"], report["rows_removed_total"]) == (400, 397, 3)
    assert report["rows_removed_by_reason"] == {"missing": 1, "malformed": 2, "total": 3}
    assert report["missing_values_by_column"] == {"u": 1} and report["malformed_values_by_column"]["g"] == 1
    assert report["rows_removed_missing_pct"] == pytest.approx(0.75)
    assert report["target_encoding"] == SKY_OBJECTS.labels and report["transformations_applied"] == []
    assert report["feature_engineering"]["engineered_feature_count"] == 28 == report["engineered_dataset"]["feature_count"]
    split = report["split"]
    assert split["train_rows"] + split["test_rows"] == 397 and sum(split["train_class_proportions"].values()) == pytest.approx(1)
    assert report["imbalance_assessment"]["recommendation"] == "use_class_weight_balanced"
    assert report["imbalance_assessment"]["decision_basis"] == "majority_to_minority_ratio_gt_2.0"
    assert report["output_files"]["engineered_test_parquet"] == "test.parquet" and report["created_at_utc"].endswith("+00:00")


def test_training_documents(spark, world):
    models = world / "models"
    base, tuned = read_json(models / "baseline_metrics.json"), read_json(models / "tuned_metrics.json")
    assert base["status"] == tuned["status"] == "completed" and base["class_label_order"] == [0, 1, 2]
    assert base["dataset_shapes"]["train"] == [200, 9] and tuned["dataset_shapes"]["train"] == [200, 28]
    assert base["n_features"] == 9 and base["dataset_variant"] == "cleaned" and tuned["dataset_variant"] == "engineered"
    assert base["split_files"] == {"train": "train_clean.parquet", "test": "test_clean.parquet"}
    assert base["preprocessing_summary"]["rows_removed_total"] == 3 and base["accuracy"] > 0.7
    assert sum(map(sum, base["confusion_matrix"])) == base["dataset_shapes"]["test"][0]
    assert read_json(models / "clean_tuned_metrics.json")["feature_engineering"] == {}
    assert tuned["feature_engineering"]["status"] == "completed" and tuned["n_iter_used"] == 2 and tuned["scoring"] == "f1_macro"
    assert [t["rank"] for t in tuned["top_5_results"]] == sorted(t["rank"] for t in tuned["top_5_results"])
    assert tuned["best_cv_score"] == pytest.approx(tuned["top_5_results"][0]["mean_test_score"])
    assert read_json(models / "best_params_clean_tuned.json")["best_params"]["n_estimators"] in (3, 5)
    assert set(read_json(models / "top_trials.json")) == {"status", "timestamp_utc", "scoring", "n_iter_used", "top_5_results"}
    items = read_json(models / "feature_importance.json")["feature_importance"]
    assert len(items) == 28 and sum(i["importance"] for i in items) == pytest.approx(1)
    assert [i["importance"] for i in items] == sorted((i["importance"] for i in items), reverse=True)
    registry = read_registry(spark, str(models))
    assert {r["name"]: r["feature_mode"] for r in registry.collect()} == {"baseline": "clean", "clean_tuned": "clean", "tuned": "engineered"}
    with pytest.raises(KeyError):
        find_model(registry, "other")
    texts = documents.read_documents_in_order(spark, {n: str(models / f"{n}.json") for n in ("tuned_metrics", "nothing", "best_params")})
    assert texts["nothing"] == texts["best_params"] == "{}" and json.loads(texts["tuned_metrics"])["status"] == "completed"


def test_placeholders(spark, tmp_path):
    train(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert read_json(tmp_path / "out" / "baseline_metrics.json")["status"] == "skipped_no_processed_data"
    assert read_json(tmp_path / "out" / "best_params.json") == {"status": "not_run"}


def sky_spec():
    return SKY_OBJECTS.with_(numeric=(*SKY_OBJECTS.numeric, "extra"))


@pytest.mark.parametrize("name", ["baseline", "tuned"])
def test_scoring(spark, world, tmp_path, name):
    path = write_csv(tmp_path / "in.csv", [HEADER, *sky_rows(60, seed=9)])
    out = score_file(spark, path, str(world / "models"), name, sky_spec())
    assert out.columns == [*SKY_OBJECTS.numeric, "extra", "predicted_class_id", "predicted_class", "prob_STAR", "prob_GALAXY", "prob_QSO"]
    rows = out.collect()
    assert len(rows) == 60 and rows[0]["alpha"] == str(sky_rows(60, seed=9)[0][1])
    assert all(r["prob_STAR"] + r["prob_GALAXY"] + r["prob_QSO"] == pytest.approx(1) for r in rows)
    assert sum(r["predicted_class"] == want[-2] for r, want in zip(rows, sky_rows(60, seed=9))) > 40


def test_scoring_rejects_or_sets_aside(spark, world, tmp_path):
    bad = sky_rows(10)
    bad[4][2] = "oops"
    path = write_csv(tmp_path / "in.csv", [HEADER, *bad])
    with pytest.raises(Exception, match="missing or no number"):
        score_file(spark, path, str(world / "models"), "tuned", sky_spec()).collect()
    assert score_file(spark, path, str(world / "models"), "tuned", sky_spec(), on_invalid="quarantine").count() == 9
    with pytest.raises(ValueError, match="redshift"):
        scoring.coerce_inputs(tables.read_delimited(spark, path).drop("redshift"), SKY_OBJECTS)


def test_stream(spark, world, tmp_path):
    rows = sky_rows(20, seed=5)
    rows[3][1] = ""
    write_csv(tmp_path / "in" / "one.csv", [HEADER, *rows])
    entry = find_model(read_registry(spark, str(world / "models")), "tuned")
    model = load_model(entry["path"])
    query = score_stream(read_stream(spark, str(tmp_path / "in"), HEADER), model, sky_spec(), str(tmp_path / "out"), str(tmp_path / "cp"), "engineered")
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out" / "predictions")).count() == 19
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine")).count() == 1


def test_probability_of_an_absent_class(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 5.0)] * 20, "label double, x double")
    model = forest.train_forest(df, ["x"], "label", forest.BASELINE | {"n_estimators": 2, "max_depth": 2})
    row = scoring.predict(df.select("x"), model, {0: "A", 1: "B", 4: "E"}).first()
    assert row["prob_E"] == 0.0 and row["prob_A"] + row["prob_B"] == pytest.approx(1)


def test_same_seed_same_forest(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 3), float(i % 3) + (i % 7) / 5, float(i % 5)) for i in range(300)], "label double, x double, y double").coalesce(1)
    params = forest.BASELINE | {"n_estimators": 4, "max_depth": 4}
    one, two = (forest.train_forest(df, ["x", "y"], "label", params) for _ in range(2))
    assert [tuple(r) for r in forest.feature_importance(one, df).collect()] == [tuple(r) for r in forest.feature_importance(two, df).collect()]
    one.write().overwrite().save(str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    assert sorted(map(tuple, forest.evaluate_forest(again, df, "label").collect())) == sorted(map(tuple, forest.evaluate_forest(one, df, "label").collect()))
    assert forest.model_features(again) == ["x", "y"]
    for pieces in (2, 4, 8):
        other = forest.train_forest(df.repartition(pieces), ["x", "y"], "label", params)
        assert [tuple(r) for r in forest.feature_importance(other, df).collect()] == [tuple(r) for r in forest.feature_importance(one, df).collect()]


def test_forest_settings():
    from tallyforge.models.forest import BASELINE, balanced_weights, forest as estimator

    est = estimator(BASELINE | {"min_samples_split": 5})
    assert (est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode(), est.getFeatureSubsetStrategy(), est.getSeed()) == (100, 30, 3, "sqrt", 42)
    assert balanced_weights({0: 30, 1: 10}) == {0: 40 / 60, 1: 40 / 20}


def test_search_space(spark):
    assert (search.grid_size(search.SPACE), search.grid_size(search.BALANCED_SPACE)) == (144, 288)
    points = search.draw_points(spark, search.BALANCED_SPACE, 20)
    assert len({tuple(p.items()) for p in points}) == 20 and points == search.draw_points(spark, search.BALANCED_SPACE, 20)
    assert len(search.draw_points(spark, SPACE, 99)) == 8


def test_csv_scan(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [["a", "b"], ["NA", "  "], ['"x, ""y"""', "1"], ["", "n/a"]])
    rows = [tuple(r) for r in tables.read_delimited(spark, path).collect()]
    assert rows == [(None, "  "), ('x, "y"', "1"), (None, None)]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        tables.csv_files(spark, str(tmp_path / "empty"))
    df = tables.read_delimited(spark, path)
    assert tables.select_required(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError, match="zz"):
        tables.select_required(df, ["zz"])


def test_parquet_scans(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        tables.read_split(spark, folder, [tables.CLEAN_PAIR, tables.ENGINEERED_PAIR])
    with pytest.raises(FileNotFoundError):
        tables.read_profile_table(spark, folder)
    tables.write_tables({"test.parquet": spark.range(3), "train_clean.parquet": spark.range(4)}, folder)
    assert tables.read_profile_table(spark, folder, "cleaned").count() == 4
    assert tables.read_profile_table(spark, folder, "engineered").count() == 3
    kept = tables.read_parquet(spark, f"{folder}/test.parquet", keep=True)
    assert kept.storageLevel.useMemory and not kept.unpersist().storageLevel.useMemory


def test_documents(spark, tmp_path):
    path = str(tmp_path / "deep" / "doc.json")
    row = spark.range(1).select(F.lit(None).cast("int").alias("none"), F.create_map(F.lit(1), F.array(F.lit(2.5))).alias("m"))
    documents.write_document(row, path)
    assert read_json(tmp_path / "deep" / "doc.json") == {"none": None, "m": {"1": [2.5]}}
    assert documents.read_document(spark, path, "m map<string,array<double>>").first()["m"] == {"1": [2.5]}
    for reader in (documents.read_document, documents.read_document_text):
        with pytest.raises(FileNotFoundError):
            reader(spark, str(tmp_path / "no.json"))


def test_a_search_goes_on_from_its_ledger(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 3), int(i % 10 > 4)) for i in range(120)], "k int, x double, y double, c int")
    settings = {
        "n_iter": 3, "folds": 2, "key": ["k"], "partitions": 2, "parallelism": 1,
        "space": {"n_estimators": [2, 3], "max_depth": [2, 3], "min_samples_split": [2], "max_features": ["sqrt"], "class_weight": [None, "balanced"]},
    }
    fits, real = [], search._score_fold

    def stops(data, params, trial, fold, seed, max_bins):
        fits.append((trial, fold))
        if len(fits) == 4:
            raise RuntimeError("lost")
        return real(data, params, trial, fold, seed, max_bins)

    whole = search.random_search(df, ["x", "y"], "c", **settings)
    monkeypatch.setattr(search, "_score_fold", stops)
    ledger = str(tmp_path / "ledger")
    with pytest.raises(RuntimeError, match="lost"):
        search.random_search(df, ["x", "y"], "c", ledger=ledger, **settings)
    kept = set(fits[:3])
    resumed = search.random_search(df, ["x", "y"], "c", ledger=ledger, **settings)
    assert not kept & set(fits[4:]) and len(fits) == 4 + 3
    scores = lambda found: [(r["trial"], r["mean_test_score"], r["rank"]) for r in found.trials.orderBy("trial").collect()]
    assert scores(resumed) == scores(whole) and resumed.best_params == whole.best_params
    search.random_search(df, ["x", "y"], "c", ledger=ledger, **settings)
    assert len(fits) == 7  # nothing is left to do
    search.random_search(df.filter("k > 0"), ["x", "y"], "c", ledger=ledger, **settings)
    assert len(fits) == 13  # other rows are another run


def test_a_rejected_batch_is_accounted_for(spark, world, tmp_path):
    rows = spark.createDataFrame([("1", "2"), ("x", "2"), (None, ""), ("3", "4")], "a string, b string")
    spec = SKY_OBJECTS.with_(numeric=("a", "b"))
    assert scoring.reject_account(rows, spec).first().asDict() == {"rows": 4, "rows_at_fault": 2, "cells": {"a": 2, "b": 1}}
    model = forest.train_forest(spark.createDataFrame([(float(i), 0.0, i % 2) for i in range(8)], "a double, b double, c int"), ["a", "b"], "c", forest.BASELINE | {"n_estimators": 2}, partitions=2)
    with pytest.raises(scoring.BatchRejected, match=r"2 of 4 rows cannot be scored \(a: 2, b: 1\)"):
        scoring.write_scored(rows, model, spec, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    account = scoring.write_scored(rows.filter("a in ('1', '3')"), model, spec, str(tmp_path / "out"))
    assert account == {"rows": 2, "rows_at_fault": 0, "cells": {"a": 0, "b": 0}}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    with pytest.raises(Exception, match="missing or no number: a"):
        scoring.score(rows, model, spec).collect()
