import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge import SKY_OBJECTS
from tallyforge.operators import features, profiling, quantiles


def test_derived_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 6.0, 0.5)], "u double, g double, r double, i double, z double, redshift double")
    full = features.engineer(df, SKY_OBJECTS)
    row = full.first()
    added = features.added_columns(df, full)
    assert len(added) == 19 and added[9:14] == ["band_mean", "band_std", "band_min", "band_max", "band_range"]
    assert [row[c] for c in added[:9]] == [-1, -1, -1, -2, -2, -2, -4, -3, -5]
    assert row["band_mean"] == pytest.approx(3.2) and row["band_std"] == pytest.approx(1.923538, abs=1e-6)
    assert (row["band_min"], row["band_max"], row["band_range"]) == (1, 6, 5)
    assert [row[c] for c in added[14:]] == [-0.5, -0.5, -0.5, -1.0, -2.0]
    part = features.added_columns(df, features.engineer(df.drop("z"), SKY_OBJECTS))
    assert not [c for c in part if "z" in c.split("_") or c.startswith("band")] and len(part) == 8


def test_row_statistics_skip_nulls(spark):
    rows = [(1.0, None, 3.0, None, None), (None,) * 5, (2.0, None, None, None, None)]
    df = spark.createDataFrame(rows, "u double, g double, r double, i double, z double")
    got = features.add_band_statistics(df, SKY_OBJECTS).select("band_mean", "band_std", "band_min", "band_max", "band_range").collect()
    assert got[0][:] == (2.0, pytest.approx(math.sqrt(2)), 1.0, 3.0, 2.0)
    assert got[1][:] == (None,) * 5
    assert got[2][:] == (2.0, None, 2.0, 2.0, 0.0)


def test_skew(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"a": rng.gamma(1.0, size=500), "flat": 3.0, "b": rng.normal(size=500)})
    df = spark.createDataFrame(data).withColumn("broken", F.lit(float("inf"))).withColumn("none", F.lit(None).cast("double"))
    got = {r["feature"]: (r["skewness"], r["high"]) for r in profiling.skew_report(df, df.columns).collect()}
    assert set(got) == {"a", "b", "flat"} and got["flat"] == (0.0, False)
    for c in "ab":
        assert got[c][0] == pytest.approx(data[c].skew(), rel=1e-9)
    assert got["a"][1] and not got["b"][1]
    assert profiling.skew_report(df.limit(2), ["a"]).isEmpty()


def test_classes_and_imbalance(spark):
    df = spark.createDataFrame([(0,)] * 10 + [(1,)] * 21 + [(None,)], "c int")
    counts = profiling.class_distribution(df, "c")
    assert [tuple(r) for r in counts.collect()] == [(0, 10), (1, 21)]
    assert sum(r["share"] for r in profiling.class_shares(df, "c").collect()) == pytest.approx(1)
    row = profiling.imbalance(counts, "c", 0).first()
    assert row["minority_share"] == pytest.approx(10 / 31) and row["majority_to_minority_ratio"] == pytest.approx(2.1)
    assert row["recommendation"] == "use_class_weight_balanced"
    even = spark.createDataFrame([(0, 10), (1, 20)], "c int, rows bigint")
    assert profiling.imbalance(even, "c", 0).first()["recommendation"] == "class_weight_not_required"
    assert tuple(profiling.imbalance(even.limit(0), "c", 0).first()) == (0.0, 0.0, "class_weight_not_required")


def test_correlation(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    data.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(data).withColumn("flat", F.lit(1.0))
    got = {(r["feature_x"], r["feature_y"]): r["correlation"] for r in profiling.correlation_matrix(df, ["a", "b", "c", "flat"]).collect()}
    want = data.corr()
    assert len(got) == 16 and got["flat", "a"] is None and got["flat", "flat"] is None
    for x in "abc":
        for y in "abc":
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-12)
    with pytest.raises(ValueError):
        profiling.correlation_matrix(df, ["a"])
    wide = pd.DataFrame(rng.normal(loc=1e6, size=(500, 27)), columns=[f"x{i}" for i in range(27)])
    wide = wide.mask(rng.random((500, 27)) < 0.2)
    wide.loc[3, "x0"] = np.inf
    rows = profiling.correlation_matrix(spark.createDataFrame(wide), list(wide.columns))
    found = {(r["feature_x"], r["feature_y"]): r["correlation"] for r in rows.collect()}
    want = wide.corr()
    assert len(found) == 27 * 27
    for (x, y), value in found.items():
        if "x0" in (x, y):
            assert value is None or np.isnan(wide[y if x == "x0" else x][3])
        else:
            assert value == pytest.approx(want.loc[x, y], abs=1e-9)
    assert profiling.correlation_matrix(df.filter("false"), ["a", "b"]).filter("correlation is not null").count() == 0


def test_histogram(spark):
    df = spark.createDataFrame([(float(x), 5.0, None) for x in range(81)] + [(float("inf"), 5.0, None)], "a double, flat double, none double")
    bins = profiling.histogram(df, ["a", "flat", "none"]).collect()
    a = sorted((r["bin"], r["rows"]) for r in bins if r["feature"] == "a")
    assert len(a) == 40 and sum(n for _, n in a) == 81 and a[-1] == (40, 3)
    assert [(r["bin"], r["rows"]) for r in bins if r["feature"] == "flat"] == [(1, 82)]


def test_density(spark):
    rng = np.random.default_rng(3)
    values = {0: rng.normal(size=50), 1: np.full(5, 2.0), 2: np.array([1.0])}
    df = spark.createDataFrame([(c, float(v)) for c, vs in values.items() for v in vs], "c int, x double")
    rows = profiling.density_curves(df, ["x"], "c").orderBy("point").collect()
    assert {r["c"] for r in rows} == {0} and len(rows) == 90
    v = values[0]
    h = 1.06 * v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 90)
    want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r["density"] for r in rows], want, rtol=1e-12, atol=1e-14) and np.allclose([r["x"] for r in rows], grid)


def test_density_of_outliers(spark):
    values = np.concatenate([np.random.default_rng(4).normal(size=2000), [1e4, -500.0]])
    rows = profiling.density_curves(spark.createDataFrame([(0, float(v)) for v in values], "c int, x double"), ["x"], "c", points=400).orderBy("point").collect()
    h = 1.06 * values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 400)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert len(rows) == 400 and np.allclose([r["density"] for r in rows], want, rtol=1e-11, atol=1e-15)


def test_pairs_and_names(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, 3.0), (1, None, 5.0, 6.0)], "c int, a double, b double, d double")
    points = profiling.pair_points(df, ["a", "b", "d"], "c").collect()
    assert sorted((r["feature_x"], r["x"], r["feature_y"], r["y"]) for r in points) == [("a", 1.0, "b", 2.0), ("a", 1.0, "d", 3.0), ("b", 2.0, "d", 3.0)]
    assert [r["label"] for r in profiling.named_class_counts(df, "c", {0: "A"}).collect()] == ["A", "1"]


@pytest.mark.parametrize("bins", [4, 4096])
def test_exact_quantiles(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(4)
    groups = {
        "normal": rng.normal(size=501), "heavy": np.where(rng.random(300) < 0.4, 7.0, rng.exponential(size=300) ** 6),
        "flat": np.full(9, -1.0), "one": np.array([4.0]), "two": np.array([1.0, 2.0]), "wide": np.array([-1.7e308, 0.0, 1e-300, 1.7e308, 1.7e308]),
    }
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, value double")
    fractions = [0.0, 0.25, 0.5, 0.9, 1.0]
    for row in quantiles.exact_quantiles(df, ["g"], fractions).collect():
        values = np.sort(groups[row["g"]])
        assert row["n"] == len(values)
        for j, q in enumerate(fractions):
            h = (len(values) - 1) * q
            low, high = values[math.floor(h)], values[min(math.floor(h) + 1, len(values) - 1)]
            want = low if h == math.floor(h) else low + (high - low) * (h - math.floor(h))
            got = row[f"q{j}"]
            assert (got is None and not math.isfinite(want)) or got == pytest.approx(want, rel=1e-12)


def test_large_groups_are_bracketed(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH", 64)
    monkeypatch.setattr(quantiles, "REACH", 0.02)
    rng = np.random.default_rng(6)
    groups = {"normal": rng.normal(size=5000), "ties": rng.integers(0, 7, 4000).astype(float), "hot": np.where(rng.random(3000) < 0.6, 5.0, rng.normal(size=3000))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, value double")
    for reach in (0.02, 1e-6):  # the second is missed at first and widened
        monkeypatch.setattr(quantiles, "REACH", reach)
        for row in quantiles.exact_quantiles(df, ["g"], [0.5, 0.1, 0.99]).collect():
            assert [row[f"q{i}"] for i in range(3)] == pytest.approx(list(np.quantile(groups[row["g"]], [0.5, 0.1, 0.99])), rel=1e-12)


def test_order_statistics_with_infinities(spark):
    values = [float("-inf")] * 3 + [0.0, 1.0, 2.0] + [float("inf")] * 4
    df = spark.createDataFrame([("g", v) for v in values], "g string, value double")
    got = quantiles.exact_quantiles(df, ["g"], [i / 9 for i in (0, 2, 3, 5, 6, 9)]).first()
    assert [got[f"q{j}"] for j in (0, 5)] == [float("-inf"), float("inf")]


def test_box_summary(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None)], "c string, x double")
    row = quantiles.box_summary(df, ["x"], "c").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["lower_whisker"], row["upper_whisker"], row["outliers"], row["n"]) == (1.0, 5.0, 1, 6)
    assert [tuple(r) for r in quantiles.box_outliers(df, ["x"], "c").collect()] == [("x", "a", 100.0)]
