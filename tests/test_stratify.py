import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import ranks
from tallyforge.operators import stratify as s
from tests.conftest import plan_of


def classes(spark, sizes):
    rows = [(c, f"{c}-{i}") for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "c int, k string").repartition(3)


def tally(df, *columns):
    return dict(collections.Counter(tuple(r[c] for c in columns) for r in df.collect()))


def test_split_sizes(spark):
    df = classes(spark, {0: 1, 1: 2, 2: 5, 3: 10})
    train, test = s.stratified_split(df, "c", 0.2, key=["k"])
    assert tally(train, "c") == {(1,): 1, (2,): 4, (3,): 8}
    assert tally(test, "c") == {(0,): 1, (1,): 1, (2,): 1, (3,): 2}
    assert s.split_faults(df, train, test, ["k"]).isEmpty()
    assert not s.split_faults(df, train, train, ["k"]).isEmpty()
    assert train.columns == ["c", "k"]


@pytest.mark.parametrize("share", [0, 1, -0.1])
def test_split_share_must_be_inside(spark, share):
    with pytest.raises(ValueError):
        s.stratified_split(classes(spark, {0: 2}), "c", share)


def test_split_is_the_plain_ranking(spark):
    """Same rows as a full sort per class, and the same again in other partitions."""
    df = classes(spark, {0: 700, 1: 90, 2: 13})
    marked = s.mark_split(df, "c", 0.3, seed=7, key=["k"])
    order = {r["k"]: r["h"] for r in df.select("k", F.md5(F.concat(F.lit("7|"), F.to_json(F.struct("k")))).alias("h")).collect()}
    for c, n in {0: 700, 1: 90, 2: 13}.items():
        rows = sorted((r for r in marked.collect() if r["c"] == c), key=lambda r: order[r["k"]])
        cut = int(n * 0.7)
        assert [r["is_test"] for r in rows] == [False] * cut + [True] * (n - cut)
    again = s.mark_split(df.repartition(7), "c", 0.3, seed=7, key=["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, marked.collect()))
    other = s.mark_split(df, "c", 0.3, seed=8, key=["k"])
    assert sorted(map(tuple, other.collect())) != sorted(map(tuple, marked.collect()))


def test_default_key_keeps_nulls_and_borders_apart(spark):
    df = spark.createDataFrame([(0, "a", None), (0, None, "a"), (0, "a|", "b"), (0, "a", "|b")], "c int, x string, y string")
    train, test = s.stratified_split(df, "c", 0.5)
    assert train.count() == test.count() == 2
    assert train.unionByName(test).distinct().count() == 4


def test_equal_keys_with_different_rows(spark):
    """A third of the rows share one key; the split stays exact and repeatable."""
    df = spark.range(3000).select(F.lit(1).alias("c"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    for seed in range(4):
        train, test = s.stratified_split(df, "c", 0.25, seed, key=["k"])
        assert (train.count(), test.count()) == (2250, 750)
        assert train.unionByName(test).select("id").distinct().count() == 3000


def test_identical_rows_are_split_by_count(spark, monkeypatch):
    monkeypatch.setattr(ranks, "COPIES_PER_CHUNK", 7)
    rare = spark.range(20).select((F.col("id") % 2).cast("int").alias("c"), F.col("id").cast("string").alias("k"))
    same = spark.range(1000).select((F.col("id") % 2).cast("int").alias("c"), F.lit("same").alias("k"))
    df = rare.unionByName(same)
    train, test = s.stratified_split(df, "c", 0.2)
    assert tally(train, "c") == {(0,): 408, (1,): 408} and tally(test, "c") == {(0,): 102, (1,): 102}
    assert tally(train.unionByName(test), "c", "k") == tally(df, "c", "k")
    folds = s.stratified_folds(df, "c", 4)
    assert sorted(tally(folds, "c", "fold").values()) == [127, 127, 127, 127, 128, 128, 128, 128]
    assert tally(folds.drop("fold"), "c", "k") == tally(df, "c", "k")
    assert s.seeded_sample(df, 321).count() == 321


def test_rows_without_a_class_are_left_out(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (None, 3)], "c int, k int")
    assert s.mark_split(df, "c", key=["k"]).count() == 2


def test_empty_table(spark):
    df = classes(spark, {0: 1}).limit(0)
    train, test = s.stratified_split(df, "c", key=["k"])
    assert train.count() == test.count() == 0
    assert s.seeded_sample(df, 5).count() == 0


def test_folds(spark):
    folds = tally(s.stratified_folds(classes(spark, {0: 7, 1: 4}), "c", 3, key=["k"]), "c", "fold")
    per_class = {c: sorted((n for (k, _), n in folds.items() if k == c), reverse=True) for c in (0, 1)}
    assert per_class == {0: [3, 2, 2], 1: [2, 1, 1]}
    total = collections.Counter()
    for (_, fold), n in folds.items():
        total[fold] += n
    assert sorted(total.values()) == [3, 4, 4]
    with pytest.raises(ValueError):
        s.stratified_folds(classes(spark, {0: 3}), "c", 1)


@pytest.mark.parametrize(("sizes", "cap", "kept"), [
    ([10, 5, 5], 10, [5, 2, 2]), ([15, 15, 10], 4, [1, 2, 1]), ([1, 1, 1], 2, [1, 1, 1]), ([4, 3, 2], 0, [4, 3, 2]), ([4, 3, 2], 9, [4, 3, 2]),
])
def test_cap(spark, sizes, cap, kept):
    df = classes(spark, dict(enumerate(sizes)))
    assert tally(s.stratified_cap(df, "c", cap, key=["k"]), "c") == {(c,): n for c, n in enumerate(kept)}
    table = spark.createDataFrame(list(enumerate(sizes)), "c int, n bigint")
    assert [r["keep"] for r in s.cap_sizes(table, "c", cap).orderBy("c").collect()] == kept


def test_cap_equals_the_step_by_step_trim(spark):
    import random

    import numpy as np

    random.seed(3)
    for _ in range(6):
        sizes = [random.randint(1, 60) for _ in range(random.randint(1, 7))]
        cap = random.randint(1, sum(sizes))
        want = [max(1, int(np.round(n / sum(sizes) * cap))) for n in sizes]
        while sum(want) > cap and any(w > 1 for w in want):
            want[next(i for i, w in enumerate(want) if w > 1)] -= 1
        if sum(sizes) <= cap:
            want = sizes
        table = spark.createDataFrame(list(enumerate(sizes)), "c int, n bigint")
        got = [r["keep"] for r in s.cap_sizes(table, "c", cap).orderBy("c").collect()]
        assert got == [min(n, w) for n, w in zip(sizes, want)]


def test_samples(spark):
    df = classes(spark, {0: 300, 1: 200})
    sample = s.seeded_sample(df, 123, key=["k"])
    assert sample.count() == sample.distinct().count() == 123
    assert s.seeded_sample(df, 1000, key=["k"]).count() == 500
    assert s.seeded_sample(df, 0, key=["k"]).count() == 0
    shuffled = s.seeded_shuffle(df, key=["k"])
    assert sorted(map(tuple, shuffled.drop("position").collect())) == sorted(map(tuple, df.collect()))
    order = [r["k"] for r in shuffled.orderBy("position").collect()]
    assert order == sorted(order, key=lambda k: hashlib.md5(f'42|{{"k":"{k}"}}'.encode()).hexdigest())
    assert [r["position"] for r in shuffled.orderBy("position").collect()] == list(range(1, 501))
    twice = s.seeded_shuffle(df.unionByName(df), key=["k"])
    assert [r["position"] for r in twice.orderBy("position").collect()] == list(range(1, 1001))
    other = df.withColumn("more", F.length("k"))
    assert s.paired_rows(sample, other, ["k"]).count() == 123


def test_many_groups_are_joined_by_shuffle(spark):
    """Beyond the broadcast threshold the small tables are joined by shuffle, with the same result."""
    df = classes(spark, {c: 5 for c in range(6)})
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train, test = s.stratified_split(df, "c", 0.2, key=["k"])
        assert set(tally(train, "c").values()) == {4} and set(tally(test, "c").values()) == {1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_no_window_over_rows_and_no_python(spark):
    plan = plan_of(s.mark_split(classes(spark, {0: 50, 1: 9}), "c", key=["k"]))
    assert "Window" not in plan and "Python" not in plan and "SortMergeJoin" not in plan


def test_one_plan_caps_two_tables(spark):
    df = classes(spark, {0: 300, 1: 200})
    target = [c for c in df.columns if c != "k"][0]
    other = df.withColumn("more", F.upper("k"))
    chosen, pair = s.paired_cap(df, other, target, 100, key=["k"])
    assert {r["k"] for r in chosen.collect()} == {r["k"] for r in pair.collect()} == {r["k"] for r in s.stratified_cap(df, target, 100, key=["k"]).collect()}
    assert "Exchange hashpartitioning" not in plan_of(pair) and "BroadcastHashJoin" in plan_of(pair)
    same = df.withColumn("k", F.lit("one"))
    chosen, pair = s.paired_cap(same, same.withColumn("more", F.lit(1)), target, 100, key=["k"])
    assert chosen.count() == 100 and pair.count() == 500  # rows that share their key cannot be told apart by it
