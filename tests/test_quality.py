import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tallyforge import SKY_OBJECTS
from tallyforge.functions.labels import decode_label, invert_labels
from tallyforge.functions.parsing import display_text, integer_or_zero, number_or_zero, strict_double, tidy_label
from tallyforge.operators import quality as q
from tests.conftest import plan_of

COLUMNS = ["alpha", "delta", "u", "g", "r", "i", "z", "redshift", "class"]


def dirty(spark, changes):
    """One row per entry: cells that differ from a valid row."""
    rows = [tuple({**dict.fromkeys(COLUMNS, "1.5"), "class": "GALAXY", **c}[n] for n in COLUMNS) for c in changes]
    return q.read_missing_tokens(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS)))


@pytest.fixture(scope="module")
def table(spark):
    return dirty(spark, [
        {}, {"class": " star "}, {"u": "NA"}, {"g": "abc", "class": "QSO"}, {"g": "1.0d", "class": "QSO"}, {"class": ""},
        {"class": "  "}, {"class": "NEBULA"}, {"u": "", "class": "NEBULA"}, {"z": "inf", "class": "QSO"},
        {"u": "", "r": "bad"}, {"class": "QSO"},
    ])


def test_accounts(table):
    flagged = q.flag_rows(table, SKY_OBJECTS)
    row = q.quality_report(flagged, SKY_OBJECTS, table.columns).first()
    assert (row["rows_initial"], row["rows_removed_missing"], row["rows_removed_malformed"], row["rows_removed_total"]) == (12, 4, 5, 8)
    assert row["rows_after_cleaning"] == 4
    assert row["removal_pct"] == pytest.approx(66.6667, abs=1e-3)
    assert row["missing_by_column"] == {"u": 3, "class": 1}
    assert row["malformed_by_column"] == {c: {"g": 2, "r": 1}.get(c, 0) for c in SKY_OBJECTS.numeric}
    assert [r["label"] for r in q.unknown_labels(flagged).collect()] == ["", "NEBULA"]


def test_raw_labels(table):
    counts = {r["label"]: r["rows"] for r in q.raw_label_counts(table, "class").collect()}
    assert counts == {"": 1, "GALAXY": 3, "NAN": 1, "NEBULA": 2, "QSO": 4, "STAR": 1}


def test_clean_rows(table):
    clean = q.clean_rows(table, SKY_OBJECTS)
    assert clean.columns == COLUMNS
    assert dict(clean.dtypes) == {**{c: "double" for c in SKY_OBJECTS.numeric}, "class": "bigint"}
    assert sorted(r["class"] for r in clean.collect()) == [0, 1, 2, 2]
    assert clean.filter(F.col("z") == float("inf")).count() == 1
    assert "Python" not in plan_of(clean)


def test_nan_in_a_number_column_is_missing(spark):
    df = dirty(spark, [{}, {}]).select(*[F.col(c).cast("double") for c in COLUMNS[:-1]], "class")
    df = df.withColumn("u", F.lit(float("nan")))
    row = q.quality_report(q.flag_rows(df, SKY_OBJECTS), SKY_OBJECTS, df.columns).first()
    assert (row["rows_removed_missing"], row["rows_removed_malformed"]) == (2, 0)


def test_empty_table(spark):
    row = q.quality_report(q.flag_rows(dirty(spark, [{}]).limit(0), SKY_OBJECTS), SKY_OBJECTS, COLUMNS).first()
    assert (row["rows_initial"], row["rows_removed_total"], row["removal_pct"]) == (0, 0, 0.0)


def test_column_contract(spark):
    df = dirty(spark, [{}])
    q.check_columns(df, SKY_OBJECTS)
    with pytest.raises(ValueError, match=r"\['alpha', 'u'\]"):
        q.check_columns(df.drop("u", "alpha"), SKY_OBJECTS)
    with pytest.raises(ValueError, match="case"):
        q.check_columns(df.toDF(*COLUMNS[:-1], "class").select("*", F.lit(1).alias("Z")), SKY_OBJECTS)
    ids = df.withColumns({"MJD": F.lit(1), "obj_ID": F.lit(2)})
    kept, dropped = q.drop_id_columns(ids, SKY_OBJECTS)
    assert kept.columns == COLUMNS and dropped == ["obj_ID", "MJD"]
    assert q.feature_columns(df, "class") == COLUMNS[:-1]
    with pytest.raises(ValueError):
        q.feature_columns(df, "label")
    with pytest.raises(ValueError):
        q.feature_columns(df.select("class"), "class")


def test_extra_columns(spark):
    df = spark.createDataFrame([("1", "x", None), (" 2.5 ", "3", "4")], "a string, b string, c string")
    settled = q.settle_readings(q.with_readings(df, ["a", "b", "c"]), ["a", "b", "c"])
    assert settled.columns == df.columns and [c for c in ("a", "b", "c") if dict(settled.dtypes)[c] == "double"] == ["a", "c"]
    assert q.settle_readings(q.with_readings(df, []), []) is df


@pytest.mark.parametrize(("text", "value"), [
    ("1", 1.0), (" -2.5e3\t", -2500.0), (".5", 0.5), ("5.", 5.0), ("+INF", math.inf), ("-infinity", -math.inf), ("nan", None),
    ("1.0d", None), ("1f", None), ("0x1p3", None), ("1e400", None), ("1_000", None), ("", None), ("--1", None), ("1e", None), (None, None),
])
def test_strict_double(spark, text, value):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(strict_double(F.col("s"), StringType())).first()[0] == value


def test_labels_and_display(spark):
    cases = {"\tStar\n": "STAR", " qso ": "QSO", "\x1cgalaxy\x1f": "GALAXY", "a b": "A B", " ": ""}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "s string, want string")
    assert df.filter(~tidy_label(F.col("s")).eqNullSafe(F.col("want"))).count() == 0
    one = spark.range(1)
    names = invert_labels({"A": "0", "B": "x"}, {"Z": 9})
    assert names == {0: "A"} and invert_labels({"B": None}, {"Z": 9}) == {9: "Z"}
    assert one.select(decode_label(F.lit(0), names), decode_label(F.lit(5), names)).first()[:] == ("A", "5")
    row = one.select(number_or_zero(F.lit("2.5")), number_or_zero(F.lit("x")), integer_or_zero(F.lit("3.7")), integer_or_zero(F.lit(" 4 "))).first()
    assert row[:] == (2.5, 0.0, 0, 4)
    df = spark.createDataFrame([(-3.7,), (float("nan"),), (1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(integer_or_zero(F.col("x"), DoubleType())).collect()] == [-3, 0, 0, 0]
    df = spark.createDataFrame([(1.5, None)], "x double, s string")
    assert df.select(display_text(F.col("x"), DoubleType()), display_text(F.col("s"), StringType())).first()[:] == (1.5, "")
