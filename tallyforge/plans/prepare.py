"""Raw delimited table to clean and engineered train and test tables, and a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.ordering import row_text
from tallyforge.operators.features import added_columns, engineer
from tallyforge.operators.quality import (
    check_columns, drop_id_columns, feature_columns, flag_rows, keep_clean, quality_report, settle_readings, with_readings,
)
from tallyforge.operators.reports import preparation_report
from tallyforge.operators.stratify import mark_split
from tallyforge.sources.documents import read_document, write_document
from tallyforge.sources.tables import CLEAN_PAIR, ENGINEERED_PAIR, read_folder, write_parquet
from tallyforge.spec import SKY_OBJECTS, TableSpec

REPORT = "preprocessing_report.json"
STAGED, SPLIT, ROW = "_staged.parquet", "_split.parquet", "_row"


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def prepare_table(
    raw: DataFrame, output: str, spec: TableSpec = SKY_OBJECTS, source: str = "", key: Sequence[str] | None = None
) -> DataFrame:
    """Clean, split, derive and write; returns the report as it is read back, which is written last of all.

    The parsed table is written once, so the text is parsed once and every later pass reads only
    the columns it needs.
    """
    spark = raw.sparkSession
    check_columns(raw, spec)
    table, dropped = drop_id_columns(raw, spec)
    staged_path, split_path = f"{output}/{STAGED}", f"{output}/{SPLIT}"
    if not key:
        # One hash of the whole raw row, so that the passes of the split read a single column.
        raw, key = raw.withColumn(ROW, F.md5(row_text(raw))), [ROW]
    # The key is needed until the split, id columns included.
    carried = [c for c in key if c in dropped or c == ROW]
    texts = raw.drop(*[c for c in dropped if c not in carried])
    extras = [c for c in texts.columns if c not in spec.required and c not in carried]
    # Both readings of an extra column are staged, so that the choice between them needs no second parse.
    write_parquet(with_readings(flag_rows(texts, spec), extras), staged_path)
    staged = settle_readings(spark.read.parquet(staged_path), extras)

    clean = keep_clean(staged, spec)
    write_parquet(mark_split(clean, spec.target, spec.test_share, spec.seed, key), split_path)
    marked = spark.read.parquet(split_path).drop(*carried)

    clean_features = feature_columns(marked.drop("is_test"), spec.target)
    engineered = engineer(marked, spec)
    for pair, df in ((CLEAN_PAIR, marked), (ENGINEERED_PAIR, engineered)):
        write_parquet(df.filter("NOT is_test").drop("is_test"), f"{output}/{pair[0]}")
        write_parquet(df.filter("is_test").drop("is_test"), f"{output}/{pair[1]}")

    report = preparation_report(
        quality_report(staged, spec, table.columns),
        marked,
        spec,
        source=source,
        dropped=dropped,
        clean_features=clean_features,
        added=added_columns(marked, engineered),
        files={
            "clean_train_parquet": CLEAN_PAIR[0], "clean_test_parquet": CLEAN_PAIR[1],
            "engineered_train_parquet": ENGINEERED_PAIR[0], "engineered_test_parquet": ENGINEERED_PAIR[1],
        },
    )
    schema = report.schema
    write_document(report, f"{output}/{REPORT}")
    for path in (staged_path, split_path):
        _remove(spark, path)
    return read_document(spark, f"{output}/{REPORT}", schema)


def prepare(
    spark: SparkSession, folder: str, output: str, spec: TableSpec = SKY_OBJECTS, first_only: bool = False,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """``prepare_table`` on the CSV of a folder."""
    raw, files = read_folder(spark, folder, first_only)
    return prepare_table(raw, output, spec, files[0].rsplit("/", 1)[-1], key)
