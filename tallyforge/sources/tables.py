"""Delimited and parquet tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tallyforge.operators.quality import read_missing_tokens

# Names of the four prepared tables.
CLEAN_PAIR = ("train_clean.parquet", "test_clean.parquet", "cleaned")
ENGINEERED_PAIR = ("train.parquet", "test.parquet", "engineered")


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """CSV files of a folder, sorted by name; only the listing is read."""
    text = spark.read.schema("value string").option("pathGlobFilter", "*.csv").csv(folder)
    files = sorted(unquote(name) for name in text.inputFiles())
    if not files:
        raise FileNotFoundError(f"No CSV file in {folder}")
    return files


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names: the header of the file, with nothing inferred from its rows."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """CSV with a header, every column as text, missing tokens as NULL.

    All files must have the header of the first one. ``multiline`` allows line breaks in quoted
    cells; a file is then read by one task.
    """
    paths = [path] if isinstance(path, str) else list(path)
    options = {"header": True, "escape": '"', "enforceSchema": False, "multiLine": multiline}
    raw = spark.read.schema(text_schema(_header(spark, paths[0]))).options(**options).csv(paths)
    return read_missing_tokens(raw)


def read_folder(spark: SparkSession, folder: str, first_only: bool = False) -> tuple[DataFrame, list[str]]:
    """All CSV files of a folder, and their paths. ``first_only`` takes the alphabetically first one and warns of the others."""
    files = csv_files(spark, folder)
    if first_only and files[1:]:
        warnings.warn(f"{len(files) - 1} files of {folder} are not read: {files[1:6]}", stacklevel=2)
        files = files[:1]
    return read_delimited(spark, files), files


def select_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the given columns, in order; all must exist."""
    lacking = set(columns).difference(df.columns)
    if lacking:
        raise ValueError(f"The table has {df.columns} and lacks {sorted(lacking)}.")
    return df.select(*columns)


def read_parquet(spark: SparkSession, path: str, keep: bool = False) -> DataFrame:
    """Parquet table; ``keep`` caches it until ``unpersist``."""
    df = spark.read.parquet(path)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table, or None when there is nothing at the path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _existing(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Those of the named tables that exist, in the order of the names."""
    tried = {name: read_if_exists(spark, f"{folder}/{name}") for name in names}
    return {name: df for name, df in tried.items() if df is not None}


def read_split(
    spark: SparkSession, folder: str, candidates: Sequence[tuple[str, str, str]]
) -> tuple[DataFrame, DataFrame, tuple[str, str, str]]:
    """First candidate pair of which both tables exist, with its names and variant."""
    there = _existing(spark, folder, [name for pair in candidates for name in pair[:2]])
    whole = [pair for pair in candidates if there.keys() >= set(pair[:2])]
    if not whole:
        raise FileNotFoundError(f"{folder} has no complete split, only {sorted(there)} of the tables looked for.")
    return there[whole[0][0]], there[whole[0][1]], whole[0]


def read_profile_table(spark: SparkSession, folder: str, variant: str = "cleaned") -> DataFrame:
    """Table to profile: the wanted variant before the other one, train before test."""
    pairs = [CLEAN_PAIR, ENGINEERED_PAIR] if variant == "cleaned" else [ENGINEERED_PAIR, CLEAN_PAIR]
    there = _existing(spark, folder, [name for pair in pairs for name in pair[:2]])
    if not there:
        raise FileNotFoundError(f"{folder} has none of the prepared tables.")
    return next(iter(there.values()))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """Write each table under its name and return the paths."""
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}")
    return [f"{folder}/{name}" for name in tables]
