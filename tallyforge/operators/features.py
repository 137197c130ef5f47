"""Derived columns: differences, row statistics, products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallyforge.functions.moments import nan_to_null, row_statistics
from tallyforge.spec import TableSpec


def difference_name(left: str, right: str) -> str:
    return f"color_{left}_{right}"


def add_differences(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``left - right`` for each pair whose two columns exist."""
    have = set(df.columns)
    pairs = [(a, b) for a, b in spec.differences if {a, b} <= have]
    return df.select("*", *[nan_to_null(F.col(a) - F.col(b)).alias(difference_name(a, b)) for a, b in pairs])


def add_band_statistics(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Row-wise statistics over the bands, only when all of them exist."""
    if not spec.bands or not set(spec.bands) <= set(df.columns):
        return df
    stats = row_statistics([F.col(name) for name in spec.bands])
    return df.select("*", *[value.alias(f"band_{name}") for name, value in stats.items()])


def add_products(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The factor times chosen differences, where both exist."""
    have = set(df.columns)
    names = [difference_name(a, b) for a, b in spec.factor_differences]
    names = [n for n in names if spec.factor in have and n in have]
    return df.select("*", *[nan_to_null(F.col(spec.factor) * F.col(n)).alias(f"{spec.factor}_{n}") for n in names])


def engineer(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All derived columns, in the order differences, statistics, products."""
    return df.transform(add_differences, spec).transform(add_band_statistics, spec).transform(add_products, spec)


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return [name for name in after.columns if name not in set(before.columns)]


def numeric_columns(df: DataFrame, target: str | None = None) -> list[str]:
    """Numeric columns but the target, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != target]


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where all the given columns have a value."""
    return df.dropna(subset=columns)
