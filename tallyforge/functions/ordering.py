"""A repeatable pseudo-random order that depends on row content and a seed only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Text of the given columns (all by default) that keeps NULLs and borders apart."""
    fields = [df.schema[name] for name in (columns or df.columns)]
    if columns and all(isinstance(f.dataType, IntegralType) for f in fields):
        parts = [F.coalesce(df[f.name].cast("string"), F.lit("~")) for f in fields]
        return F.concat_ws("|", *parts)
    return F.to_json(F.struct(*[df[f.name] for f in fields]), {"ignoreNullFields": "false"})


def order_hash(df: DataFrame, key: Sequence[str] | None, seed: int) -> Column:
    """``md5(seed|key)`` as 32 hex digits; its order is the order of the shuffled rows."""
    return F.md5(F.concat(F.lit(f"{seed}|"), row_text(df, key)))
