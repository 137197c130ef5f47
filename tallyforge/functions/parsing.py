"""Text to typed values, with one meaning of missing: NULL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, NumericType, StringType

from tallyforge.spec import MISSING_TOKENS

# Decimal numbers, inf and nan; leaves out the suffixes and hex forms that only the JVM reads.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
# Blanks at either end, Unicode ones and the ASCII separators included.
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def select_once(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Select of costly columns that are worked out once per row.

    A filter on top of a plain select is pushed below it and repeats the expressions it refers
    to; ``inline`` of a single struct yields columns that are only referred to.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def null_if_token(text: Column, tokens: tuple[str, ...] = MISSING_TOKENS) -> Column:
    """NULL where the untrimmed text is one of the missing tokens."""
    return F.when(~text.isin(*tokens), text)


def is_missing(column: Column, dtype: DataType) -> Column:
    """NULL, or NaN in a floating column."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def strict_double(column: Column, dtype: DataType | None = None) -> Column:
    """Double value of a cell, NULL when it is no plain number (NaN counts as none)."""
    if dtype is not None and isinstance(dtype, NumericType):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    text = column.cast("string")
    value = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    overflow = F.abs(value) == F.lit(float("inf"))
    return F.when(text.rlike(NUMBER_TEXT) & ~(overflow & text.rlike(r"\d")), value)


def strict_long(text: Column) -> Column:
    """Integer value of a text, NULL when it has a fraction or is no number."""
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("bigint"))


def tidy_label(column: Column) -> Column:
    """Label text without blanks at the ends, in upper case."""
    return F.upper(F.regexp_replace(column.cast("string"), EDGE_BLANKS, ""))


def number_or_zero(column: Column) -> Column:
    """Numeric reading for display, 0.0 when there is none."""
    return F.coalesce(strict_double(column), F.lit(0.0))


def integer_or_zero(column: Column, dtype: DataType | None = None) -> Column:
    """Integer reading for display: a number loses its fraction, a text with one counts as 0."""
    if isinstance(dtype, NumericType):
        return F.coalesce(column.try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(strict_long(column.cast("string")), F.lit(0).cast("bigint"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _by_kind(value: Column, kind: str, of_text: Callable[[Column], Column]) -> Column:
    is_text = lambda v: F.schema_of_variant(v) == "STRING"
    return bound(value, lambda v: F.when(is_text(v), of_text(F.try_variant_get(v, "$", "string"))).otherwise(F.try_variant_get(v, "$", kind)))


def json_number(value: Column) -> Column:
    """Double of a parsed JSON value: a number, a boolean (0 or 1) or the text of a number, else NULL."""
    return _by_kind(value, "double", strict_double)


def json_integer(value: Column) -> Column:
    """Integer of a parsed JSON value: a number without its fraction, a boolean, or the text of an integer, else NULL."""
    return _by_kind(value, "bigint", strict_long)


def display_text(column: Column, dtype: DataType) -> Column:
    """Non-numeric column as text with NULL as the empty string; numbers stay."""
    if isinstance(dtype, NumericType):
        return column
    if isinstance(dtype, StringType):
        return F.coalesce(column, F.lit(""))
    return F.coalesce(column.cast("string"), F.lit(""))
