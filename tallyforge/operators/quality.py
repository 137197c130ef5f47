"""Row and column quality: what is missing, malformed or unknown, and the clean table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyforge.functions.labels import encode_label
from tallyforge.functions.parsing import is_missing, null_if_token, select_once, strict_double, tidy_label
from tallyforge.session import spread
from tallyforge.spec import TableSpec

READING = "_reading_"
ROW_FLAGS = MISSING_ROW, MALFORMED_ROW, UNKNOWN_ROW = "_missing", "_malformed", "_unknown"
EMPTY, BAD, LABEL_TEXT = "_empty_", "_bad_", "_label_text"


def check_columns(df: DataFrame, spec: TableSpec) -> None:
    """Raise when a required column is absent or two names differ by case only."""
    lacking = set(spec.required).difference(df.columns)
    if lacking:
        raise ValueError(f"The table lacks {sorted(lacking)}, which its contract names.")
    folded: dict[str, str] = {}
    for name in df.columns:
        other = folded.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"Columns differ by case only: {other!r}, {name!r}")


def drop_id_columns(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """Table without the known id columns, and the names that were there, in list order."""
    dropped = [name for name in spec.id_columns if name in df.columns]
    return df.drop(*dropped), dropped


def check_features(df: DataFrame, spec: TableSpec) -> list[str]:
    """Numeric check columns that the table has."""
    return [name for name in spec.numeric if name in df.columns]


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Every column but the target, in table order; both must exist."""
    if target not in df.columns:
        raise ValueError(f"Target column {target!r} is not in the table.")
    features = [name for name in df.columns if name != target]
    if not features:
        raise ValueError(f"No feature columns besides {target!r}.")
    return features


def read_missing_tokens(df: DataFrame) -> DataFrame:
    """Text columns with the missing tokens turned to NULL."""
    return df.select(
        *[
            null_if_token(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _any(tests: list[Column]) -> Column:
    return reduce(or_, tests, F.lit(False))


def flag_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Coerced table with one flag per reason, and one per column for empty and malformed cells.

    ``_missing`` looks at the cells as they came in; ``_malformed`` at those that stop being a
    value when read as a number, on rows that are not missing; ``_unknown`` at labels outside
    the mapping. A row can be missing and unknown at once.
    """
    df = spread(df)
    fields = {f.name: f.dataType for f in df.schema.fields}
    checks = check_features(df, spec)
    label = tidy_label(F.col(spec.target))
    parsed = select_once(
        df,
        [
            *[strict_double(F.col(n), fields[n]).alias(n) if n in checks else F.col(n) for n in df.columns if n != spec.target],
            encode_label(label, spec.labels).alias(spec.target),
            label.alias(LABEL_TEXT),
            *[is_missing(F.col(n), dtype).alias(EMPTY + n) for n, dtype in fields.items()],
        ],
    )
    bad = {n: F.col(n).isNull() & ~F.col(EMPTY + n) for n in checks}
    missing = _any([F.col(EMPTY + n) for n in [*checks, spec.target]])
    unknown = F.col(LABEL_TEXT).isNotNull() & F.col(spec.target).isNull()
    return parsed.select(
        "*",
        *[test.alias(BAD + n) for n, test in bad.items()],
        missing.alias(MISSING_ROW),
        (_any(list(bad.values())) & ~missing).alias(MALFORMED_ROW),
        unknown.alias(UNKNOWN_ROW),
    )


def keep_clean(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows without a flag: features and the encoded target.

    Those are the rows whose check columns and code are all present, which is the cheaper test.
    """
    kept = [n for n in flagged.columns if not n.startswith((EMPTY, BAD)) and n not in ROW_FLAGS and n != LABEL_TEXT]
    return flagged.dropna(subset=[*check_features(flagged, spec), spec.target]).select(*kept)


def clean_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop the id columns and every flagged row, encode the target."""
    table, _ = drop_id_columns(df, spec)
    return keep_clean(flag_rows(table, spec), spec)


def _count_cells(prefix: str, names: list[str], keep_zero: bool) -> Column:
    """Map from column name to the number of rows flagged for it."""
    if not names:
        return F.create_map().cast("map<string,bigint>")
    counts = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.count_if(prefix + n) for n in names]))
    return counts if keep_zero else F.map_filter(counts, lambda _, n: n > 0)


def dropped() -> Column:
    """Whether a row has any flag."""
    return _any([F.col(flag) for flag in ROW_FLAGS])


def quality_report(flagged: DataFrame, spec: TableSpec, columns: list[str]) -> DataFrame:
    """One row: rows in, rows removed per reason and counts per column, from one aggregate."""
    checks = [name for name in spec.numeric if name in columns]
    rows = F.count(F.lit(1))
    removed = F.count_if(dropped())
    return flagged.agg(
        rows.alias("rows_initial"),
        (rows - removed).alias("rows_after_cleaning"),
        F.count_if(MISSING_ROW).alias("rows_removed_missing"),
        F.count_if(F.col(MALFORMED_ROW) | F.col(UNKNOWN_ROW)).alias("rows_removed_malformed"),
        removed.alias("rows_removed_total"),
        F.coalesce(F.try_divide(removed, rows) * 100, F.lit(0.0)).alias("removal_pct"),
        _count_cells(EMPTY, columns, keep_zero=False).alias("missing_by_column"),
        _count_cells(BAD, checks, keep_zero=True).alias("malformed_by_column"),
    )


def unknown_labels(flagged: DataFrame) -> DataFrame:
    """Distinct labels outside the mapping, sorted, with their rows."""
    return (
        flagged.filter(UNKNOWN_ROW)
        .groupBy(F.col(LABEL_TEXT).alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("label")
    )


def raw_label_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per label before cleaning; a missing one shows as ``NAN``."""
    label = F.coalesce(tidy_label(F.col(target)), F.lit("NAN"))
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("rows")).orderBy("label")


def with_readings(df: DataFrame, columns: list[str]) -> DataFrame:
    """Table with the numeric reading of each of the columns next to it."""
    return df.withColumns({READING + c: strict_double(F.col(c), df.schema[c].dataType) for c in columns}) if columns else df


def settle_readings(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns outside the contract become numbers when every present cell reads as one; the readings go."""
    if not columns:
        return df
    tests = [F.coalesce(F.bool_and(F.col(READING + c).isNotNull() | F.col(c).isNull()), F.lit(True)).alias(c) for c in columns]
    verdict = df.agg(*tests).first()
    chosen = [F.col(READING + c).alias(c) if c in columns and verdict[c] else F.col(c) for c in df.columns if not c.startswith(READING)]
    return df.select(*chosen)
