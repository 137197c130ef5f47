"""The given tables in the shape the operators expect, as Spark tables and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from suite.registry import table
from tallyforge.spec import TableSpec

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEYS = ", ".join(KEY)
HASH = "md5('42|' || l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber)"

LINES = TableSpec(
    numeric=("q", "p", "d", "t"),
    target="flag",
    labels={"A": 0, "N": 1, "R": 2},
    id_columns=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    bands=("q", "p", "d", "t"),
    differences=(("q", "p"), ("p", "d"), ("d", "t"), ("q", "t")),
    factor="t",
    factor_differences=(("q", "p"), ("d", "t")),
    minority_label="N",
)

# One text for both engines: rows with blanks, tokens, suffixes and strange labels.
DIRTY = {
    "q": """case when l_linenumber = 1 and l_quantity < 4 then ''
        when l_linenumber = 2 and l_quantity < 4 then 'NA'
        when l_linenumber = 3 and l_quantity < 4 then 'abc'
        when l_linenumber = 4 and l_quantity < 4 then '1.0d'
        when l_linenumber = 5 and l_quantity < 4 then ' 1e1 '
        else cast(cast(l_quantity as bigint) as string) end""",
    "p": """case when l_linenumber = 5 and l_quantity < 6 then 'n/a'
        when l_linenumber = 1 and l_quantity < 3 then 'bad'
        else cast(cast(round(l_extendedprice * 100) as bigint) as string) end""",
    "d": """case when l_linenumber = 6 and l_quantity > 48 then '-'
        else cast(cast(round(l_discount * 100) as bigint) as string) end""",
    "t": """case when l_linenumber = 7 and l_quantity > 48 then '0x1p3'
        else cast(cast(round(l_tax * 100) as bigint) as string) end""",
    "flag": """case when l_linenumber = 1 and l_quantity > 47 then concat('  ', lower(l_returnflag), chr(9))
        when l_linenumber = 2 and l_quantity > 47 then null
        when l_linenumber = 3 and l_quantity > 47 then '  '
        when l_linenumber = 4 and l_quantity > 47 then 'x9'
        when l_linenumber = 1 and l_quantity < 3 then 'other'
        else l_returnflag end""",
}

_TOKEN = lambda c: f"case when {c} in ('', 'NA', 'n/a') then null else {c} end as {c}"
_NUMBER = lambda c: (
    f"case when regexp_full_match({c}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') "
    f"then cast(trim({c}) as double) end"
)

# CTEs: texts as they come in, then numbers, flags and the encoded label.
DIRTY_SQL = f"""
    dirty as (select {KEYS}, {", ".join(f"{v} as {k}" for k, v in DIRTY.items())} from lineitem),
    raw as (select {KEYS}, {", ".join(_TOKEN(c) for c in DIRTY)} from dirty),
    parsed as (
        select {KEYS}, {", ".join(f"{_NUMBER(c)} as {c}, {c} as raw_{c}" for c in "qpdt")}, flag,
            upper(regexp_replace(flag, '^\\s+|\\s+$', '', 'g')) as label
        from raw),
    flagged as (
        select *, case label when 'A' then 0 when 'N' then 1 when 'R' then 2 end as code,
            raw_q is null or raw_p is null or raw_d is null or raw_t is null or flag is null as missing,
            (q is null or p is null or d is null or t is null)
                and not (raw_q is null or raw_p is null or raw_d is null or raw_t is null or flag is null) as malformed,
            flag is not null and label not in ('A', 'N', 'R') as unknown
        from parsed),
    clean as (select {KEYS}, q, p, d, t, cast(code as bigint) as flag from flagged
        where not (missing or malformed or unknown))
"""


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as untyped text with faults in known places, before missing tokens are read."""
    return table(spark, sf_dir, "lineitem").selectExpr(*KEY, *[f"{v} as {k}" for k, v in DIRTY.items()])


def band_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with four numeric columns and their encoded class."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *KEY, "l_quantity as q", "l_extendedprice as p", "l_discount as d", "l_tax as t",
        "cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint) as flag",
    )


BANDS_SQL = f"""
    bands as (select {KEYS}, l_quantity as q, l_extendedprice as p, l_discount as d, l_tax as t,
        cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint) as flag from lineitem)
"""

# Two rules that predict a class from other columns; the first one also predicts a class out of order.
RULES = {
    "one": "cast(case when l_quantity < 15 then 0 when l_quantity <= 40 then 1 when l_quantity < 49 then 2 else 3 end as bigint)",
    "two": "cast(case when l_discount < 0.03 then 0 when l_tax < 0.05 then 2 else 1 end as bigint)",
}
ACTUAL = "cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(f"{ACTUAL} as actual", *[f"{v} as {k}" for k, v in RULES.items()])


PREDICTIONS_SQL = f"pred as (select {ACTUAL} as actual, {', '.join(f'{v} as {k}' for k, v in RULES.items())} from lineitem)"
