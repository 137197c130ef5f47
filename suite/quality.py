"""Cleaning and its accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query, table
from suite.standins import DIRTY_SQL, KEY, KEYS, LINES, dirty_lines
from tallyforge.functions.labels import decode_label
from tallyforge.functions.parsing import display_text, integer_or_zero, number_or_zero
from tallyforge.operators import quality as ops


def _raw(spark, sf_dir):
    return ops.read_missing_tokens(dirty_lines(spark, sf_dir))


def _flagged(spark, sf_dir):
    return ops.flag_rows(ops.drop_id_columns(_raw(spark, sf_dir), LINES)[0], LINES)


@query(f"""with {DIRTY_SQL}
    select count(*) as rows_initial, count(*) filter (not (missing or malformed or unknown)) as rows_after_cleaning,
        count(*) filter (missing) as rows_removed_missing, count(*) filter (malformed or unknown) as rows_removed_malformed,
        count(*) filter (missing or malformed or unknown) as rows_removed_total,
        round(count(*) filter (missing or malformed or unknown) / count(*) * 100, 6) as removal_pct
    from flagged""")
def quality_report(spark, sf_dir):
    report = ops.quality_report(_flagged(spark, sf_dir), LINES, list(LINES.required))
    return report.withColumn("removal_pct", F.round("removal_pct", 6)).drop("missing_by_column", "malformed_by_column")


@query(f"""with {DIRTY_SQL},
    counts as (
        select 'q' as name, count(*) filter (raw_q is null) as missing, count(*) filter (raw_q is not null and q is null) as malformed from flagged
        union all select 'p', count(*) filter (raw_p is null), count(*) filter (raw_p is not null and p is null) from flagged
        union all select 'd', count(*) filter (raw_d is null), count(*) filter (raw_d is not null and d is null) from flagged
        union all select 't', count(*) filter (raw_t is null), count(*) filter (raw_t is not null and t is null) from flagged
        union all select 'flag', count(*) filter (flag is null), 0 from flagged)
    select name, missing, malformed from counts""")
def quality_columns(spark, sf_dir):
    report = ops.quality_report(_flagged(spark, sf_dir), LINES, list(LINES.required))
    names = F.array(*[F.lit(c) for c in LINES.required])
    return report.select("missing_by_column", "malformed_by_column", F.explode(names).alias("name")).select(
        "name",
        F.coalesce(F.try_element_at("missing_by_column", F.col("name")), F.lit(0).cast("bigint")).alias("missing"),
        F.coalesce(F.try_element_at("malformed_by_column", F.col("name")), F.lit(0).cast("bigint")).alias("malformed"),
    )


@query(f"with {DIRTY_SQL} select {KEYS}, missing, malformed, unknown, missing or malformed or unknown as dropped from flagged")
def quality_flags(spark, sf_dir):
    flagged = ops.flag_rows(_raw(spark, sf_dir), LINES)
    return flagged.select(
        *KEY, F.col("_missing").alias("missing"), F.col("_malformed").alias("malformed"),
        F.col("_unknown").alias("unknown"), ops.dropped().alias("dropped"),
    )


@query(f"with {DIRTY_SQL} select label, count(*) as rows from flagged where unknown group by label")
def unknown_labels(spark, sf_dir):
    return ops.unknown_labels(_flagged(spark, sf_dir))


@query(f"with {DIRTY_SQL} select coalesce(label, 'NAN') as label, count(*) as rows from flagged group by 1")
def raw_label_counts(spark, sf_dir):
    return ops.raw_label_counts(_raw(spark, sf_dir), LINES.target)


@query(f"with {DIRTY_SQL} select q, p, d, t, flag from clean")
def clean_encode(spark, sf_dir):
    return ops.clean_rows(_raw(spark, sf_dir), LINES)


@query("""select o_orderkey, case o_orderstatus when 'F' then 'FINAL' when 'O' then 'OPEN' else cast(code as varchar) end as label
    from (select *, case o_orderstatus when 'F' then 0 when 'O' then 1 else 7 end as code from orders)""")
def label_decode(spark, sf_dir):
    code = F.expr("case o_orderstatus when 'F' then 0 when 'O' then 1 else 7 end")
    return table(spark, sf_dir, "orders").select("o_orderkey", decode_label(code, {0: "FINAL", 1: "OPEN"}).alias("label"))


@query(f"""with {DIRTY_SQL}
    select {KEYS}, coalesce(q, 0) as q_number,
        case when regexp_full_match(raw_q, '\\s*[+-]?[0-9]+\\s*') then cast(trim(raw_q) as bigint) else 0 end as q_integer from flagged""")
def safe_numbers(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        *KEY, number_or_zero(F.col("q")).alias("q_number"), integer_or_zero(F.col("q")).alias("q_integer")
    )


@query("""select o_orderkey, o_totalprice, coalesce(case when o_orderstatus <> 'P' then o_orderstatus end, '') as status,
    case when o_orderstatus = 'F' then 'true' when o_orderstatus = 'O' then 'false' else '' end as finished from orders""")
def display_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "case when o_orderstatus <> 'P' then o_orderstatus end as status",
        "case when o_orderstatus <> 'P' then o_orderstatus = 'F' end as finished",
    )
    return orders.select(*[display_text(F.col(f.name), f.dataType).alias(f.name) for f in orders.schema.fields])
