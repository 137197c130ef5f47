"""Splits, folds, caps and samples. Row identity is the four integer keys together."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query, table
from suite.standins import HASH, KEY, KEYS, LINES, band_lines
from tallyforge.operators import profiling
from tallyforge.operators import stratify as ops
from tallyforge.operators.features import engineer

RANKED = f"""r as (select *, row_number() over (partition by l_returnflag order by {HASH}) as rn,
    count(*) over (partition by l_returnflag) as n from lineitem)"""
IS_TEST = "rn > case when n > 1 then greatest(1, least(floor(n * cast(0.8 as double)), n - 1)) else floor(n * cast(0.8 as double)) end"


@query(f"with {RANKED} select {KEYS}, l_returnflag, {IS_TEST} as is_test from r")
def stratified_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_returnflag")
    return ops.mark_split(lines, "l_returnflag", key=KEY)


@query(f"with {RANKED} select l_returnflag, count(*) filter (not {IS_TEST}) as train_rows, count(*) filter ({IS_TEST}) as test_rows, 0 as faults from r group by 1")
def split_balance(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_returnflag")
    train, test = ops.stratified_split(lines, "l_returnflag", key=KEY)
    both = train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))
    faults = ops.split_faults(lines, train, test, KEY).agg(F.count(F.lit(1)).cast("int")).scalar()
    sides = both.groupBy("l_returnflag").agg(F.count_if(~F.col("test")).alias("train_rows"), F.count_if("test").alias("test_rows"))
    return sides.select("*", faults.alias("faults"))


@query(f"""with {RANKED},
    deal as (select l_returnflag, (row_number() over (order by l_returnflag) - 1) % 5 as f from lineitem),
    size as (select l_returnflag, f, count(*) as s from deal group by all),
    ends as (select l_returnflag, sum(s) over (partition by l_returnflag order by f) as e from size)
    select {KEYS}, l_returnflag, cast((select count(*) from ends where ends.l_returnflag = r.l_returnflag and ends.e < r.rn) as integer) as fold from r""")
def kfold(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_returnflag")
    return ops.stratified_folds(lines, "l_returnflag", 5, key=KEY)


MAX_ROWS = 20_000
CAP = f"""c as (select l_returnflag, count(*) as n from lineitem group by 1),
    share as (select l_returnflag, n, greatest(round_even(n / sum(n) over () * {MAX_ROWS}, 0), 1) as s, sum(n) over () as total from c),
    cut as (select *, greatest(0, sum(s) over () - {MAX_ROWS}) as e, coalesce(sum(s - 1) over (order by l_returnflag rows between unbounded preceding and 1 preceding), 0) as lower from share),
    keep as (select l_returnflag, n, case when total <= {MAX_ROWS} then n else least(n, s - greatest(0, least(s - 1, e - lower))) end as k from cut)"""


@query(f"with {RANKED}, {CAP} select {KEYS}, l_returnflag from r join keep using (l_returnflag) where rn <= k")
def row_cap(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_returnflag")
    return ops.stratified_cap(lines, "l_returnflag", MAX_ROWS, key=KEY)


@query(f"with {CAP} select l_returnflag, n, cast(k as bigint) as keep from keep")
def row_cap_sizes(spark, sf_dir):
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return ops.cap_sizes(sizes, "l_returnflag", MAX_ROWS)


@query(f"""with {RANKED}, {CAP} select {KEYS}, round(l_quantity - l_tax, 7) as color_q_t from r join keep using (l_returnflag) where rn <= k""")
def paired_sample(spark, sf_dir):
    lines = band_lines(spark, sf_dir)
    _, pair = ops.paired_cap(lines, engineer(lines, LINES), "flag", MAX_ROWS, key=KEY)
    return pair.select(*KEY, F.round("color_q_t", 7).alias("color_q_t"))


@query(f"select {KEYS}, l_quantity from lineitem qualify row_number() over (order by {HASH}) <= 12000")
def seeded_sample(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_quantity")
    return ops.seeded_sample(lines, 12_000, key=KEY)


@query(f"select {KEYS}, l_quantity, row_number() over (order by {HASH}, md5(l_orderkey || '')) as position from lineitem")
def seeded_shuffle(spark, sf_dir):
    return ops.seeded_shuffle(table(spark, sf_dir, "lineitem").select(*KEY, "l_quantity"), key=KEY)


@query(f"""with {RANKED}, t as (select count(*) filter (not {IS_TEST}) as train_rows, count(*) filter ({IS_TEST}) as test_rows from r)
    select 'cleaned' as stage, 4 as feature_count, train_rows, test_rows, 0 as feature_delta from t
    union all select 'engineered', 15, train_rows, test_rows, 11 from t""")
def stage_table(spark, sf_dir):
    marked = ops.mark_split(band_lines(spark, sf_dir), "flag", key=KEY).drop(*KEY)
    stages = profiling.stage_table(marked, engineer(marked, LINES), "flag")
    return stages.withColumn("feature_count", F.col("feature_count").cast("int")).withColumn("feature_delta", F.col("feature_delta").cast("int"))
