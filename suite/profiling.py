"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query, table
from suite.standins import BANDS_SQL, HASH, KEY, band_lines
from tallyforge.operators import profiling as ops
from tallyforge.operators.features import numeric_columns
from tallyforge.operators.quantiles import box_outliers as outliers
from tallyforge.operators.quantiles import box_summary as boxes
from tallyforge.operators.stratify import seeded_sample


@query("select l_returnflag, count(*) as rows from lineitem group by 1")
def class_distribution(spark, sf_dir):
    return ops.class_distribution(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("select l_returnflag, round(count(*) / sum(count(*)) over (), 9) as share from lineitem group by 1")
def class_share(spark, sf_dir):
    shares = ops.class_shares(table(spark, sf_dir, "lineitem"), "l_returnflag")
    return shares.withColumn("share", F.round("share", 9))


@query("""with c as (select toxic, count(*) as n from labels group by 1)
    select round(sum(n) filter (toxic = 1) / sum(n), 9) as minority_share,
        round(max(n) / min(n), 9) as majority_to_minority_ratio,
        case when max(n) / min(n) > 2 then 'use_class_weight_balanced' else 'class_weight_not_required' end as recommendation from c""")
def imbalance(spark, sf_dir):
    row = ops.imbalance(ops.class_distribution(table(spark, sf_dir, "labels"), "toxic"), "toxic", 1)
    return row.select(
        F.round("minority_share", 9).alias("minority_share"),
        F.round("majority_to_minority_ratio", 9).alias("majority_to_minority_ratio"), "recommendation",
    )


@query("""select feature, round(s, 7) as skewness, abs(s) > 1.5 as high from (
    select 'value' as feature, skewness(value) as s from events
    union all select 'l_quantity', skewness(l_quantity) from lineitem
    union all select 'l_extendedprice', skewness(l_extendedprice) from lineitem
    union all select 'l_discount', skewness(l_discount) from lineitem)""")
def skew_report(spark, sf_dir):
    events = ops.skew_report(table(spark, sf_dir, "events"), ["value"])
    lines = ops.skew_report(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return events.unionByName(lines).withColumn("skewness", F.round("skewness", 7))


@query(f"""with {BANDS_SQL}, c as (
    select 'q' as x, 'p' as y, corr(q, p) as r from bands union all select 'q', 'd', corr(q, d) from bands
    union all select 'q', 't', corr(q, t) from bands union all select 'p', 'd', corr(p, d) from bands
    union all select 'p', 't', corr(p, t) from bands union all select 'd', 't', corr(d, t) from bands),
    full_c as (select * from c union all select y, x, r from c
    union all select 'q', 'q', 1.0 union all select 'p', 'p', 1.0 union all select 'd', 'd', 1.0 union all select 't', 't', 1.0)
    select x as feature_x, y as feature_y, round(r, 9) as correlation from full_c""")
def correlation(spark, sf_dir):
    matrix = ops.correlation_matrix(band_lines(spark, sf_dir), ["q", "p", "d", "t"])
    return matrix.withColumn("correlation", F.round("correlation", 9))


@query("""with long as (unpivot (select l_quantity, l_extendedprice, l_discount, l_tax from lineitem) on * into name feature value v),
    ends as (select feature, min(v) as lo, max(v) as hi from long group by 1),
    bins as (select feature, lo, hi, least(cast(floor((v - lo) / (hi - lo) * 40) as bigint), 39) + 1 as bin from long join ends using (feature))
    select feature, bin, round(lo + (hi - lo) * (bin - 1) / 40, 7) as bin_start, round(lo + (hi - lo) * bin / 40, 7) as bin_end, count(*) as rows
    from bins group by feature, bin, lo, hi""")
def histogram(spark, sf_dir):
    bins = ops.histogram(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return bins.withColumn("bin_start", F.round("bin_start", 7)).withColumn("bin_end", F.round("bin_end", 7))


BOXES = """with long as (select 'value' as feature, event_type, value as v from events where value is not null),
    q as (select feature, event_type, count(*) as n, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median,
        quantile_cont(v, 0.75) as q3 from long group by all),
    f as (select *, q1 - 1.5 * (q3 - q1) as lower_fence, q3 + 1.5 * (q3 - q1) as upper_fence from q)"""


@query(f"""{BOXES}
    select feature, event_type, n, round(q1, 7) as q1, round(median, 7) as median, round(q3, 7) as q3,
        round(lower_fence, 7) as lower_fence, round(upper_fence, 7) as upper_fence,
        min(v) filter (v between lower_fence and upper_fence) as lower_whisker,
        max(v) filter (v between lower_fence and upper_fence) as upper_whisker,
        count(*) filter (v not between lower_fence and upper_fence) as outliers
    from long join f using (feature, event_type) group by feature, event_type, n, q1, median, q3, lower_fence, upper_fence""")
def box_summary(spark, sf_dir):
    summary = boxes(table(spark, sf_dir, "events"), ["value"], "event_type")
    exact = ["feature", "event_type", "n", "lower_whisker", "upper_whisker", "outliers"]
    return summary.select(*exact, *[F.round(c, 7).alias(c) for c in summary.columns if c not in exact])


@query(f"{BOXES} select feature, event_type, v as value from long join f using (feature, event_type) where v not between lower_fence and upper_fence")
def box_outliers(spark, sf_dir):
    return outliers(table(spark, sf_dir, "events"), ["value"], "event_type")


@query("""with g as (select event_type, count(value) as n, 1.06 * stddev_samp(value) * power(count(value), -0.2) as bw,
        min(value) as lo, max(value) as hi from events group by 1 having count(value) >= 2 and stddev_samp(value) > 1e-12),
    pts as (select *, point, lo + (hi - lo) * point / 89 as x from g, range(90) as r(point))
    select 'value' as feature, p.event_type, cast(point as integer) as point, round(x, 7) as x,
        round(sum(exp(-0.5 * power((x - value) / bw, 2))) / (n * bw * sqrt(2 * pi())), 9) as density
    from pts p join events e on p.event_type = e.event_type group by p.event_type, point, x, n, bw""")
def kde(spark, sf_dir):
    curves = ops.density_curves(table(spark, sf_dir, "events"), ["value"], "event_type")
    return curves.withColumn("x", F.round("x", 7)).withColumn("density", F.round("density", 9))


@query("""select l_returnflag, 'l_quantity' as feature_x, 'l_extendedprice' as feature_y, l_quantity as x, l_extendedprice as y from lineitem""")
def pair_points(spark, sf_dir):
    return ops.pair_points(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag")


@query(f"""with {BANDS_SQL}, r as (select flag, row_number() over (order by {HASH}) as rn from bands)
    select flag, case flag when 0 then 'A' when 1 then 'N' else 'R' end as label, count(*) as rows from r where rn <= 12000 group by 1, 2""")
def named_class_counts(spark, sf_dir):
    sample = seeded_sample(band_lines(spark, sf_dir), 12_000, key=KEY)
    return ops.named_class_counts(sample, "flag", {0: "A", 1: "N", 2: "R"})


@query("""select 'customer' as source, 'c_nationkey,c_acctbal' as columns, count(*) as rows from customer where c_acctbal is not null
    union all select 'events', 'event_id,user_id,value', count(*) from events where value is not null""")
def numeric_selection(spark, sf_dir):
    def one(name, target):
        df = table(spark, sf_dir, name)
        columns = numeric_columns(df, target)
        return df.dropna(subset=columns).agg(F.lit(name).alias("source"), F.lit(",".join(columns)).alias("columns"), F.count(F.lit(1)).alias("rows"))

    return one("customer", "c_custkey").unionByName(one("events", "event_type"))
