"""Metrics of two prediction rules, and their comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.registry import query, table
from suite.standins import PREDICTIONS_SQL, predictions
from tallyforge.operators import comparison, trials
from tallyforge.operators import evaluation as ops

ORDER = [0, 1, 2]
METRICS = ("precision", "recall", "f1_score")


def _counts(spark, sf_dir, rule):
    return ops.prediction_counts(predictions(spark, sf_dir), "actual", rule)


def _rounded(df, columns):
    return df.select(*[F.round(c, 9).alias(c) if c in columns else F.col(c) for c in df.columns])


GRID = "grid as (select a.v as actual, p.v as predicted from (values (0), (1), (2)) a(v), (values (0), (1), (2)) p(v))"
CELLS = lambda rule: f"""(select cast(g.actual as bigint) as actual, cast(g.predicted as bigint) as predicted, count(pred.actual) as rows
    from grid g left join pred on pred.actual = g.actual and pred.{rule} = g.predicted group by 1, 2)"""
CLASSES = lambda rule, labels: f"""(select label, coalesce(tp / nullif(chosen, 0), 0) as precision, coalesce(tp / nullif(support, 0), 0) as recall,
    coalesce(2 * tp / nullif(chosen + support, 0), 0) as f1_score, support
    from (select l.label, count(*) filter (actual = l.label and {rule} = l.label) as tp, count(*) filter (actual = l.label) as support,
        count(*) filter ({rule} = l.label) as chosen from pred, ({labels}) l group by l.label))"""
ORDERED = "select cast(unnest([0, 1, 2]) as bigint) as label"
SEEN = lambda rule: f"select actual as label from pred union select {rule} from pred"


@query(f"with {PREDICTIONS_SQL}, {GRID} select * from {CELLS('one')}")
def confusion(spark, sf_dir):
    return ops.confusion_cells(_counts(spark, sf_dir, "one"), ORDER).select("actual", "predicted", "rows")


@query(f"with {PREDICTIONS_SQL} select label, round(precision, 9) as precision, round(recall, 9) as recall, round(f1_score, 9) as f1_score, support from {CLASSES('one', ORDERED)}")
def class_metrics(spark, sf_dir):
    return _rounded(ops.class_metrics(_counts(spark, sf_dir, "one"), ORDER), METRICS)


@query(f"with {PREDICTIONS_SQL} select label, round(precision, 9) as precision, round(recall, 9) as recall, round(f1_score, 9) as f1_score, support from {CLASSES('one', SEEN('one'))}")
def observed_class_metrics(spark, sf_dir):
    return _rounded(ops.observed_class_metrics(_counts(spark, sf_dir, "one")), METRICS)


@query(f"with {PREDICTIONS_SQL} select round(avg(cast(actual = one as integer)), 9) as accuracy from pred")
def accuracy(spark, sf_dir):
    return _rounded(ops.accuracy(_counts(spark, sf_dir, "one")), ["accuracy"])


@query(f"with {PREDICTIONS_SQL} select round(avg(f1_score), 9) as f1_macro from {CLASSES('one', SEEN('one'))}")
def macro_f1(spark, sf_dir):
    return _rounded(ops.macro_f1(_counts(spark, sf_dir, "one")), ["f1_macro"])


@query(f"""with {PREDICTIONS_SQL}, {GRID},
    e as (select 1 - sum(rows) filter (actual = predicted) / sum(rows) as e from {CELLS('one')}), b as (select 1 - avg(recall) as b from {CLASSES('one', ORDERED)})
    select round(e, 9) as error_rate, round(e, 9) as zero_one_loss, round(e, 9) as hamming_loss, round(e, 9) as mean_classification_error,
        round(b, 9) as balanced_error_rate from e, b""")
def error_metrics(spark, sf_dir):
    counts = _counts(spark, sf_dir, "one")
    errors = ops.error_metrics(ops.confusion_cells(counts, ORDER), ops.class_metrics(counts, ORDER))
    return _rounded(errors, errors.columns)


@query(f"""with {PREDICTIONS_SQL}, {GRID}, lines as (select actual, string_agg(rows, ',' order by predicted) as line from {CELLS('one')} group by 1)
    select round((select avg(cast(actual = one as integer)) from pred), 9) as accuracy,
        round((select avg(f1_score) from {CLASSES('one', SEEN('one'))}), 9) as f1_macro,
        (select '[' || string_agg('[' || line || ']', ',' order by actual) || ']' from lines) as confusion_matrix,
        (select round(recall, 9) from {CLASSES('one', ORDERED)} where label = 1) as recall_1""")
def evaluate_rule(spark, sf_dir):
    row = ops.evaluation_row(_counts(spark, sf_dir, "one"), ORDER)
    return row.select(
        F.round("accuracy", 9).alias("accuracy"), F.round("f1_macro", 9).alias("f1_macro"),
        F.to_json("confusion_matrix").alias("confusion_matrix"), F.round(F.col("per_class_metrics")["1"]["recall"], 9).alias("recall_1"),
    )


@query("""select 'cleaned' as dataset_variant, count(*) filter (l_linestatus = 'F') || ',2' as train_shape,
    count(*) filter (l_linestatus = 'O') || ',2' as test_shape, 'l_quantity,l_tax' as feature_columns, cast(2 as bigint) as n_features from lineitem""")
def dataset_info(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    info = ops.dataset_info(lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus = 'O'"), ["l_quantity", "l_tax"], "cleaned")
    joined = [F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in ("train_shape", "test_shape", "feature_columns")]
    return info.select("dataset_variant", *joined, "n_features")


def _cells(spark, sf_dir, rule):
    return ops.confusion_cells(_counts(spark, sf_dir, rule), ORDER)


DELTA = f"""select actual, predicted, t.rows - b.rows as delta from {CELLS('one')} b join {CELLS('two')} t using (actual, predicted)"""


@query(f"with {PREDICTIONS_SQL}, {GRID} {DELTA}")
def confusion_delta(spark, sf_dir):
    return comparison.confusion_delta(_cells(spark, sf_dir, "one"), _cells(spark, sf_dir, "two"))


@query(f"with {PREDICTIONS_SQL}, {GRID}, d as ({DELTA}) select -max(abs(delta)) as lower, max(abs(delta)) as upper from d")
def delta_bounds(spark, sf_dir):
    return comparison.delta_bounds(confusion_delta(spark, sf_dir))


@query(f"""with {PREDICTIONS_SQL}, o as (select cast(unnest([0, 1, 2, 9]) as bigint) as label)
    select o.label, {", ".join(f"round(coalesce({s}.{m}, 0), 9) as {n}_{m}" for s, n in (("b", "baseline"), ("t", "tuned")) for m in METRICS)},
        coalesce(t.support, b.support, 0) as support
    from o left join {CLASSES('one', SEEN('one'))} b on b.label = o.label left join {CLASSES('two', SEEN('two'))} t on t.label = o.label""")
def class_compare(spark, sf_dir):
    order = spark.range(1).select(F.explode(F.array(*[F.lit(v).cast("bigint") for v in (*ORDER, 9)])).alias("label"))
    sides = [ops.observed_class_metrics(_counts(spark, sf_dir, rule)) for rule in ("one", "two")]
    both = comparison.compare_classes(order, *sides)
    return _rounded(both, [c for c in both.columns if c not in ("label", "support")])


@query("""with m as (select l_suppkey, l_returnflag as stage, 'quantity' as metric, avg(l_quantity) / 100 as value from lineitem group by all
    union all select l_suppkey, l_returnflag, 'discount', avg(l_discount) from lineitem group by all)
    select l_suppkey, stage, metric, round(value, 9) as value,
        round((value - lag(value) over (partition by l_suppkey, metric order by stage)) * 100, 9) as change_pp from m""")
def stage_delta(spark, sf_dir):
    means = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("stage")).agg(
        (F.avg("l_quantity") / 100).alias("quantity"), F.avg("l_discount").alias("discount")
    )
    long = means.unpivot(["l_suppkey", "stage"], ["quantity", "discount"], "metric", "value")
    return _rounded(comparison.stage_changes(long, ["l_suppkey", "metric"]), ["value", "change_pp"])


TRIALS = """trials as (select row_number() over (order by o_orderpriority, o_orderstatus) as trial, round(avg(o_totalprice), 4) as mean_test_score
    from orders group by o_orderpriority, o_orderstatus)"""


def _trials(spark, sf_dir):
    groups = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus")
    means = groups.agg(F.round(F.avg("o_totalprice"), 4).alias("mean_test_score"))
    number = F.row_number().over(Window.orderBy("o_orderpriority", "o_orderstatus")).cast("bigint")
    return means.select(number.alias("trial"), "mean_test_score")


@query(f"with {TRIALS} select trial, mean_test_score, rank() over (order by mean_test_score desc) as rank from trials")
def trial_rank(spark, sf_dir):
    return trials.rank_trials(_trials(spark, sf_dir))


@query(f"with {TRIALS} select * from trials order by mean_test_score desc, trial limit 5")
def trial_top5(spark, sf_dir):
    return trials.top_trials(_trials(spark, sf_dir))


RUNS = """select o_orderkey, cast(o_orderkey % 101 as double) / 100 as cv_f1, cast(o_custkey % 101 as double) / 100 as test_f1,
    floor(o_totalprice) % 101 / cast(100 as double) as accuracy from orders"""


@query(f"""with r as ({RUNS}) select *, case when cv_f1 > 0 then cv_f1 - test_f1 else 0 end as gap,
    case when cv_f1 <= 0 then 'unknown' when cv_f1 - test_f1 > cast(0.03 as double) then 'overfit'
        when test_f1 < cast(0.9 as double) or accuracy < cast(0.9 as double) then 'underfit' else 'healthy' end as verdict from r""")
def fit_diagnosis(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_orderkey % 101 as double) / 100 as cv_f1", "cast(o_custkey % 101 as double) / 100 as test_f1",
        "floor(o_totalprice) % 101 / cast(100 as double) as accuracy",
    )
    return comparison.diagnose_fit(runs)


@query("select o_orderkey, case when o_custkey % 4 > 0 then round(o_totalprice / (o_custkey % 4), 7) else 0 end as per_second from orders")
def per_second(spark, sf_dir):
    rate = comparison.score_per_second(F.col("o_totalprice"), F.expr("cast(o_custkey % 4 as double)"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(rate, 7).alias("per_second"))


@query(f"""with {PREDICTIONS_SQL}, p as (select 'one' as rule, actual, one as predicted from pred union select 'two', actual, two from pred)
    select rule, count(distinct (actual, predicted)) = 9 and max(predicted) <= 2 as fits from p group by 1""")
def matrix_shape(spark, sf_dir):
    """Whether the counts of a rule fill exactly the matrix of three classes; the first rule also predicts a fourth one."""
    counts = {rule: _counts(spark, sf_dir, rule) for rule in ("one", "two")}
    rows = [(rule, comparison.has_shape(c, [0, 1, 2])) for rule, c in counts.items()]
    return spark.createDataFrame(rows, "rule string, fits boolean")
