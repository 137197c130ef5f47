"""Report documents: one per order, written as JSON by Spark; the SQL works from the columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query, table
from tallyforge.operators import artifacts as ops
from tallyforge.operators import trials
from tallyforge.session import spread

def _by_status(finished, opened, other):
    status = F.col("o_orderstatus")
    return F.when(status == "F", finished).when(status == "O", opened).otherwise(other)


def _json(text: str):
    """JSON with ``{column}`` places filled in from the row; braces of JSON are written as ``<`` and ``>``."""
    parts = []
    for i, piece in enumerate(text.replace("<", "\x01").replace(">", "\x02").replace("{", "\x00").replace("}", "\x00").split("\x00")):
        piece = piece.replace("\x01", "{").replace("\x02", "}")
        parts.append(F.expr(f"cast({piece} as string)") if i % 2 else F.lit(piece))
    return F.concat(*parts)


# Six trials per run; ranks repeat, so the score and then the place in the list decide.
RANK = "((o_custkey + {j} * 7) % 4)"
# How the rank of each trial is written in JSON; a text with a fraction reads as 0, true as 1.
RANK_TEXTS = ["{{{0}}}", "{{{0}}}", "{{{0}}}.0", '"{{{0}}}"', '"{{{0}}}.0"', "true"]
RANK_SQL = f"case j when 4 then 0 when 5 then 1 else {RANK.format(j='j')} end"
SCORE = "((o_orderkey * ({j} + 3)) % 97)"


def _runs(spark, sf_dir):
    def listed(key, score, rank):
        rows = [
            "<" + (f'"rank": {RANK_TEXTS[j].format(RANK.format(j=j))}, ' if rank else "")
            + f'"{score}": {{{SCORE.format(j=j)}}}, "std_test_score": true, "mean_score_time": "0.25", "mean_fit_time": {{o_custkey % 3}}, '
            + f'"params": <"n_estimators": {j}, "max_depth": null>, "max_features": "sqrt">'
            for j in range(6)
        ]
        return _json(f'<"{key}": [{", ".join(rows)}, 7]>')

    best = _json('<"best_params": <"n_estimators": {o_custkey}, "class_weight": "balanced">, "best_cv_score": "0.5", "top_results": []>')
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _by_status(listed("top_5_results", "mean_test_score", True), listed("top_results", "cv_macro_f1", False), best).alias("best"),
        F.lit("{}").alias("tuned"),
    )


TRIAL_ROWS = f"""t as (select o_orderkey, o_orderstatus, o_custkey, cast(j as bigint) as j,
        case when o_orderstatus = 'F' then {RANK_SQL} else j + 1 end as rank, cast({SCORE.format(j='j')} as double) as score
    from orders, range(6) as r(j) where o_orderstatus <> 'P'),
    top as (select *, row_number() over (partition by o_orderkey order by rank, score desc, j) as place from t)"""


@query(f"""with {TRIAL_ROWS}
    select o_orderkey, 'saved-top5' as source, rank, score as cv_macro_f1, cast(1 as double) as cv_f1_std, cast(o_custkey % 3 as double) as mean_fit_time_s,
        cast(0.25 as double) as mean_score_time_s, cast(null as varchar) as min_samples_split, cast(j as varchar) as n_estimators,
        cast(null as varchar) as max_depth, 'sqrt' as max_features, cast(null as varchar) as class_weight,
        round(case when o_custkey % 3 > 0 then score / (o_custkey % 3) else 0 end, 7) as f1_per_fit_second
    from top where place <= 5
    union all select o_orderkey, 'best-only', 1, 0.5, 0, 0, 0, null, cast(o_custkey as varchar), null, null, 'balanced', 0 from orders where o_orderstatus = 'P'""")
def trial_table(spark, sf_dir):
    rows = trials.trial_table(_runs(spark, sf_dir), "best", "tuned")
    return rows.withColumn("f1_per_fit_second", F.round("f1_per_fit_second", 7))


@query(f"""with {TRIAL_ROWS}
    select cast(rank as varchar) as rank_label, cast(o_custkey % 3 as double) as mean_fit_time_s, score as cv_macro_f1, cast(1 as double) as cv_f1_std,
        cast(j as varchar) as n_estimators, cast(0.25 as double) as mean_score_time_s, cast(null as varchar) as max_depth, cast(null as varchar) as class_weight
    from top where place <= 5
    union all select '1', 0, 0.5, 0, cast(o_custkey as varchar), 0, null, 'balanced' from orders where o_orderstatus = 'P'""")
def trial_views(spark, sf_dir):
    rows = trials.trial_table(_runs(spark, sf_dir), "best", "tuned")
    return trials.tradeoff_view(rows)


@query(f"""with {TRIAL_ROWS}
    select cast(rank as varchar) as rank_label, cast(1 as double) as cv_f1_std from top where place <= 5
    union all select '1', 0 from orders where o_orderstatus = 'P'""")
def stability_view(spark, sf_dir):
    return trials.stability_view(trials.trial_table(_runs(spark, sf_dir), "best", "tuned"))


@query("""select o_orderkey, case o_orderstatus when 'F' then 'A=1,C=' || o_custkey || ',D=1' when 'O' then 'B=' || o_orderkey else 'N=0,Y=1' end as mapping from orders""")
def class_mapping(spark, sf_dir):
    report = _by_status(
        _json('<"class_mapping": <"A": 1.0, "B": "x", "C": "{o_custkey}", "D": true, "E": "1.0">, "target_encoding": <"Z": 9>>'),
        _json('<"target_encoding": <"B": {o_orderkey}>, "class_mapping": null>'),
        F.lit('{"class_mapping": [1, 2], "target_encoding": {"B": 5}}'),
    )
    mapping = ops.class_mapping(report, {"N": 0, "Y": 1})
    entries = F.transform(F.array_sort(F.map_entries(mapping)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", F.array_join(entries, ",").alias("mapping"))


@query("""select o_orderkey, case when o_orderpriority = '1-URGENT' then true when o_orderpriority = '2-HIGH' then o_orderstatus = 'F'
    when o_orderpriority = '3-MEDIUM' then o_custkey % 5 > 2 when o_orderpriority = '5-LOW' then o_orderkey % 7 > 2 else false end as balance from orders""")
def imbalance_advice(spark, sf_dir):
    priority = F.col("o_orderpriority")
    nested = _by_status(F.lit('"use_class_weight_BALANCED"'), F.lit('"class_weight_not_required"'), F.lit("3"))
    report = (
        F.when(priority == "1-URGENT", _json('<"imbalance_recommendation": "Balanced weights", "imbalance_ratio": {o_custkey}>'))
        .when(priority == "2-HIGH", F.concat(F.lit('{"imbalance_assessment": {"recommendation": '), nested, F.lit("}}")))
        .when(priority == "3-MEDIUM", _json('<"imbalance_recommendation": 4, "imbalance_ratio": "{o_custkey % 5}">'))
        .when(priority == "5-LOW", _json('<"class_balance": <"majority_minority_ratio": {o_orderkey % 7}>>'))
        .otherwise(F.lit('{"majority_minority_ratio": "many", "imbalance_ratio": 9}'))
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", ops.needs_balancing(report).alias("balance"))


M = ops.ISSUES


@query(f"""select o_orderkey, concat_ws('|', case when o_orderstatus = 'P' then '{M["baseline"]}' end,
        case when o_orderpriority = '1-URGENT' then '{M["tuned"]}' end, case when o_custkey % 3 = 0 then '{M["importance"]}' end,
        case when o_orderpriority = '2-HIGH' then '{M["order"]}' end,
        case when o_orderpriority in ('2-HIGH', '5-LOW') then '{M["matrix"]}' end,
        case when o_orderkey % 4 = 1 then '{M["engineered"]}' end, case when o_orderkey % 4 = 2 then '{M["features"]}' end) as issues from orders""")
def artifact_check(spark, sf_dir):
    priority, turn = F.col("o_orderpriority"), F.expr("o_orderkey % 4")
    baseline = F.concat(
        F.lit('{"status": "'), _by_status(F.lit("completed"), F.lit("completed"), F.lit("not_run")),
        F.when(turn == 1, '", "feature_columns": ["a", "x"]}').when(turn == 3, '"}').otherwise('", "feature_columns": ["a", "b"]}'),
    )
    tuned = F.concat(
        F.when(priority == "1-URGENT", "{").otherwise('{"status": "completed", '),
        F.when(priority == "2-HIGH", "").otherwise('"class_label_order": [0, 1], '),
        F.when(priority == "5-LOW", "").otherwise('"confusion_matrix": [[1, 0], [0, 1]], '),
        F.when(turn == 2, '"feature_columns": ["b", "a"]}').when(turn == 0, '"feature_columns": ["a", "b"]}')
        .otherwise('"feature_columns": ["b", "a", "c"], "feature_engineering": {"status": "completed"}}'),
    )
    importance = F.when(F.expr("o_custkey % 3 = 0"), F.lit("{}")).otherwise('{"status": "completed"}')
    documents = table(spark, sf_dir, "orders").select("o_orderkey", baseline.alias("b"), tuned.alias("t"), importance.alias("i"))
    checked = ops.artifact_issues(documents, "b", "t", "i")
    return checked.select("o_orderkey", F.array_join("issues", "|").alias("issues"))


@query("""with f as (select l_suppkey, list_sort(list(distinct l_returnflag) filter (l_linestatus = 'F' and l_quantity > 49)) as base,
        list_sort(list(distinct l_returnflag) filter (l_linestatus = 'O' and l_quantity < 3)) as tuned from lineitem group by 1)
    select l_suppkey, len(list_filter(coalesce(base, []), lambda x: not list_contains(coalesce(tuned, []), x))) = 0 as is_subset,
        array_to_string(list_filter(coalesce(base, []), lambda x: not list_contains(coalesce(tuned, []), x)), ',') as missing from f""")
def feature_subset(spark, sf_dir):
    # The sets hold at most the three flags.
    flags = lambda test: F.collect_set(F.when(F.expr(test), F.col("l_returnflag")))
    sets = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        flags("l_linestatus = 'F' and l_quantity > 49").alias("base"), flags("l_linestatus = 'O' and l_quantity < 3").alias("tuned")
    )
    missing = ops.missing_features(F.col("base"), F.col("tuned"))
    return sets.select(
        "l_suppkey", ops.is_feature_subset(F.col("base"), F.col("tuned")).alias("is_subset"), F.array_join(F.array_sort(missing), ",").alias("missing")
    )


@query("""select o_orderkey as run, 'baseline_metrics.json' as artifact from orders where o_orderstatus = 'P'
    union all select o_orderkey, 'best_params.json' from orders where o_orderpriority = '1-URGENT'
    union all select o_orderkey, 'tuned_metrics.json' from orders where o_orderpriority in ('1-URGENT', '5-LOW')""")
def missing_artifacts(spark, sf_dir):
    item = lambda name, payload: F.struct(F.lit(name).alias("artifact"), payload.alias("payload"))
    priority = F.col("o_orderpriority")
    present = F.array(
        item("baseline_metrics.json", _by_status(F.lit('{"accuracy": 0}'), F.lit('{"f1_macro": 1}'), F.lit('{"status": "not_run"}'))),
        item("best_params.json", F.when(priority == "1-URGENT", "{}").otherwise('{"status": "x"}')),
        item("tuned_metrics.json", F.when(priority == "1-URGENT", F.lit(None)).when(priority == "5-LOW", "[1]").otherwise('{"confusion_matrix": []}')),
    )
    documents = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.inline(present))
    return ops.missing_artifacts(documents, {"baseline_metrics.json": True, "best_params.json": False, "tuned_metrics.json": True})
