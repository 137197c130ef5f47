"""Whole programs and the scans and sinks they use."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import query, scratch, table
from suite.standins import BANDS_SQL, DIRTY_SQL, HASH, KEY, KEYS, LINES, band_lines, dirty_lines
from tallyforge.models import scoring
from tallyforge.models.forest import BASELINE, train_forest
from tallyforge.models.registry import features_or_default
from tallyforge.operators import quality, reports
from tallyforge.operators.features import added_columns, engineer
from tallyforge.operators.stratify import mark_split
from tallyforge.plans.prepare import REPORT, prepare
from tallyforge.sources import documents, tables
from tallyforge.streaming.scoring import read_stream, score_stream


@query(f"with {DIRTY_SQL} select {KEYS}, q, p, d, t, flag from raw".replace(KEYS + ", q", ", ".join(f"cast({k} as varchar) as {k}" for k in KEY) + ", q"))
def csv_scan(spark, sf_dir):
    """Text table written as CSV and read back with the missing tokens."""
    folder = scratch(spark)
    dirty_lines(spark, sf_dir).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(folder)
    return tables.read_folder(spark, folder, first_only=False)[0]


@query(f"with {BANDS_SQL} select {KEYS}, q, p, d, t, flag, 'engineered' as variant from bands where q < 25")
def split_scan(spark, sf_dir):
    """Prepared pair written and found again; the clean pair is not there, so the other is used."""
    folder = scratch(spark)
    lines = band_lines(spark, sf_dir)
    tables.write_tables({tables.ENGINEERED_PAIR[0]: lines.filter("q < 25"), tables.ENGINEERED_PAIR[1]: lines.filter("q >= 25")}, folder)
    train, _, names = tables.read_split(spark, folder, [tables.CLEAN_PAIR, tables.ENGINEERED_PAIR])
    return train.withColumn("variant", F.lit(names[2]))


@query(f"with {BANDS_SQL} select {KEYS}, q from bands")
def profile_scan(spark, sf_dir):
    """Table to profile when only one test table is left."""
    folder = scratch(spark)
    tables.write_tables({tables.CLEAN_PAIR[1]: band_lines(spark, sf_dir)}, folder)
    return tables.read_profile_table(spark, folder, "engineered").select(*KEY, "q")


SPLIT = f"""marked as (select *, row_number() over (partition by flag order by {HASH}) as rn, count(*) over (partition by flag) as n from clean),
    sides as (select *, rn > greatest(1, least(floor(n * cast(0.8 as double)), n - 1)) as is_test from marked)"""
REPORT_SQL = f"""with {DIRTY_SQL}, {SPLIT}, c as (select flag, count(*) as n from clean group by 1)
    select (select count(*) from flagged) as rows_initial, (select count(*) from clean) as rows_after_cleaning,
        (select count(*) from flagged where missing) as removed_missing, (select count(*) from flagged where malformed or unknown) as removed_malformed,
        (select count(*) from sides where not is_test) as train_rows, (select count(*) from sides where is_test) as test_rows,
        (select count(*) from sides where not is_test and flag = 1) as train_n, (select count(*) from sides where is_test and flag = 2) as test_r,
        (select round(skewness(q), 7) from clean) as skew_q, (select round(max(n) / min(n), 9) from c) as ratio,
        (select round(sum(n) filter (flag = 1) / sum(n), 9) from c) as minority_share, cast(15 as bigint) as features_after"""


def _figures(report):
    return report.select(
        "rows_initial", "rows_after_cleaning", F.col("rows_removed_by_reason.missing").alias("removed_missing"),
        F.col("rows_removed_by_reason.malformed").alias("removed_malformed"),
        F.col("split.train_rows").alias("train_rows"), F.col("split.test_rows").alias("test_rows"),
        F.col("split.train_class_counts")["1"].alias("train_n"), F.col("split.test_class_counts")["2"].alias("test_r"),
        F.round(F.col("skew_values")["q"], 7).alias("skew_q"),
        F.round("imbalance_assessment.majority_to_minority_ratio", 9).alias("ratio"),
        F.round("imbalance_assessment.qso_share", 9).alias("minority_share"),
        F.col("dataset_comparison.feature_count_after").alias("features_after"),
    )


def _report(spark, sf_dir):
    folder = scratch(spark)
    raw = quality.read_missing_tokens(dirty_lines(spark, sf_dir))
    tables.write_parquet(quality.flag_rows(raw, LINES), f"{folder}/flagged")
    flagged = tables.read_parquet(spark, f"{folder}/flagged")
    tables.write_parquet(mark_split(quality.keep_clean(flagged, LINES), "flag", key=KEY).drop(*KEY), f"{folder}/split")
    split = tables.read_parquet(spark, f"{folder}/split")
    return reports.preparation_report(
        quality.quality_report(flagged, LINES, list(LINES.required)), split, LINES, source="lineitem", dropped=KEY,
        clean_features=list(LINES.numeric), added=added_columns(split, engineer(split, LINES)), files={"clean_train_parquet": "train_clean.parquet"},
    )


@query(REPORT_SQL)
def preparation_report(spark, sf_dir):
    return _figures(_report(spark, sf_dir))


@query(f"""with {DIRTY_SQL} select '{{"rows_removed_missing":' || count(*) filter (missing) || ',"rows_removed_malformed":' || count(*) filter (malformed or unknown)
    || ',"rows_removed_total":' || count(*) filter (missing or malformed or unknown) || ',"feature_count_before":4,"feature_count_after":15}}' as summary from flagged""")
def preparation_summary(spark, sf_dir):
    return reports.summary_json(_report(spark, sf_dir))


@query(REPORT_SQL)
def prepare_program(spark, sf_dir):
    """CSV to the four tables and the report, read back from disk."""
    folder = scratch(spark)
    dirty_lines(spark, sf_dir).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{folder}/raw")
    report = prepare(spark, f"{folder}/raw", f"{folder}/prepared", LINES, first_only=False, key=KEY)
    return _figures(documents.read_document(spark, f"{folder}/prepared/{REPORT}", report.schema))


# Keys that come from CSV are text, so the order hash is over their JSON.
_JSON_KEY = " || ',' || ".join(f"""'"{k}":"' || {k} || '"'""" for k in KEY)
SIDES_SQL = f"""with {DIRTY_SQL}, {SPLIT.replace(HASH, f"md5('42|{{' || {_JSON_KEY} || '}}')")}"""


def _prepared(spark, sf_dir):
    """Folder with the prepared tables, and the report as read back."""
    folder = scratch(spark)
    dirty_lines(spark, sf_dir).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{folder}/raw")
    report = prepare(spark, f"{folder}/raw", f"{folder}/prepared", LINES, first_only=False, key=KEY)
    return f"{folder}/prepared", documents.read_document(spark, f"{folder}/prepared/{REPORT}", report.schema)


@query(f"""{SIDES_SQL}, wide as (select *, q - p as color_q_p, (q + p + d + t) / 4 as band_mean, t * (d - t) as t_color_d_t from sides)
    select name, cast(columns as integer) as columns, count(*) as rows, sum(flag)::bigint as flags, round(sum(q), 3) as q, round(sum(p), 3) as p,
        round(case when columns > 5 then sum(color_q_p + band_mean + t_color_d_t) end, 3) as derived
    from wide join (values ('{tables.CLEAN_PAIR[0]}', false, 5), ('{tables.CLEAN_PAIR[1]}', true, 5), ('{tables.ENGINEERED_PAIR[0]}', false, 16), ('{tables.ENGINEERED_PAIR[1]}', true, 16)) as f(name, test, columns)
        on is_test = test group by name, columns""")
def prepared_tables(spark, sf_dir):
    """The four tables that the preparation program leaves, read back."""
    folder, _ = _prepared(spark, sf_dir)

    def summary(name):
        df = tables.read_parquet(spark, f"{folder}/{name}")
        derived = F.sum(F.col("color_q_p") + F.col("band_mean") + F.col("t_color_d_t")) if "band_mean" in df.columns else F.lit(None).cast("double")
        return df.agg(
            F.lit(name).alias("name"), F.lit(len(df.columns)).alias("columns"), F.count(F.lit(1)).alias("rows"), F.sum("flag").alias("flags"),
            F.round(F.sum("q"), 3).alias("q"), F.round(F.sum("p"), 3).alias("p"), F.round(derived, 3).alias("derived"),
        )

    return reduce(DataFrame.unionByName, [summary(name) for name in (*tables.CLEAN_PAIR[:2], *tables.ENGINEERED_PAIR[:2])])


def _cells_sql(test):
    """JSON object with the rows of each number column for which ``test`` holds."""
    return "'{' || " + " || ',' || ".join(f"'\"{c}\":' || count(*) filter ({test.format(c=c)})" for c in "qpdt") + " || '}'"


def _classes_sql(test):
    return f"(select '{{' || string_agg('\"' || flag || '\":' || n, ',' order by flag) || '}}' from (select flag, count(*) as n from sides where {test} group by 1))"


_ADDED = ",".join(["color_q_p", "color_p_d", "color_d_t", "color_q_t", "band_mean", "band_std", "band_min", "band_max", "band_range", "t_color_q_p", "t_color_d_t"])


@query(f"""{SIDES_SQL}, f as (select count(*) as n, count(*) filter (missing) as missing, count(*) filter (malformed or unknown) as malformed, count(*) filter (missing or malformed or unknown) as total,
        {_cells_sql("raw_{c} is not null and {c} is null")} as bad from flagged)
    select unnest(['missing_value_strategy', 'target_column', 'target_encoding', 'dropped_columns', 'malformed_values_by_column', 'removed', 'removed_pct', 'transformations', 'clean_features', 'clean_count',
        'clean_train_classes', 'clean_test_classes', 'engineered_columns', 'engineering_status', 'engineered_feature_count', 'delta', 'test_size', 'random_state', 'engineered_train_rows',
        'comparison_added', 'comparison_removed', 'decision_basis', 'recommendation', 'files', 'stamped']) as field,
      unnest(['drop_rows_with_missing_values', 'flag', '{{"A":0,"N":1,"R":2}}', '{",".join(KEY)}', f.bad, f.missing || ',' || f.malformed || ',' || f.total, cast(round(f.total / f.n * 100, 6) as varchar), '0',
        'q,p,d,t', '4', {_classes_sql("not is_test")}, {_classes_sql("is_test")}, '{_ADDED}', 'completed', '15', '11', '0.2', '42', cast((select count(*) from sides where not is_test) as varchar),
        '{_ADDED}', '0', 'majority_to_minority_ratio_gt_2.0',
        (select case when max(n) / min(n) > 2 then 'use_class_weight_balanced' else 'class_weight_not_required' end from (select count(*) as n from clean group by flag)),
        '{",".join([*tables.CLEAN_PAIR[:2], *tables.ENGINEERED_PAIR[:2]])}', 'true']) as value from f""")
def report_fields(spark, sf_dir):
    """The nested fields of the preparation report, as text."""
    _, report = _prepared(spark, sf_dir)
    joined = lambda path: F.array_join(path, ",")
    stamp = F.col("created_at_utc").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{6}[+]00:00$")
    removed = F.col("rows_removed_by_reason")
    files = [F.col(f"output_files.{n}") for n in ("clean_train_parquet", "clean_test_parquet", "engineered_train_parquet", "engineered_test_parquet")]
    fields = {
        "missing_value_strategy": F.col("missing_value_strategy"), "target_column": F.col("target_column"), "target_encoding": F.to_json("target_encoding"), "dropped_columns": joined("dropped_columns"),
        "malformed_values_by_column": F.to_json("malformed_values_by_column"), "removed": F.concat_ws(",", removed["missing"], removed["malformed"], removed["total"]),
        "removed_pct": F.round("rows_removed_missing_pct", 6), "transformations": F.size("transformations_applied"), "clean_features": joined("clean_dataset.feature_columns"),
        "clean_count": F.col("clean_dataset.feature_count"), "clean_train_classes": F.to_json("clean_dataset.train_class_counts"), "clean_test_classes": F.to_json("clean_dataset.test_class_counts"),
        "engineered_columns": joined("feature_engineering.engineered_columns"), "engineering_status": F.col("feature_engineering.status"),
        "engineered_feature_count": F.col("feature_engineering.engineered_feature_count"), "delta": F.col("feature_engineering.feature_count_delta"), "test_size": F.col("split.test_size"),
        "random_state": F.col("split.random_state"), "engineered_train_rows": F.col("split.engineered_train_rows"), "comparison_added": joined("dataset_comparison.engineered_columns_added"),
        "comparison_removed": F.size("dataset_comparison.engineered_columns_removed"), "decision_basis": F.col("imbalance_assessment.decision_basis"),
        "recommendation": F.col("imbalance_assessment.recommendation"), "files": F.concat_ws(",", *files), "stamped": stamp,
    }
    return report.select(F.inline(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("value")) for n, v in fields.items()])))


@query("""select 'lineitem' as name, 'The table lacks [''d'', ''flag'', ''p'', ''q'', ''t''], which its contract names.' as fault, count(*) as rows from lineitem
    union all select 'bands', null, count(*) from lineitem union all select 'clash', 'Columns differ by case only: ''q'', ''Q''', count(*) from lineitem""")
def schema_errors(spark, sf_dir):
    """What the schema check says of a table that lacks columns, of one that fits, and of one with names that differ by case."""
    lines = band_lines(spark, sf_dir)
    names = {"lineitem": table(spark, sf_dir, "lineitem"), "bands": lines, "clash": lines.select(*lines.columns, F.lit(1).alias("Q"))}

    def told(name, df):
        try:
            fault = quality.check_columns(df, LINES)
        except ValueError as error:
            fault = str(error)
        return df.agg(F.lit(name).alias("name"), F.lit(fault).cast("string").alias("fault"), F.count(F.lit(1)).alias("rows"))

    return reduce(DataFrame.unionByName, [told(name, df) for name, df in names.items()])


@query("""select 'orders' as name, '{"rows":' || count(*) || ',"feature_columns":["o_custkey","o_totalprice"]}' as payload, 'o_custkey,o_totalprice' as features from orders
    union all select 'customer', '{"rows":' || count(*) || '}', 'q,p,d,t' from customer union all select 'missing', '{}', 'q,p,d,t' from region where r_regionkey = 0
    union all select 'late', '{}', 'q,p,d,t' from region where r_regionkey = 0""")
def ordered_documents(spark, sf_dir):
    """Documents read in order up to the first missing one, and the features that each names, or the raw columns."""
    folder = scratch(spark)
    size = lambda name: table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("rows"))
    made = {"orders": size("orders").withColumn("feature_columns", F.array(F.lit("o_custkey"), F.lit("o_totalprice"))), "customer": size("customer"), "late": size("region")}
    for name, row in made.items():
        documents.write_document(row, f"{folder}/{name}.json")
    texts = documents.read_documents_in_order(spark, {n: f"{folder}/{n}.json" for n in ("orders", "customer", "missing", "late")})
    rows = [(n, t, ",".join(features_or_default(spark.createDataFrame([(t,)], "payload string"), LINES.numeric))) for n, t in texts.items()]
    return spark.createDataFrame(rows, "name string, payload string, features string").withColumn("payload", F.regexp_replace("payload", "\\s", ""))


_VALID = "q is not null and p is not null and d is not null and t is not null"


def _small_model(spark, sf_dir):
    lines = band_lines(spark, sf_dir).drop(*KEY)
    return train_forest(lines, list(LINES.numeric), LINES.target, BASELINE | {"n_estimators": 10, "max_depth": 5}, partitions=8)


@query(f"""with {DIRTY_SQL}, a as (select l_linenumber > 3 as second, count(*) filter ({_VALID}) as predicted, count(*) filter (not ({_VALID})) as quarantined from flagged group by 1)
    select cast(second as integer) as batch, predicted, quarantined from a""")
def stream_scoring(spark, sf_dir):
    """Files that arrive twice, each time scored by a run that ends when it has read all; a third run adds nothing."""
    folder, lines = scratch(spark), dirty_lines(spark, sf_dir)
    model = _small_model(spark, sf_dir)
    for arrival in ("l_linenumber <= 3", "l_linenumber > 3", None):
        if arrival:
            rows = lines.filter(arrival).write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False)
            rows.option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{folder}/in")
        score_stream(read_stream(spark, f"{folder}/in", lines.columns), model, LINES, f"{folder}/out", f"{folder}/progress").awaitTermination()
    count = lambda part, name: spark.read.parquet(f"{folder}/out/{part}").groupBy("batch").agg(F.count(F.lit(1)).alias(name))
    return count("predictions", "predicted").join(count("quarantine", "quarantined"), "batch")


@query(f"""with {DIRTY_SQL}, c as (select count(*) as rows, count(*) filter (not ({_VALID})) as rows_at_fault, {_cells_sql("{c} is null")} as cells from flagged)
    select unnest(['counted', 'rejected']) as source, rows, rows_at_fault, cells from c""")
def reject_account(spark, sf_dir):
    """The account of a dirty batch: counted by itself, and as the batch is rejected by the pass that scores it."""
    rows = quality.read_missing_tokens(dirty_lines(spark, sf_dir))
    counted = scoring.reject_account(rows, LINES).select(F.lit("counted").alias("source"), "rows", "rows_at_fault", F.to_json("cells").alias("cells"))
    try:
        scoring.write_scored(rows, _small_model(spark, sf_dir), LINES, scratch(spark))
    except scoring.BatchRejected as error:
        account = error.account
    told = [("rejected", account["rows"], account["rows_at_fault"], json.dumps(account["cells"], separators=(",", ":")))]
    return counted.unionByName(spark.createDataFrame(told, "source string, rows bigint, rows_at_fault bigint, cells string"))
