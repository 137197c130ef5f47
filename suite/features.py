"""Derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.standins import BANDS_SQL, DIRTY_SQL, KEY, KEYS, LINES, band_lines, dirty_lines
from tallyforge.models.scoring import coerce_inputs, prepare_inputs, split_valid
from tallyforge.operators import features as ops
from tallyforge.operators.quality import clean_rows, read_missing_tokens

DIFFERENCES = "q - p as color_q_p, p - d as color_p_d, d - t as color_d_t, q - t as color_q_t"
STATISTICS = """(q + p + d + t) / 4 as band_mean,
    sqrt((power(q - (q + p + d + t) / 4, 2) + power(p - (q + p + d + t) / 4, 2) + power(d - (q + p + d + t) / 4, 2)
        + power(t - (q + p + d + t) / 4, 2)) / 3) as band_std,
    least(q, p, d, t) as band_min, greatest(q, p, d, t) as band_max, greatest(q, p, d, t) - least(q, p, d, t) as band_range"""
PRODUCTS = "t * (q - p) as t_color_q_p, t * (d - t) as t_color_d_t"


def _rounded(df, keep):
    return df.select(*keep, *[F.round(c, 5).alias(c) for c in df.columns if "_" in c and c not in keep])


def _sql(columns: str, source: str = BANDS_SQL, rows: str = "bands", keep: str = KEYS) -> str:
    return f"with {source} select {keep}, round(columns(* exclude ({keep})), 5) from (select {keep}, {columns} from {rows})"


@query(_sql(DIFFERENCES))
def pairwise_features(spark, sf_dir):
    return _rounded(ops.add_differences(band_lines(spark, sf_dir), LINES), KEY)


@query(_sql(STATISTICS))
def row_stats(spark, sf_dir):
    return _rounded(ops.add_band_statistics(band_lines(spark, sf_dir), LINES), KEY)


@query(_sql(PRODUCTS))
def interactions(spark, sf_dir):
    lines = ops.add_products(ops.add_differences(band_lines(spark, sf_dir), LINES), LINES)
    return _rounded(lines.select(*KEY, "t_color_q_p", "t_color_d_t"), KEY)


@query(_sql(f"{DIFFERENCES}, {STATISTICS}, {PRODUCTS}", DIRTY_SQL, "clean", "q, p, d, t, flag"))
def engineered_features(spark, sf_dir):
    clean = clean_rows(read_missing_tokens(dirty_lines(spark, sf_dir)), LINES)
    return _rounded(ops.engineer(clean, LINES), clean.columns)


VALID = "q is not null and p is not null and d is not null and t is not null"


@query(f"with {DIRTY_SQL}, good as (select * from flagged where {VALID}) "
       f"select q, p, d, t, round(columns(* exclude (q, p, d, t)), 5) from (select q, p, d, t, {DIFFERENCES}, {STATISTICS}, {PRODUCTS} from good)")
def scoring_input(spark, sf_dir):
    rows = read_missing_tokens(dirty_lines(spark, sf_dir))
    return _rounded(prepare_inputs(rows, LINES, "engineered", on_invalid="quarantine"), list(LINES.numeric))


@query(f"with {DIRTY_SQL} select q, p, d, t from flagged where not ({VALID})")
def scoring_quarantine(spark, sf_dir):
    rows = read_missing_tokens(dirty_lines(spark, sf_dir))
    return split_valid(coerce_inputs(rows, LINES), LINES)[1]
