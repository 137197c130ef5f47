"""Score new rows: check, derive features, predict, name the classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyforge.functions.labels import decode_label, invert_labels
from tallyforge.functions.parsing import select_once, strict_double
from tallyforge.models.forest import model_features
from tallyforge.operators.features import engineer
from tallyforge.session import spread
from tallyforge.sources.tables import select_required
from tallyforge.spec import TableSpec

RAW = "_raw"


def coerce_inputs(df: DataFrame, spec: TableSpec, keep_raw: bool = False) -> DataFrame:
    """The raw feature columns as numbers; ``keep_raw`` carries the cells as they came in a struct."""
    fields = {f.name: f.dataType for f in select_required(df, spec.numeric).schema.fields}
    raw = [F.struct(*spec.numeric).alias(RAW)] if keep_raw else []
    return select_once(df, [*raw, *[strict_double(F.col(c), fields[c]).alias(c) for c in spec.numeric]])


def _invalid(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def split_valid(inputs: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring, and the quarantined rest."""
    return inputs.filter(~_invalid(spec.numeric)), inputs.filter(_invalid(spec.numeric))


class BatchRejected(ValueError):
    """A batch with cells that are missing or no number; ``account`` says how many rows, and how many cells of each column."""

    def __init__(self, account: Mapping[str, object]):
        self.account = dict(account)
        cells = ", ".join(f"{c}: {n}" for c, n in self.account["cells"].items() if n)
        super().__init__(f"{self.account['rows_at_fault']} of {self.account['rows']} rows cannot be scored ({cells}).")


def _faults(spec: TableSpec) -> list[Column]:
    """What is wrong with coerced inputs: rows, rows at fault, and cells at fault of each column."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(_invalid(spec.numeric)).alias("rows_at_fault"), *[F.count_if(F.col(c).isNull()).alias(c) for c in spec.numeric]]


def reject_account(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row for a batch: ``rows``, ``rows_at_fault``, and as ``cells`` the cells at fault of each column."""
    cells = F.map_from_arrays(F.array(*[F.lit(c) for c in spec.numeric]), F.array(*[F.col(c) for c in spec.numeric]))
    return coerce_inputs(spread(df), spec).agg(*_faults(spec)).select("rows", "rows_at_fault", cells.alias("cells"))


def prepare_inputs(df: DataFrame, spec: TableSpec, feature_mode: str, on_invalid: str = "reject", keep_raw: bool = False) -> DataFrame:
    """Numbers and derived features of a batch.

    With ``reject`` the job that reads the result fails at the first cell that is missing or no number, in the same
    pass; ``write_scored`` counts all of them instead. ``quarantine`` leaves those rows out.
    """
    inputs = coerce_inputs(df, spec, keep_raw)
    if on_invalid == "reject":
        at_fault = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in spec.numeric])
        stop = F.raise_error(F.concat(F.lit("A row to score has a cell that is missing or no number: "), at_fault)).cast("boolean")
        valid = inputs.filter(F.when(_invalid(spec.numeric), stop).otherwise(True))
    else:
        valid, _ = split_valid(inputs, spec)
    return engineer(valid, spec) if feature_mode == "engineered" else valid


def probability_columns(vector: str, names: Mapping[int, str]) -> list[Column]:
    """``prob_<LABEL>`` by ascending class id; a class the model lacks has 0."""
    values = vector_to_array(vector)
    return [F.coalesce(F.get(values, i), F.lit(0.0)).alias(f"prob_{names[i]}") for i in sorted(names)]


def predict(inputs: DataFrame, model: PipelineModel, names: Mapping[int, str]) -> DataFrame:
    """Input columns plus class id, class name and probabilities."""
    scored = model.transform(inputs)
    code = F.col("prediction").cast("bigint")
    return scored.select(
        *inputs.columns, code.alias("predicted_class_id"), decode_label(code, names).alias("predicted_class"),
        *probability_columns("probability", names),
    )


def _scored(inputs: DataFrame, model: PipelineModel, spec: TableSpec, class_mapping: Mapping[str, int] | None) -> DataFrame:
    """Raw columns and predictions of prepared inputs that carry the cells as they came."""
    wanted = select_required(inputs, [RAW, *model_features(model)])
    predicted = predict(wanted, model, invert_labels(class_mapping, spec.labels))
    outputs = [c for c in predicted.columns if c not in wanted.columns]
    return predicted.select(f"{RAW}.*", *outputs)


def score(
    df: DataFrame, model: PipelineModel, spec: TableSpec, feature_mode: str = "clean", on_invalid: str = "reject",
    class_mapping: Mapping[str, int] | None = None,
) -> DataFrame:
    """Raw columns as they came in and the prediction columns, without the derived features."""
    return _scored(prepare_inputs(spread(df), spec, feature_mode, on_invalid, keep_raw=True), model, spec, class_mapping)


def write_scored(
    df: DataFrame, model: PipelineModel, spec: TableSpec, path: str, feature_mode: str = "clean", class_mapping: Mapping[str, int] | None = None
) -> dict[str, object]:
    """Score a batch into a folder, or reject all of it: the faults of every row are counted while it is written, in the same pass.

    Raises ``BatchRejected`` with the whole account and removes the folder when there is any fault; returns the account otherwise.
    """
    seen = Observation("faults")
    inputs = coerce_inputs(spread(df), spec, keep_raw=True).observe(seen, *_faults(spec))
    valid, _ = split_valid(inputs, spec)
    _scored(engineer(valid, spec) if feature_mode == "engineered" else valid, model, spec, class_mapping).write.parquet(path)
    counts = dict(seen.get)
    account = {"rows": counts.pop("rows"), "rows_at_fault": counts.pop("rows_at_fault"), "cells": counts}
    if account["rows_at_fault"]:
        folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        raise BatchRejected(account)
    return account
