"""Batch scoring run on a stream of CSV files; rows are scored on their own, so no state is kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyforge.functions.labels import invert_labels
from tallyforge.models.scoring import coerce_inputs, predict, split_valid
from tallyforge.operators.features import engineer
from tallyforge.operators.quality import read_missing_tokens
from tallyforge.sources.tables import text_schema
from tallyforge.spec import TableSpec


def read_stream(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """CSV files of a folder as text; ``columns`` is their header, which every file must have."""
    options = {"header": True, "escape": '"', "enforceSchema": False}
    return read_missing_tokens(spark.readStream.schema(text_schema(columns)).options(**options).csv(folder))


def score_stream(
    rows: DataFrame, model: PipelineModel, spec: TableSpec, output: str, checkpoint: str, feature_mode: str = "clean",
    class_mapping: Mapping[str, int] | None = None,
) -> StreamingQuery:
    """Write predictions and quarantined rows of each micro-batch to its own folder.

    A batch that is run again after a failure overwrites its folder, so no row is written twice.
    """
    names = invert_labels(class_mapping, spec.labels)

    def write(batch: DataFrame, batch_id: int) -> None:
        valid, invalid = split_valid(coerce_inputs(batch, spec), spec)
        inputs = engineer(valid, spec) if feature_mode == "engineered" else valid
        predict(inputs, model, names).write.mode("overwrite").parquet(f"{output}/predictions/batch={batch_id}")
        invalid.write.mode("overwrite").parquet(f"{output}/quarantine/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
