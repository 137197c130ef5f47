"""Score a CSV of raw columns with a registered model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.models.registry import find_model, load_model, read_registry
from tallyforge.models.scoring import score
from tallyforge.sources.tables import read_delimited, select_required
from tallyforge.spec import SKY_OBJECTS, TableSpec


def score_file(
    spark: SparkSession, path: str, models: str, name: str = "tuned", spec: TableSpec = SKY_OBJECTS, on_invalid: str = "reject"
) -> DataFrame:
    """Raw columns of the file with class id, class name and probabilities."""
    entry = find_model(read_registry(spark, models), name)
    rows = select_required(read_delimited(spark, path), spec.numeric)
    return score(rows, load_model(entry["path"]), spec, entry["feature_mode"], on_invalid, entry["class_mapping"])
