"""Saved models and the table that says how to feed them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.models.forest import model_features

REGISTRY = "models.parquet"
ENTRY = "name string, path string, feature_mode string, features array<string>, class_mapping map<string,bigint>"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_entry(
    name: str, model: PipelineModel, path: str, feature_mode: str, labels: Mapping[str, int]
) -> tuple:
    """Registry row: the features are those the model was trained on, in their order."""
    return name, path, feature_mode, model_features(model), dict(labels)


def write_registry(spark: SparkSession, entries: Sequence[tuple], folder: str) -> None:
    spark.createDataFrame(list(entries), ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{REGISTRY}")


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{REGISTRY}")


def find_model(registry: DataFrame, name: str):
    """Registry row of a model by name."""
    row = registry.filter(F.col("name") == name).first()
    if row is None:
        raise KeyError(f"No model named {name!r}")
    return row


def features_or_default(payload: DataFrame, default: Sequence[str]) -> list[str]:
    """Feature list of a metrics document, or the raw columns when it has none."""
    text = F.from_json(F.get_json_object("payload", "$.feature_columns"), "array<string>")
    listed = payload.select(text.alias("features")).first()["features"]
    return list(listed) if listed else list(default)
