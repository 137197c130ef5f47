"""JSON documents: one-row tables written and read as indented JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_document(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """Each row as indented JSON text; keys are strings and every value is a JSON type."""
    options = {"pretty": "true", "ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def write_document(row: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """Write a one-row table as one JSON document; missing folders are made."""
    json_document(row, keep_nulls).coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON document as a one-row table; raises when it is missing."""
    reader = spark.read.option("multiLine", True)
    try:
        return (reader.schema(schema) if schema is not None else reader).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Missing JSON document: {path}") from error
        raise


def read_document_text(spark: SparkSession, path: str) -> DataFrame:
    """JSON document as text in a column ``payload``; raises when it is missing."""
    try:
        return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Missing JSON document: {path}") from error
        raise


def read_documents_in_order(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """Documents as text by name; the first missing one leaves the later ones empty."""
    texts = dict.fromkeys(paths, "{}")
    for name, path in paths.items():
        try:
            texts[name] = read_document_text(spark, path).first()["payload"]
        except FileNotFoundError:
            break
    return texts
