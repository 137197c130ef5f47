"""Tables between steps, kept in the folder that all executors share, and the package on the executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql.types import DataType, StructField, StructType

from tallyforge.session import ensure_checkpoint_dir

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, target = tempfile.mkstemp(prefix="tallyforge-", suffix=".zip")
    with os.fdopen(handle, "wb") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)  # Spark serves it from here to all executors
    atexit.register(lambda: os.path.exists(target) and os.unlink(target))
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession, rows: int = 512, size: str = "8m") -> None:
    """Bound what a Python worker holds at once: rows and bytes of one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def extended(schema: StructType, **more: str) -> StructType:
    """``schema`` with more columns, as name and type text."""
    return StructType([*schema.fields, *(StructField(name, DataType.fromDDL(kind)) for name, kind in more.items())])


class Scratch:
    """Tables written once to the shared folder; a lost executor costs no recomputation of them.

    ``drop`` removes one early, the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.root = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
        self._fs(self.root).deleteOnExit(self._path(self.root))
        self._paths: dict[int, str] = {}

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def folder(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def files(self, amount: int, each: int) -> int:
        """How many files that many rows or bytes fill, ``each`` in one, but one for each core at least."""
        return max(self.spark.sparkContext.defaultParallelism, -(-amount // each))

    def save(self, df: DataFrame, files: int | None = None) -> DataFrame:
        """``files``: no more than these are written, by as many tasks. On a local file system each file costs
        three processes that the executor starts (Hadoop sets its mode by ``chmod``), more than a small partition itself."""
        path = self.folder()
        (df if files is None else df.coalesce(files)).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self._paths.pop(id(df), None)
        if path is not None:
            self._fs(path).delete(self._path(path), True)
