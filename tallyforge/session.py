"""Session set-up, keeping an intermediate result, and spreading a narrow scan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tallyforge", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Session with adaptive execution on; master and sizes come from the cluster or ``conf``."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # HotSpot leaves larger methods uncompiled; Spark then splits wide projections instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in {**defaults, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's checkpoint folder; a local test session gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)


def spread(df: DataFrame) -> DataFrame:
    """A scanned table for costly expressions: its rows are dealt out when the scan has fewer splits than there are cores.

    One large row group would otherwise be worked on by one core. A table with enough splits is left as it is, so
    nothing is moved at scale. Plans that exchange rows already are left alone too.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in plan or "Streaming" in plan or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def settle(df: DataFrame) -> DataFrame:
    """Compute an aggregated table once, into the shared folder, and read it back.

    It never passes the driver. Its size in bytes is then known, and Spark itself decides by its broadcast threshold
    how to join it. The files go when the application ends.
    """
    ensure_checkpoint_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{context.getCheckpointDir()}/settled-{uuid.uuid4().hex}")
    df.write.parquet(folder.toString())
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder.toString())
