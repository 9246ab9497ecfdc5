"""Session defaults and the one place that decides where durable intermediates live."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # GFF attribute columns may repeat a key; the last value counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "lociframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; cluster settings win through spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where there is a single machine anyway.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so that several consumers read it and lost executors do not replay it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, compressed; shuffle files of its plan go when the table stands.

    Unlike after ``durable``, Spark plans with the size the table has, not with one estimated for its plan.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
