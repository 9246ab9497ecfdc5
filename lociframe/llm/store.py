"""Intermediate tables that outlive lost executors.

``written`` saves a frame as Parquet in the shared folder that ``spark.checkpoint.dir`` names and
returns a reader of the files, so the plan behind it is neither replayed nor run twice. Shuffle files
of the plan go when the table stands; ``emptied`` gives up the table itself once all its readers have run.
"""
from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table of its own under the checkpoint folder; the rows and columns stay the same."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def emptied(table: DataFrame) -> None:
    """Frees the files of a ``written`` table that nothing reads any more."""
    files = table.inputFiles()
    if files:
        nothing = table.sparkSession.range(0, numPartitions=1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])
        nothing.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def worker_cache() -> dict:
    """What a Python worker keeps between tasks (tokenizers, automata); holds one entry per kind."""
    return vars(sys.modules.setdefault("_lociframe_worker_cache", types.ModuleType("_lociframe_worker_cache")))
