"""Shared folders for checkpoints, sink tables and cut lineage.

On a cluster every path must be one that all executors see, so it comes from the
``spark.checkpoint.dir`` setting of the session. A folder of our own is made only where that
setting is missing and Spark runs in local mode.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tidewatch-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; nothing is created."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to a shared parquet table and read it back, which cuts the lineage.

    Unlike a cache, the copy survives the loss of any executor, and readers of a few columns
    scan only those. With ``path`` an earlier copy there is replaced.
    """
    path = path or fresh_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, an execution removes its shuffle files when it ends, for steps that are executed
    once and written. Otherwise they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    files, hadoop_path = _hadoop(spark, path)
    return files.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written; nothing happens if there is none."""
    files, hadoop_path = _hadoop(spark, path)
    files.delete(hadoop_path, True)
