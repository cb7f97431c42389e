"""Session settings, the shared working folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that suit a cluster; partition counts and memory come from the deployment.
ENGINE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Taken from ``spark.checkpoint.dir``; only a local-mode session without the
    setting falls back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a table in the shared folder and continue from that table.

    The table survives lost executors and is read back by column, so later steps
    load only what they use.  It is removed when the session's JVM ends.
    """
    path = fresh_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, removed when the session's JVM ends."""
    text = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    files, path = _file_system(spark, text)
    files.deleteOnExit(path)
    return text


def path_exists(spark: SparkSession, text: str) -> bool:
    files, path = _file_system(spark, text)
    return files.exists(path)


def remove_path(spark: SparkSession, text: str) -> None:
    files, path = _file_system(spark, text)
    files.delete(path, True)


def stored_bytes(spark: SparkSession, text: str) -> int:
    """Bytes of all files below a path."""
    files, path = _file_system(spark, text)
    return files.getContentSummary(path).getLength()


def _file_system(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
