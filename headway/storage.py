"""Folders that driver and executors share, and tables written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _session_folder() -> str:
    """For a local session that names none, whose driver and executors are one process: a folder that goes when it ends."""
    path = tempfile.mkdtemp(prefix="headway-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``. Only a local session may lack that setting; a cluster must name it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _session_folder()
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/headway-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` as Parquet and read it back: lineage ends there, and any executor may be lost."""
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's own file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
