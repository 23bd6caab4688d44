"""Savepoints: copies of a finished run's checkpoint that another run can start from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def kept_copy(spark: SparkSession, checkpoint: str, savepoint: str) -> str:
    """Copy the checkpoint of a query that is not running; state, offsets and commits."""
    source, at = _place(spark, checkpoint)
    target, to = _place(spark, savepoint)
    copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    if not copy(source, at, target, to, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {checkpoint} to {savepoint}")
    return savepoint


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Retention "delete on success": a checkpoint that no run needs any more."""
    system, at = _place(spark, folder)
    if not system.delete(at, True):
        raise OSError(f"cannot delete {folder}")


def exists(spark: SparkSession, folder: str) -> bool:
    system, at = _place(spark, folder)
    return system.exists(at)
