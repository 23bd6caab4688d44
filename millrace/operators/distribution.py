"""Explicit data layout: custom partitioners, clustering, pre-keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_by_id(df: DataFrame, target: Column, n: int) -> DataFrame:
    """Send each row to the partition number its ``target`` column names."""
    return df.withColumn("__to", target.cast("int")).repartitionById(n, F.col("__to")).drop("__to")


def cluster_by(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Hash-distribute by the keys, then sort inside each partition."""
    spread = df.repartition(n, *keys) if n else df.repartition(*keys)
    return spread.sortWithinPartitions(*keys)


def save_keyed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write a table bucketed and sorted by key; later keyed work needs no shuffle.

    Rows are shuffled to their bucket first, so each bucket is one file rather
    than one file per writing task.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Round-robin redistribution, adaptively sized when ``n`` is not given."""
    return df.repartition(n) if n else df.hint("rebalance")


def executed_plan(df: DataFrame) -> str:
    """Text of the physical plan, for plan checks."""
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df: DataFrame, mode: str) -> str:
    """Explain text in one mode: simple, extended, codegen, cost or formatted."""
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def to_every_partition(df: DataFrame, n: int) -> DataFrame:
    """Broadcast layout: all rows in each of ``n`` partitions; for small tables."""
    copies = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return partition_by_id(copies, F.col("__copy"), n).drop("__copy")
