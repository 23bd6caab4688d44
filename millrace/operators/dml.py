"""Row changes on file tables, as copy-on-write rewrites.

Parquet tables cannot delete rows in place.  A change reads the table, writes
the surviving rows as a new generation and leaves the old one untouched, so a
lost executor or a failed job never harms the data readers see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import new_folder


def work_database(spark: SparkSession) -> str:
    """Create a database whose tables live under the shared folder."""
    name = f"millrace_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    return name


def rows_kept(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows a ``DELETE WHERE predicate`` keeps: FALSE and NULL both keep a row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_where(df: DataFrame, predicate: Column, target: str) -> tuple[DataFrame, int]:
    """Write the surviving rows to ``target``; return them and the deleted count.

    Both counts are observed during the one write, with no second scan.
    """
    seen = Observation()
    gone = F.coalesce(predicate, F.lit(False))
    marked = df.withColumn("__gone", gone).observe(
        seen, F.count_if(F.col("__gone")).alias("deleted")
    )
    marked.where(~F.col("__gone")).drop("__gone").write.mode("errorifexists").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target), seen.get["deleted"]


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions ``df`` has rows for."""
    key = "spark.sql.sources.partitionOverwriteMode"
    conf = df.sparkSession.conf
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)


def load_into_partition(
    spark: SparkSession, table: str, files: str, fmt: str, partition: dict[str, str], overwrite: bool
) -> None:
    """Read files with the table's schema and add them to (or replace) a partition."""
    schema = spark.table(table).schema
    data_fields = [f for f in schema.fields if f.name not in partition]
    data = spark.read.format(fmt).schema(type(schema)(data_fields)).load(files)
    full = data.withColumns(
        {k: F.lit(v).cast(schema[k].dataType) for k, v in partition.items()}
    ).select(*schema.names)
    if overwrite:
        overwrite_partitions(full, table)
    else:
        full.write.insertInto(table)
