"""File tables: delimited text, lines, ORC, and the default path filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_INPUT_FORMAT = "org.apache.hadoop.mapreduce.lib.input.TextInputFormat"


def delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", comments: bool = False
) -> DataFrame:
    """Delimited text with a declared schema; ``#`` lines are skipped on request."""
    reader = spark.read.schema(schema).option("sep", sep)
    return (reader.option("comment", "#") if comments else reader).csv(path)


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", files: int | None = None, overwrite: bool = False
) -> None:
    """Delimited sink; without ``overwrite`` an existing target is an error."""
    out = df.coalesce(files) if files else df
    mode = "overwrite" if overwrite else "errorifexists"
    out.write.option("sep", sep).mode(mode).csv(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One STRING row per line; only a line feed ends a line."""
    return spark.read.option("lineSep", "\n").text(path)


def monitored_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a folder that keeps receiving files."""
    return spark.readStream.option("lineSep", "\n").text(path)


def visible_file(name: Column) -> Column:
    """Default file filter: hide names that start with ``.`` or ``_`` or hold ``_COPYING_``."""
    return ~(
        name.startswith(".") | name.startswith("_") | F.contains(name, F.lit("_COPYING_"))
    )


def only_visible(df: DataFrame) -> DataFrame:
    """Drop rows of files the default filter hides (Spark itself misses one case)."""
    return df.where(visible_file(F.col("_metadata.file_name")))


def hadoop_pairs(spark: SparkSession, path: str, input_format: str, key: str, value: str) -> DataFrame:
    """Any Hadoop input format as a table of text values, ``v``.

    Spark's own reader covers the text format without leaving the JVM.  Another
    format has no DataFrame source, so its values come as an RDD of pairs with a
    declared schema.
    """
    if input_format == TEXT_INPUT_FORMAT:
        return lines(spark, path).withColumnRenamed("value", "v")
    pairs = spark.sparkContext.newAPIHadoopFile(path, input_format, key, value)
    return spark.createDataFrame(pairs.map(lambda kv: (str(kv[1]),)), "v STRING")
