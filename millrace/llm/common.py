"""Column helpers and shared-table helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import new_folder
from millrace.sizing import BROADCAST_BYTES, estimated_bytes, limit_bytes

UNKNOWN_BYTES = 1 << 60
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character left alone.

    One byte per character means plain ASCII, where ``lower`` does the same faster.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def whole_text(docs: DataFrame, text_col: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def keep_table(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` under the session's shared folder and read it back.

    Later steps restart from these files when an executor is lost.
    """
    spark = df.sparkSession
    folder = new_folder(spark, f"llm-{label}")
    df.write.option("compression", compression).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions a shuffle has by the session's setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def input_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Catalyst's estimate of the size of ``df``; where it knows none, the texts' bytes by a job."""
    size = estimated_bytes(df)
    if size < UNKNOWN_BYTES:
        return size
    return df.agg(F.coalesce(F.sum(F.octet_length(df[text_col].cast("string"))), F.lit(0))).first()[0]


def if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast when ``rows`` (counted) times ``row_bytes`` is under the bound.

    Over the bound it stays a shuffle join with adaptive skew splitting: same rows.
    """
    fits = rows * row_bytes <= limit_bytes(df.sparkSession, BROADCAST_BYTES)
    return F.broadcast(df) if fits else df
