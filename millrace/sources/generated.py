"""Generated and in-memory sources."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows(spark: SparkSession, data: Sequence, schema: str) -> DataFrame:
    """Literal rows with a declared schema; meant for small dimensions."""
    return spark.createDataFrame(list(data), schema)


def from_pandas(spark: SparkSession, pdf: pd.DataFrame, schema: str) -> DataFrame:
    """A pandas frame as a table, sent as Arrow batches."""
    return spark.createDataFrame(pdf, schema)


def to_pandas(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """A small result as a pandas frame; more rows than the bound is an error.

    The rows are fetched as Arrow batches to the driver, which is why the bound
    is checked with one row too many instead of trusting the caller.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"more than {max_rows} rows for the driver")
    return pdf


def number_sequence(spark: SparkSession, start: int, end: int, splits: int | None = None) -> DataFrame:
    """Longs from ``start`` to ``end``, both included, in contiguous even splits."""
    return spark.range(start, end + 1, 1, splits)


def random_rows(spark: SparkSession, schema: str, n: int, seed: int = 7) -> DataFrame:
    """``n`` random rows for a declared schema, generated where they are used."""
    fields = T._parse_datatype_string(schema).fields
    columns = []
    for i, f in enumerate(fields):
        draw = F.xxhash64(F.col("id"), F.lit(seed + i))
        kind = f.dataType
        if isinstance(kind, T.StringType):
            value = F.md5(draw.cast("string"))
        elif isinstance(kind, T.BooleanType):
            value = F.pmod(draw, F.lit(2)) == 1
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            value = (F.pmod(draw, F.lit(1_000_000)) / 1_000_000).cast(kind)
        elif isinstance(kind, T.TimestampType):
            value = F.timestamp_seconds(F.pmod(draw, F.lit(2_000_000_000)))
        else:
            value = F.pmod(draw, F.lit(100)).cast(kind)
        columns.append(value.alias(f.name))
    return spark.range(n).select(*columns)
