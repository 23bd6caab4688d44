"""Typed ingest of text columns with an error class per rejected value.

All checks are column expressions, so bad values are classified inside the scan
stage.  Blanks are never trimmed, unlike Spark's own text casts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error classes of the text parsers.
EMPTY_COLUMN = "EMPTY_COLUMN"
ORPHAN_SIGN = "NUMERIC_VALUE_ORPHAN_SIGN"
ILLEGAL_CHARACTER = "NUMERIC_VALUE_ILLEGAL_CHARACTER"
OVERFLOW_UNDERFLOW = "NUMERIC_VALUE_OVERFLOW_UNDERFLOW"
FORMAT_ERROR = "NUMERIC_VALUE_FORMAT_ERROR"
BOOLEAN_INVALID = "BOOLEAN_INVALID"

_WHOLE = ("tinyint", "smallint", "int", "bigint")
_REAL = ("float", "double")


def _whole_error(c: Column, dtype: str) -> Column:
    leading = F.regexp_extract(c, r"^(-?[0-9]+)", 1)
    return (
        F.when(F.length(c) == 0, EMPTY_COLUMN)
        .when(c == "-", ORPHAN_SIGN)
        .when((leading != "") & leading.try_cast(dtype).isNull(), OVERFLOW_UNDERFLOW)
        .when(~c.rlike(r"\A-?[0-9]+\z"), ILLEGAL_CHARACTER)
    )


def _real_error(c: Column, dtype: str) -> Column:
    return (
        F.when(F.length(c) == 0, EMPTY_COLUMN)
        .when(c.rlike(r"\A\s|\s\z"), ILLEGAL_CHARACTER)
        .when(c.try_cast(dtype).isNull(), FORMAT_ERROR)
    )


def _boolean_error(c: Column) -> Column:
    known = F.lower(c).isin("true", "1", "false", "0")
    return F.when(F.length(c) == 0, EMPTY_COLUMN).when(~known, BOOLEAN_INVALID)


def _date_error(c: Column) -> Column:
    return (
        F.when(F.length(c) == 0, EMPTY_COLUMN)
        .when(c.rlike(r"\A\s|\s\z"), ILLEGAL_CHARACTER)
        .when(
            ~c.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z") | c.try_cast("date").isNull(),
            FORMAT_ERROR,
        )
    )


def error_class(c: Column, dtype: str) -> Column:
    """Why the text is not a ``dtype`` value, or NULL if it is one (or is NULL)."""
    if dtype in _WHOLE:
        return _whole_error(c, dtype)
    if dtype in _REAL:
        return _real_error(c, dtype)
    if dtype == "boolean":
        return _boolean_error(c)
    if dtype == "date":
        return _date_error(c)
    raise ValueError(f"no text parser for type {dtype}")


def ingest(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace text columns by typed ones and add ``<name>_error`` for each."""
    errors = {f"{n}_error": error_class(F.col(n), t) for n, t in types.items()}
    checked = df.withColumns(errors)
    return checked.withColumns(
        {
            n: F.when(F.col(f"{n}_error").isNull(), F.col(n).try_cast(t))
            for n, t in types.items()
        }
    )


def good_and_bad(ingested: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows with no error, typed, and the quarantined rest with its error classes."""
    failed = F.lit(False)
    for n in types:
        failed |= F.col(f"{n}_error").isNotNull()
    good = ingested.where(~failed).drop(*[f"{n}_error" for n in types])
    return good, ingested.where(failed)
