"""Scalar helpers whose meaning differs between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(text: Column, path: str, dtype: str = "string") -> Column:
    """Scalar at a JSON path; NULL if missing or not convertible."""
    return F.get_json_object(text, path).try_cast(dtype)


def json_update(text: Column, schema: str, field: str, value) -> Column:
    """Parse, replace one field by ``value(parsed)``, serialise again."""
    parsed = F.from_json(text, schema)
    return F.to_json(parsed.withField(field, value(parsed)))


def json_row(row: Column) -> Column:
    """Row to JSON text with NULL fields written out."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def charset_literal(hex_text: str, charset: str = "UTF-8") -> Column:
    """Text literal from its encoded bytes."""
    return F.decode(F.unhex(F.lit(hex_text)), charset)


def multiset(elements: Column) -> Column:
    """Element counts of an array, as a map."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(elements),
            lambda e: F.struct(e, F.size(F.filter(elements, lambda x: x == e))),
        )
    )


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` with NULL for a zero divisor."""
    return F.try_divide(a, b)


def in_band(numerator: Column, denominator: Column, low: Column, high: Column) -> Column:
    """Is the ratio within inclusive bounds?  NULL where the divisor is zero."""
    return F.try_divide(numerator, denominator).between(low, high)
