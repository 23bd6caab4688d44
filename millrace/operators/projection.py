"""Column operations with strict naming rules."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Append columns; a name that exists already is an error."""
    clash = sorted(set(columns) & set(df.columns))
    if clash:
        raise ValueError(f"columns already exist: {', '.join(clash)}")
    return df.withColumns(dict(columns))


def add_or_replace_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace by name in place, else append; all expressions see the old columns."""
    return df.withColumns(dict(columns))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in place; an unknown name is an error."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; an unknown name is an error."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return df.drop(*names)


def project_positions(df: DataFrame, *positions: int) -> DataFrame:
    """Pick and reorder columns by 0-based position."""
    return df.select(*[df.columns[i] for i in positions])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """All columns whose whole name matches the pattern, in table order."""
    return df.select(*[c for c in df.columns if re.fullmatch(pattern, c)])


def coalesce_text(*columns: Column) -> Column:
    """First non-null of mixed types, with STRING as the common type."""
    return F.coalesce(*[c.cast("string") for c in columns])


def word_rows(df: DataFrame, text: str, out: str, *keep: str) -> DataFrame:
    """One row per lower-cased word; anything but letters, digits and ``_`` separates.

    Empty pieces are filtered after the explode, inside generated code.
    """
    pieces = F.explode(F.split(F.lower(F.col(text)), r"\W+")).alias(out)
    return df.select(*keep, pieces).where(F.col(out) != "")


class SideOutput:
    """A named extra output of a split."""

    def __init__(self, name: str):
        if not name:
            raise ValueError("a side output needs a non-empty name")
        self.name = name


def split_rows(df: DataFrame, rules: Mapping[SideOutput, Column]) -> "SplitRows":
    """Tag each row once with the first rule it satisfies; the rest is ``main``."""
    tag = F.lit("main")
    for output, condition in reversed(list(rules.items())):
        tag = F.when(condition, F.lit(output.name)).otherwise(tag)
    return SplitRows(df.withColumn("__tag", tag), {o.name for o in rules})


class SplitRows:
    """The tagged frame; outputs are filters of it, so one pass can feed all."""

    def __init__(self, tagged: DataFrame, names: set[str]):
        self.tagged = tagged
        self._names = names

    @property
    def main(self) -> DataFrame:
        return self.tagged.where("__tag = 'main'").drop("__tag")

    def side(self, output: SideOutput) -> DataFrame:
        if output.name not in self._names:
            raise KeyError(f"no such side output: {output.name}")
        return self.tagged.where(F.col("__tag") == output.name).drop("__tag")
