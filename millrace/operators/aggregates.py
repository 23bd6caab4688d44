"""Aggregations that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import Running, running


def extreme_row(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], tie: Sequence[str], largest: bool = False
) -> DataFrame:
    """The whole row that is smallest (largest) by ``fields`` in order.

    Ties keep the row first in ``tie`` order, which stands for arrival order.
    One combinable aggregate, no sort.  For the largest, numeric fields are
    compared by their negation so that the tie order still runs upwards.
    """
    rank = F.struct(
        *[(-F.col(f) if largest else F.col(f)).alias(f"f{i}") for i, f in enumerate(fields)],
        *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
    )
    picked = F.min_by(F.struct(*[F.col(c) for c in df.columns]), rank).alias("__row")
    grouped = df.groupBy(*keys).agg(picked) if keys else df.agg(picked)
    return grouped.select("__row.*")


_HELD_ROWS = 100_000


def combine_then_reduce(
    df: DataFrame,
    keys: Sequence[str],
    schema: str,
    fold: Callable[[pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """Group reduce with an associative user fold, combined before the shuffle.

    ``fold`` takes rows of several keys and returns one row per key in
    ``schema``, and must accept its own output as input.  Each map task folds
    its batches first, so a hot key arrives as a few rows per task rather than
    as all of its rows.  After the shuffle a task folds sorted batches and
    releases every key that is complete, so neither side holds more than a
    bounded number of rows.
    """
    key_list = list(keys)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            held = fold(pdf if held is None else pd.concat([held, fold(pdf)], ignore_index=True))
            if len(held) > _HELD_ROWS:
                yield held
                held = None
        if held is not None:
            yield held

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            if pdf.empty:
                continue
            last = pdf[key_list].iloc[-1]
            folded = fold(pdf if held is None else pd.concat([held, pdf], ignore_index=True))
            same = (folded[key_list].eq(last) | (folded[key_list].isna() & last.isna())).all(axis=1)
            yield folded[~same]
            held = folded[same]
        if held is not None:
            yield held

    partial = df.mapInPandas(combine, schema)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(finish, schema)


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total, null and non-null count of each column: one pass, one row a column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"), *[F.count(c).alias(f"__n_{c}") for c in columns]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("__total").alias("total"),
            (F.col("__total") - F.col(f"__n_{c}")).alias("null_count"),
            F.col(f"__n_{c}").alias("non_null_count"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Value and count, ordered by value."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(value)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float]
) -> DataFrame:
    """Exact interpolated percentiles from running counts of distinct values.

    Rows are counted per (keys, value) first, with map-side combine; running
    counts then place each percentile between two values.  Unlike the built-in
    exact percentile, no task holds the distinct values of a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    placed = running(counts, keys, [value], [Running("__upto", "sum", F.col("__c"))])
    totals = counts.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    joined = placed.join(totals, list(keys)) if keys else placed.crossJoin(F.broadcast(totals))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("__upto") > rank, F.col(value)))

    columns = []
    for name, p in wanted.items():
        rank = F.lit(float(p)) * (F.col("__n") - 1)
        columns += [
            at(F.floor(rank)).alias(f"__lo_{name}"),
            at(F.ceil(rank)).alias(f"__hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"__part_{name}"),
        ]
    found = joined.groupBy(*keys).agg(*columns)
    return found.select(
        *keys,
        *[
            (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__part_{n}")).alias(n)
            for n in wanted
        ],
    )


def hash_sample(df: DataFrame, key: Column, parts: int, of: int) -> DataFrame:
    """A reproducible sample: rows whose key hashes into ``parts`` of ``of`` slots."""
    return df.where(F.pmod(key, F.lit(of)) < parts)


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]):
    """Attach side counters to a frame; they are read after its first action."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def distinct_pairs(n: Column, same_groups: Column) -> Column:
    """Ordered pairs of a group whose members differ: n^2 minus sum of squares."""
    return n * n - same_groups
