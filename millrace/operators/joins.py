"""Joins beyond the built-in equi join: existence, band, temporal, cogroup.

Plain equi joins stay ``df.join``: adaptive execution picks the strategy and
splits skewed partitions.  What is here is rewritten so that no step lists all
pairs of a group when the result does not ask for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import By, Running, running
from millrace.sizing import small_side


def exists_flag(df: DataFrame, other: DataFrame, key: str, other_key: str, out: str) -> DataFrame:
    """Add a boolean column: does ``other`` hold this key?  Rows are not repeated."""
    found = other.select(F.col(other_key).alias("__k")).distinct().withColumn(out, F.lit(True))
    joined = df.join(found, F.col(key) == F.col("__k"), "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(False))).drop("__k")


def semi_where_sum_exceeds(
    left: DataFrame, left_value: Column, right: DataFrame, right_value: Column, bound: float
) -> DataFrame:
    """``LEFT SEMI JOIN .. ON left_value + right_value > bound``.

    Some right row satisfies the condition exactly when the largest one does,
    so the right side shrinks to one row and nothing is compared pairwise.
    """
    top = right.agg(F.max(right_value).alias("__top"))
    return (
        left.crossJoin(F.broadcast(top))
        .where(left_value + F.col("__top") > bound)
        .drop("__top")
    )


def semi_if_any(left: DataFrame, right: DataFrame) -> DataFrame:
    """``LEFT SEMI JOIN .. ON 1 = 1``: all of ``left`` if ``right`` has a row."""
    any_row = right.limit(1).select(F.lit(1).alias("__any"))
    return left.crossJoin(F.broadcast(any_row)).drop("__any")


def pair_with_dimension(
    left: DataFrame, right: DataFrame, pair: Sequence[Column] | None = None
) -> DataFrame:
    """Cartesian product with a dimension, then an optional expression per pair.

    A right side under the broadcast bound is shipped to every task; a larger
    one goes through Spark's partitioned product.
    """
    product = left.crossJoin(small_side(right))
    return product.select(*pair) if pair is not None else product


def band_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
) -> DataFrame:
    """Rows with ``right_time + lower <= left_time <= right_time + upper``.

    Both bounds are inclusive and the key columns, named alike on both sides,
    must be equal.  The time axis is cut into buckets as wide as the band: a
    right row sits in one bucket and a left row visits the (at most two, or
    three at a boundary) buckets that can match, so the shuffle key is
    (key, bucket) and a hot key spreads over time.
    """
    width = max(1, upper_seconds - lower_seconds) * 1_000_000
    right_micros = F.unix_micros(F.col(right_time).cast("timestamp"))
    left_micros = F.unix_micros(F.col(left_time).cast("timestamp"))
    lo, hi = lower_seconds * 1_000_000, upper_seconds * 1_000_000

    r = right.withColumns({"__rt": right_micros, "__b": F.floor(right_micros / width)})
    l = left.withColumns(
        {
            "__lt": left_micros,
            "__b": F.explode(
                F.sequence(F.floor((left_micros - hi) / width), F.floor((left_micros - lo) / width))
            ),
        }
    )
    renamed = r
    for k in [*keys, "__b"]:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    condition = F.col("__b") == F.col("__r___b")
    for k in keys:
        condition &= F.col(k) == F.col(f"__r_{k}")
    condition &= F.col("__lt").between(F.col("__rt") + lo, F.col("__rt") + hi)
    joined = l.join(renamed, condition, "inner")
    return joined.drop("__b", "__lt", "__rt", "__r___b", *[f"__r_{k}" for k in keys])


def latest_before(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    tie: str,
) -> DataFrame:
    """As-of join: for each left row the latest right row at or before its time.

    Both sides become one ordered history per key and the right columns are
    carried forward, so each row is visited once; ``tie`` orders left rows of
    the same time.  Right rows come before left rows at the same time; of right
    rows with the same time the largest in ``take`` (in its order) is the latest.
    """
    carried = F.struct(*[F.col(c) for c in take])
    settled = right.groupBy(*keys, right_time).agg(F.max(carried).alias("__right"))
    left_cols = [c for c in left.columns if c not in keys]
    l = left.select(
        *keys,
        F.col(left_time).alias("__t"),
        F.lit(1).alias("__side"),
        F.col(tie).cast("bigint").alias("__tie"),
        F.struct(*[F.col(c) for c in left_cols]).alias("__left"),
    )
    r = settled.select(
        *keys,
        F.col(right_time).alias("__t"),
        F.lit(0).alias("__side"),
        F.lit(0).cast("bigint").alias("__tie"),
        "__right",
    )
    history = l.unionByName(r, allowMissingColumns=True)
    filled = running(
        history,
        keys,
        [By("__t"), By("__side"), By("__tie")],
        [Running("__seen", "last", F.col("__right"))],
    )
    return filled.where("__side = 1").select(
        *keys,
        *[F.col(f"__left.{c}").alias(c) for c in left_cols],
        *[F.col(f"__seen.{c}").alias(c) for c in take],
    )


def window_join_totals(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_aggs: Sequence[Column],
    right_aggs: Sequence[Column],
) -> DataFrame:
    """Join of two sides on (window, key) reduced to per-side totals.

    Each side is aggregated before the join, so a window with n left and m
    right rows costs n + m, not n * m.  Pair counts and sums over pairs follow
    from the totals (``n * m``, ``sum * m``).
    """
    l = left.groupBy(*keys).agg(*left_aggs)
    r = right.groupBy(*keys).agg(*right_aggs)
    return l.join(r, list(keys), "inner")


def cogroup_totals(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_aggs: Sequence[Column],
    right_aggs: Sequence[Column],
) -> DataFrame:
    """CoGroup with combinable folds: one row per key found on either side."""
    l = left.groupBy(key).agg(*left_aggs)
    r = right.groupBy(key).agg(*right_aggs)
    return l.join(r, key, "full")


def cogroup_apply(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """CoGroup with an arbitrary function.

    Both groups of a key are held by one Python worker: use it only where the
    key bounds its rows, and ``cogroup_totals`` otherwise.
    """
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(fn, schema)


def enrich_batches(
    df: DataFrame,
    key: str,
    fetch: Callable[[list], dict],
    out: str,
    out_type: str,
    capacity: int = 8,
    chunk_rows: int = 256,
    timeout_seconds: float = 30.0,
) -> DataFrame:
    """Enrich rows from an external lookup with bounded concurrency.

    Per partition up to ``capacity`` requests of ``chunk_rows`` distinct keys
    are in flight; a request over the timeout fails its task, and Spark retries
    it.  ``fetch(keys) -> {key: value}`` runs on the executors; absent keys give
    NULL.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=capacity) as pool:
            for pdf in batches:
                wanted = pdf[key].dropna().unique().tolist()
                parts = [wanted[i : i + chunk_rows] for i in range(0, len(wanted), chunk_rows)]
                found: dict = {}
                for future in [pool.submit(fetch, p) for p in parts]:
                    found.update(future.result(timeout=timeout_seconds))
                yield pdf.assign(**{out: pdf[key].map(found)})

    return df.mapInPandas(run, f"{schema}, `{out}` {out_type}")


def not_in(df: DataFrame, key: Column, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key ..)`` with SQL's NULL rules, as a shuffle join.

    Nothing qualifies if ``other`` holds a NULL, and a NULL key qualifies only
    if ``other`` is empty.  Those two facts are one aggregated row; the rest is
    a plain anti join, where Spark's own null-aware form would have to ship
    ``other`` whole to every task.
    """
    facts = other.agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(F.col(other_key).isNull()).alias("__nulls")
    )
    listed = other.select(F.col(other_key).alias("__listed")).distinct()
    return (
        df.withColumn("__key", key)
        .join(listed, F.col("__key") == F.col("__listed"), "left_anti")
        .crossJoin(F.broadcast(facts))
        .where(
            (F.col("__rows") == 0) | ((F.col("__nulls") == 0) & F.col("__key").isNotNull())
        )
        .drop("__key", "__rows", "__nulls")
    )
