"""Windows cut by data: a window ends once a key has moved further than ``delta`` since the last cut.

A key's rows have a distance, the sum of their steps so far; the first row sets the base.
The first later row further than ``delta`` from the base closes the window, belongs to it,
and is the next base.  Each cut depends on the cut before, yet no key is walked in one task:

1. distances and positions are running values, which split over time chunks;
2. a row's *next cut*, were it a base, is the first row beyond its distance plus ``delta``:
   rows and these targets are put on one axis and the answer is carried along it;
3. the cuts that start at the first row are found by pointer doubling: after k rounds the
   first 2^k of every key are known, so rounds grow with the logarithm of a key's cuts.

Rows that do not move can be no cut and take no part in steps 2 and 3.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import By, Running, keep_one, running, with_chunks, without_chunks
from millrace.scratch import written


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def _shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is never broadcast.

    The tables here have a row for most input rows, yet are so small as files that
    Spark's size test would send millions of rows to the driver and into each task.
    """
    return df.hint("merge")


def _next_cuts(moved: DataFrame, keys: Sequence[str], delta: int) -> DataFrame:
    """(keys, __pos, __next): the first position beyond each row's distance plus ``delta``; others are left out."""
    both = moved.select(
        *keys,
        "__pos",
        F.explode(
            F.array(
                F.struct(F.col("__dist").alias("axis"), F.lit(0).alias("asks")),
                F.struct((F.col("__dist") + delta).alias("axis"), F.lit(1).alias("asks")),
            )
        ).alias("e"),
    ).select(*keys, "__pos", F.col("e.axis").alias("__reach"), F.col("e.asks").alias("__asks"))
    # From the far end: a target comes before the rows at its own distance, so it sees only those beyond.
    falling = [By("__reach", False), By("__asks", False), By("__pos", False)]
    seen = running(both, keys, falling, [Running("__next", "last", F.when(F.col("__asks") == 0, F.col("__pos")))])
    return seen.where((F.col("__asks") == 1) & F.col("__next").isNotNull()).select(*keys, "__pos", "__next")


def _reached(heads: DataFrame, jumps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, __pos) of every row reached from the heads, without the heads themselves."""
    reached, jump, found = written(heads.select(*keys, "__pos"), "heads"), written(jumps, "jumps"), None
    target = {**{k: f"__k_{k}" for k in keys}, "__pos": "__at", "__next": "__to"}
    on = [*[(k, f"__k_{k}") for k in keys]]
    while True:
        step = _renamed(jump, target)
        landed = written(
            reached.join(_shuffled(step), _same(reached, step, [*on, ("__pos", "__at")])).select(*keys, F.col("__to").alias("__pos")),
            "cuts",
        )
        if landed.isEmpty():
            return found if found is not None else landed
        # What is reached lies before all that landed, so the two never overlap.
        found = landed if found is None else found.unionByName(landed)
        reached = reached.unionByName(landed)
        jump = written(
            jump.join(_shuffled(step), _same(jump, step, [*on, ("__next", "__at")])).select(*keys, "__pos", F.col("__to").alias("__next")),
            "jumps",
        )


def delta_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Column, delta: int) -> DataFrame:
    """Add ``window_no`` (0-based per key) and ``closes``, whether the row ends its window.

    ``step`` is a whole number, its absolute value counts and NULL counts as 0; ``order``
    must be total within a key.  A key's last window may be open: none of its rows closes.
    Rows without a key are a key of their own.
    """
    moves = F.abs(F.coalesce(step, F.lit(0))).cast("bigint")
    placed = written(
        running(
            with_chunks(df.withColumn("__moves", moves), order),
            keys,
            order,
            [Running("__pos", "row_number"), Running("__dist", "sum", F.col("__moves"))],
        ),
        "placed",
    )
    moved = placed.where((F.col("__moves") > 0) | (F.col("__pos") == 1)).select(*keys, "__pos", "__dist")
    cuts = _reached(moved.where("__pos = 1"), _next_cuts(moved, keys, delta), keys)
    marks = _renamed(cuts, {**{k: f"__k_{k}" for k in keys}, "__pos": "__cut"})
    marked = written(
        placed.join(_shuffled(marks), _same(placed, marks, [*[(k, f"__k_{k}") for k in keys], ("__pos", "__cut")]), "left")
        .withColumn("closes", F.col("__cut").isNotNull())
        .select(*placed.columns, "closes"),
        "marked",
    )
    counted = running(marked, keys, order, [Running("__cuts", "count", F.when(F.col("closes"), 1))])
    numbered = without_chunks(counted).withColumn("window_no", F.col("__cuts") - F.col("closes").cast("bigint"))
    return numbered.select(*df.columns, "window_no", "closes")


def closed_windows(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates of the windows that ended; combined map-side, so a long window is one row per task."""
    totals = rows.groupBy(*keys, "window_no").agg(F.max("closes").alias("__over"), *aggs)
    return totals.where("__over").drop("__over")


def evict_by_delta(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, delta: int
) -> DataFrame:
    """Rows of each window (``keys``) whose value is less than ``delta`` away from that of the window's last row.

    NULL values are away from everything; where the last row has none, the window empties.
    One row per window is found by a combined ``max_by`` and joined back, which adaptive
    execution splits where a window is large.
    """
    valued = df.withColumn("__value", value)
    last = _renamed(
        keep_one(valued.select(*keys, *order, "__value"), keys, order, latest=True),
        {**{k: f"__k_{k}" for k in keys}, "__value": "__last"},
    )
    joined = valued.join(last, _same(valued, last, [(k, f"__k_{k}") for k in keys]))
    return joined.where(F.abs(F.col("__value") - F.col("__last")) < delta).select(*df.columns)
