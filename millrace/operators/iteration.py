"""Bulk iteration: feed a step's output back until nothing changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import cut_lineage


def iterate(
    initial: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    changed: Callable[[DataFrame, DataFrame], int],
    max_rounds: int,
) -> DataFrame:
    """Run ``step`` until ``changed(old, new)`` is 0 or ``max_rounds`` is reached.

    Each round is written to the reliable checkpoint folder, so plans stay
    short and a lost executor does not replay earlier rounds.  Only the change
    count returns to the driver.  Reaching ``max_rounds`` without converging
    raises rather than returning a half-done result.
    """
    state = cut_lineage(initial)
    for _ in range(max_rounds):
        following = cut_lineage(step(state))
        if changed(state, following) == 0:
            return following
        state = following
    raise RuntimeError(f"no convergence within {max_rounds} rounds")

_SALTS = 16


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest vertex of each connected component: ``(vertex, component)``.

    ``edges`` has ``src`` and ``dst``.  A round takes the smallest label among
    the neighbours, then jumps to the label of that label, which halves path
    lengths, so rounds grow with the logarithm of the diameter.  Both steps are
    ``min`` aggregates with map-side combine: a hub vertex costs one row per
    map task.
    """
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = cut_lineage(edges.select(F.explode(ways).alias("e")).select("e.src", "e.dst").distinct())
    start = both.groupBy(F.col("src").alias("vertex")).agg(
        F.least(F.min("dst"), F.col("vertex")).alias("component")
    )

    def step(labels: DataFrame) -> DataFrame:
        near = (
            both.join(labels, F.col("dst") == F.col("vertex"))
            .groupBy(F.col("src").alias("v"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, F.col("vertex") == F.col("v")).select(
            "vertex", F.least("component", "near").alias("component")
        )
        # Only labels in use are looked up, each under every salt: a giant component
        # is one label for most vertices, and its vertices meet it in many tasks.
        used = lowered.select(F.col("component").alias("__label")).distinct()
        target = lowered.join(used, F.col("vertex") == F.col("__label"), "left_semi").select(
            F.col("vertex").alias("__label"),
            F.col("component").alias("__next"),
            F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt"),
        )
        salted = lowered.withColumn("__own_salt", F.pmod(F.xxhash64("vertex"), F.lit(_SALTS)).cast("int"))
        same = (F.col("component") == F.col("__label")) & (F.col("__own_salt") == F.col("__salt"))
        return salted.join(target, same, "left").select(
            "vertex", F.least("component", F.col("__next")).alias("component")
        )

    def changed(old: DataFrame, new: DataFrame) -> int:
        before = old.select("vertex", F.col("component").alias("was"))
        return new.join(before, "vertex").where("component <> was").count()

    return iterate(start, step, changed, max_rounds)
