"""Changelog tables: rows with a change kind, versions, snapshots and CDC.

Change kinds are ``+I`` insert, ``-U`` / ``+U`` update before / after and ``-D``
delete, in a plain string column.  Latest-version lookups are combinable
``max_by`` aggregates, so a key with a long history shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import Running, keep_one, running

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def materialise(changes: DataFrame, keys: Sequence[str], version: Sequence[str], op: str = "op") -> DataFrame:
    """Current rows of an upsert or full changelog: newest per key, deletes gone."""
    live = changes.where(F.col(op) != BEFORE)
    newest = keep_one(live, keys, version, latest=True)
    return newest.where(F.col(op) != DELETE).drop(op)


def to_changelog(
    versions: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Full changelog of a versioned table: ``+I`` first, then ``-U`` / ``+U`` pairs.

    The retracted row repeats the values of the version it replaces; versions
    that change nothing give no rows.
    """
    current = F.struct(*[F.col(v) for v in values])
    seen = running(versions, keys, order, [Running("__old", "lag", current)])
    changed = seen.where(F.col("__old").isNull() | ~F.col("__old").eqNullSafe(current))

    def image(op: str, source: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), *[source[v].alias(v) for v in values])

    entries = F.when(
        F.col("__old").isNull(), F.array(image(INSERT, current))
    ).otherwise(F.array(image(BEFORE, F.col("__old")), image(AFTER, current)))
    return changed.select(*keys, *order, F.inline(entries))


def snapshot_at(
    versions: DataFrame,
    keys: Sequence[str],
    valid_from: str,
    at: str | datetime,
    op: str | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Table content as of a constant timestamp (session zone).

    ``at`` must be a constant: a column is rejected, as the point in time is
    fixed when the query is planned.
    """
    if isinstance(at, Column):
        raise TypeError("the snapshot time must be a constant")
    dtype = versions.schema[valid_from].dataType.simpleString()
    past = versions.where(F.col(valid_from) <= F.lit(str(at)).cast(dtype))
    newest = keep_one(past, keys, [valid_from, *tie], latest=True)
    return newest if op is None else newest.where(F.col(op) != DELETE).drop(op)


def apply_changes(
    snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], version: str, op: str = "op"
) -> DataFrame:
    """Merge a snapshot with later changes: newest version per key wins.

    Columns only one side has are NULL on the other (schema evolution).  A
    change older than the snapshot's row does not override it.
    """
    base = snapshot.withColumn(op, F.lit(INSERT))
    merged = base.unionByName(changes, allowMissingColumns=True)
    return materialise(merged, keys, [version], op)
