"""Ordered per-key computations that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task.  When the input may not suit one task, the functions here cut the order
axis into equi-depth chunks and work in two steps:

1. one map-side-combined aggregate per (key, chunk) gives the chunk's total,
   and a window over those few totals gives what earlier chunks contribute;
2. the running value inside each (key, chunk) is computed next to it and the
   earlier contribution is added.

No task then holds more than one chunk of one key.  Inputs whose estimated size
fits one task take the plain window; both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import cut_lineage
from millrace.sizing import ONE_TASK_BYTES, estimated_bytes, fits_one_task, limit_bytes

_CHUNK = "__chunk"
_MIN_CHUNKS = 8
# Without keys a chunk is all of one task, and a stored byte unfolds to a hundred in a sort.
_KEYLESS_SHARE = 32
_UNKNOWN_BYTES, _UNKNOWN_CHUNKS = 1 << 60, 16384  # Catalyst knows no size: many small chunks


@dataclass(frozen=True)
class By:
    """One ordering column; ``By("ts")`` ascending, ``By("v", False)`` descending."""

    name: str
    ascending: bool = True


@dataclass(frozen=True)
class Running:
    """One output column: a running ``kind`` of ``value`` up to the current row.

    Kinds: ``sum count min max last`` (last non-null), ``max_before`` and
    ``last_before`` (the same without the current row), ``lag`` (previous row's
    value), ``row_number``, ``rank`` and ``dense_rank``.
    """

    out: str
    kind: str
    value: Column | None = None


def _orders(order: Sequence[By | str]) -> list[By]:
    return [o if isinstance(o, By) else By(o) for o in order]


def _sort_column(by: By) -> Column:
    return F.col(by.name).asc() if by.ascending else F.col(by.name).desc()


def _as_number(df: DataFrame, name: str) -> Column | None:
    """The column on a numeric axis that keeps its order, if it has one."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.datediff(F.col(name), F.lit("1970-01-01").cast("date"))
    return None


def _sort_key(df: DataFrame, order: Sequence[By]) -> Column | None:
    """A struct that compares as the order does, or None if it cannot be built."""
    parts = []
    for i, by in enumerate(order):
        number = _as_number(df, by.name)
        if number is None and not by.ascending:
            return None
        c = F.col(by.name) if number is None else number
        parts.append((c if by.ascending else -c).alias(f"k{i}"))
    return F.struct(*parts)


def _constant_array(values: Sequence, element_type: str) -> Column:
    """A literal array as one constant, however many elements it has."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{element_type}>")


def _add_position(df: DataFrame, bounds: Sequence, axis: Column, axis_type: str, out: str) -> DataFrame:
    """Add how many of the sorted bounds are at or below the axis value.

    A binary search, one projection per halving; it stays in generated code.
    NULLs, which sort lowest, get position 0.
    """
    table = _constant_array(bounds, axis_type)
    found = df.withColumns({"__axis": axis, out: F.lit(0)})
    for k in reversed(range(len(bounds).bit_length())):
        at, step = F.col(out), 1 << k
        higher = F.get(table, at + (step - 1)) <= F.col("__axis")
        found = found.withColumn(out, at + F.when(higher, step).otherwise(0))
    return found.drop("__axis")


def _add_chunks(df: DataFrame, leading: By, share: int = 1) -> DataFrame:
    """Add the equi-depth chunk number of the leading order column, ascending in it.

    The bounds are approximate percentiles from one aggregate job over that one
    column: one number for each chunk reaches the driver.
    """
    axis = _as_number(df, leading.name)
    if axis is None:
        return df
    per_task = max(1, limit_bytes(df.sparkSession, ONE_TASK_BYTES) // share)
    wanted = math.ceil(estimated_bytes(df) / per_task)
    known = estimated_bytes(df) < _UNKNOWN_BYTES
    n = max(wanted if known else _UNKNOWN_CHUNKS, _MIN_CHUNKS)
    cuts = _constant_array([i / n for i in range(1, n)], "double")
    axis_type = df.select(axis).schema[0].dataType.simpleString()
    row = df.agg(F.percentile_approx(axis, cuts, max(1000, 4 * n)).alias("bounds")).first()
    bounds = sorted(set(row["bounds"] or []))
    if not bounds:
        return df.withColumn(_CHUNK, F.lit(0))
    return _add_position(df, bounds, axis, axis_type, _CHUNK)


def _plain(kind: str, value: Column | None, keys: Sequence[str], order: Sequence[By]) -> Column:
    w = Window.partitionBy(*keys).orderBy(*[_sort_column(b) for b in order])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "row_number":
        return F.row_number().over(w)
    if kind == "rank":
        return F.rank().over(w)
    if kind == "dense_rank":
        return F.dense_rank().over(w)
    if kind == "lag":
        return F.lag(value).over(w)
    if kind == "last":
        return F.last(value, ignorenulls=True).over(upto)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "last_before":
        return F.last(value, ignorenulls=True).over(before)
    if kind == "max_before":
        return F.max(value).over(before)
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind](value).over(upto)


def _total(spec: Running, sort_key: Column, order: Sequence[By]) -> Column:
    if spec.kind in ("row_number", "rank"):
        return F.count(F.lit(1))
    if spec.kind == "dense_rank":
        return F.count_distinct(*[F.col(b.name) for b in order])
    if spec.kind == "lag":
        return F.max_by(spec.value, sort_key)
    if spec.kind in ("last", "last_before"):
        return F.max_by(spec.value, F.when(spec.value.isNotNull(), sort_key))
    if spec.kind == "max_before":
        return F.max(spec.value)
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[spec.kind](spec.value)


def _carried(spec: Running, total: Column, keys: Sequence[str], chunk_order: Column) -> Column:
    w = Window.partitionBy(*keys).orderBy(chunk_order)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    if spec.kind == "lag":
        return F.lag(total).over(w)
    if spec.kind in ("last", "last_before"):
        return F.last(total, ignorenulls=True).over(earlier)
    if spec.kind in ("min", "max", "max_before"):
        return (F.min if spec.kind == "min" else F.max)(total).over(earlier)
    summed = F.sum(total).over(earlier)
    return summed if spec.kind == "sum" else F.coalesce(summed, F.lit(0))


def _combined(spec: Running, local: Column, carry: Column, first_in_chunk: Column) -> Column:
    if spec.kind == "lag":
        return F.when(first_in_chunk == 1, carry).otherwise(local)
    if spec.kind in ("last", "last_before"):
        return F.coalesce(local, carry)
    if spec.kind == "min":
        return F.least(local, carry)
    if spec.kind in ("max", "max_before"):
        return F.greatest(local, carry)
    if spec.kind == "sum":
        return F.coalesce(local + carry, local, carry)
    return local + F.coalesce(carry, F.lit(0))


def with_chunks(df: DataFrame, order: Sequence[By | str], keyed: bool = True) -> DataFrame:
    """Add the chunk number of the order axis, unless the input fits one task.

    An operator of several ordered steps calls this once and every ``running``
    after it works on the same chunks.  Work without keys has smaller chunks: keyed
    rows of a chunk still spread over tasks, those without a key do not.
    """
    order, share = _orders(order), 1 if keyed else _KEYLESS_SHARE
    if _CHUNK in df.columns or fits_one_task(df, share) or _sort_key(df, order) is None:
        return df
    return _add_chunks(df, order[0], share)


def settle(df: DataFrame) -> DataFrame:
    """Write a chunked intermediate to the checkpoint folder.

    Each ordered step reads its input twice (chunk totals and rows), so a chain
    of steps would otherwise recompute the first one exponentially often.
    """
    return cut_lineage(df) if _CHUNK in df.columns else df


def without_chunks(df: DataFrame) -> DataFrame:
    return df.drop(_CHUNK)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[By | str],
    specs: Sequence[Running],
) -> DataFrame:
    """Add running columns per key in the given order.

    The order must be total within a key for ``sum last lag row_number`` to be
    reproducible; add a unique column as the last one.  The leading order
    column should have many values (a time, an amount): rows that share its
    value stay in one chunk, which is what makes ranks of ties come out right.
    """
    order = _orders(order)
    rows = with_chunks(df, order, keyed=bool(keys))
    if _CHUNK not in rows.columns:
        return df.withColumns({s.out: _plain(s.kind, s.value, keys, order) for s in specs})
    sort_key = _sort_key(df, order)
    chunk_order = F.col(_CHUNK).asc() if order[0].ascending else F.col(_CHUNK).desc()

    totals = rows.groupBy(*keys, _CHUNK).agg(
        *[_total(s, sort_key, order).alias(f"__t{i}") for i, s in enumerate(specs)]
    )
    # The rows meet their chunk's carried values on (key hash, chunk).  That
    # one shuffle also clusters the windows below, which partition by the same
    # two columns and the keys; the null-safe key test settles hash collisions.
    key_hash = F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("bigint")
    carried = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        key_hash.alias("__kh"),
        F.col(_CHUNK).alias("__kc"),
        *[
            _carried(s, F.col(f"__t{i}"), keys, chunk_order).alias(f"__c{i}")
            for i, s in enumerate(specs)
        ],
    )
    # Written so that it stays a filter on matches: as an equi-join key it
    # would ask for a different clustering than the windows.
    same = reduce(
        lambda a, b: a & b,
        [
            F.coalesce(F.col(k) == F.col(f"__k{i}"), F.col(k).isNull() & F.col(f"__k{i}").isNull())
            for i, k in enumerate(keys)
        ],
        (F.col("__hash") == F.col("__kh")) & (F.col(_CHUNK) == F.col("__kc")),
    )
    joined = rows.withColumn("__hash", key_hash).join(carried, same, "left")
    inner = ["__hash", _CHUNK, *keys]
    local = joined.withColumns(
        {
            "__first": _plain("row_number", None, inner, order),
            **{f"__l{i}": _plain(s.kind, s.value, inner, order) for i, s in enumerate(specs)},
        }
    )
    return local.select(
        *df.columns,
        *[
            _combined(s, F.col(f"__l{i}"), F.col(f"__c{i}"), F.col("__first")).alias(s.out)
            for i, s in enumerate(specs)
        ],
    )


def row_numbers(df, keys, order, out: str = "rn") -> DataFrame:
    """1-based position of every row within its key."""
    return running(df, keys, order, [Running(out, "row_number")])


def count_windows(df: DataFrame, keys, order, size: int, slide: int | None = None) -> DataFrame:
    """Assign rows to count windows of ``size`` rows per key, in arrival order.

    Adds ``window_no`` (0-based).  With ``slide`` a row belongs to every window
    that covers it, so rows repeat ``ceil(size / slide)`` times at most.  Windows that
    never filled are still there; ``fired_windows`` aggregates and leaves them out.
    """
    slide = slide or size
    numbered = row_numbers(df, keys, order, "__rn")
    position = F.col("__rn") - 1
    last = F.floor(position / slide)
    first = F.greatest(F.lit(0), F.floor((position - size) / slide) + 1)
    assigned = numbered.withColumn(
        "window_no", F.explode(F.when(first <= last, F.sequence(first, last)))
    )
    # A window fired if it holds ``size`` rows.  The counts are combined map-side,
    # so a hot key is one row per window and task; no row meets its key's others.
    return assigned.drop("__rn")


def fired_windows(assigned: DataFrame, keys, aggs: Sequence[Column], size: int) -> DataFrame:
    """Aggregates of the count windows that filled up; the others did not fire."""
    totals = assigned.groupBy(*keys, "window_no").agg(F.count(F.lit(1)).alias("__n"), *aggs)
    return totals.where(F.col("__n") == size).drop("__n")


def sessions(df: DataFrame, keys, ts: str, tie: str, gap_seconds: Column) -> DataFrame:
    """Add ``session_start``: rows no further than the gap from the session so far.

    ``gap_seconds`` may vary per row.  A row keeps its session open until its
    own time plus its own gap; a session lasts until the latest such end.
    """
    stamp = F.unix_micros(F.col(ts).cast("timestamp"))
    closes = stamp + gap_seconds.cast("bigint") * 1_000_000
    order = [ts, tie]
    reach = running(
        with_chunks(df, order).withColumn("__closes", closes),
        keys,
        order,
        [Running("__before", "max_before", F.col("__closes"))],
    )
    opens = F.col("__before").isNull() | (stamp > F.col("__before"))
    opened = settle(reach.withColumn("__start", F.when(opens, F.col(ts))))
    marked = running(opened, keys, order, [Running("session_start", "last", F.col("__start"))])
    return without_chunks(marked).drop("__before", "__start", "__closes")


def top_n(df: DataFrame, keys, order, n: int, out: str = "rn") -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    Spark limits each key to ``n`` rows before the shuffle (window group
    limit), so a hot key contributes ``n`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[_sort_column(b) for b in _orders(order)])
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def keep_one(df: DataFrame, keys, order, latest: bool = False) -> DataFrame:
    """One whole row per key: the first (or the latest) in the given order.

    A combinable ``min_by``/``max_by`` instead of a sorted window: a hot key
    shrinks to one row per map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    rank = F.struct(*[F.col(c) for c in order])
    kept = df.groupBy(*keys).agg(
        pick(F.struct(*[F.col(c) for c in rest]), rank).alias("__row")
    )
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns]
    )
