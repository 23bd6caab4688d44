"""Windows cut by data against a walk over each key's rows, split over chunks and not."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import delta_windows as D
from millrace.sizing import ONE_TASK_BYTES
from millrace.streaming.delta import best_of, better

SCHEMA = "k INT, t INT, v BIGINT, window_no STRING"


def walk(rows, delta):
    """(k, t, window number, closes) row by row."""
    out, open_at = [], {}
    for k, t, v, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        dist, base, no = open_at.get(k, (0, None, 0))
        dist += abs(v or 0)
        base = dist if base is None else base
        closes = dist - base > delta
        out.append((k, t, no, closes))
        open_at[k] = (dist, dist if closes else base, no + closes)
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", ["1", str(1 << 40)])
def test_windows_equal_a_walk(spark, limit):
    rng = random.Random(4)
    # One key has most of the rows, one never moves, one is missing, one has a single row.
    rows = [(1, t, rng.choice([None, 0, 0, 3, -7, 12]), "x") for t in range(900)]
    rows += [(2, t, 0, "x") for t in range(50)] + [(None, t, rng.randrange(30), None) for t in range(60)] + [(3, 0, 99, "x")]
    rng.shuffle(rows)
    before = spark.conf.get(ONE_TASK_BYTES, None)
    spark.conf.set(ONE_TASK_BYTES, limit)
    try:
        table = spark.createDataFrame(rows, SCHEMA).drop("window_no")
        got = D.delta_windows(table, ["k"], ["t"], F.col("v"), 20)
        assert got.columns == ["k", "t", "v", "window_no", "closes"]
        found = sorted(((r.k, r.t, r.window_no, r.closes) for r in got.collect()), key=str)
        none = D.delta_windows(table.where("false"), ["k"], ["t"], F.col("v"), 20)
        assert none.count() == 0
    finally:
        spark.conf.unset(ONE_TASK_BYTES) if before is None else spark.conf.set(ONE_TASK_BYTES, before)
    assert found == walk(rows, 20) and sum(r[3] for r in found) > 100


def test_eviction_is_measured_from_the_last_row(spark):
    rows = [(1, 0, 10), (1, 1, 14), (1, 2, 15), (1, 3, 19), (2, 0, 5), (2, 1, None), (None, 0, 1), (None, 1, None), (None, 2, 2)]
    table = spark.createDataFrame(rows, "k INT, t INT, v BIGINT")
    kept = D.evict_by_delta(table, ["k"], ["t"], F.col("v"), 5)
    # Exactly the limit away is evicted; a window whose last row has no value empties.
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, 2, 15), (1, 3, 19), (None, 0, 1), (None, 2, 2)]


def test_best_row_of_a_window():
    values, ids = pd.Series([5, 9, None, 9], dtype="Int64"), pd.Series([4, 3, 1, 2])
    assert best_of(values, ids) == (-9, 2) and best_of(values.iloc[2:3], ids.iloc[2:3]) is None
    assert better((-9, 2), (-9, 1)) == (-9, 1) and better(None, (-1, 7)) == (-1, 7) and better(None, None) is None
