"""Rewritten joins against brute force on small frames."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.sizing import BROADCAST_BYTES, small_side

T0 = datetime(2024, 1, 1)


def _events(spark, seed, n, prefix):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice([1, 1, 1, 2, 3]), T0 + timedelta(seconds=rng.randint(0, 900))) for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, f"{prefix}_id BIGINT, k INT, {prefix}_ts TIMESTAMP")


@pytest.mark.parametrize("lower,upper", [(0, 60), (-30, 30), (10, 25), (0, 0)])
def test_band_join(spark, lower, upper):
    left_rows, left = _events(spark, 1, 150, "l")
    right_rows, right = _events(spark, 2, 150, "r")
    got = J.band_join(left, right, ["k"], "l_ts", "r_ts", lower, upper).select("l_id", "r_id")
    want = {
        (a, b)
        for a, ka, ta in left_rows
        for b, kb, tb in right_rows
        if ka == kb and tb + timedelta(seconds=lower) <= ta <= tb + timedelta(seconds=upper)
    }
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_latest_before_takes_equal_times(spark):
    left_rows, left = _events(spark, 3, 120, "l")
    right_rows, right = _events(spark, 4, 40, "r")
    right = right.dropDuplicates(["k", "r_ts"])
    kept = {(r.k, r.r_ts): r.r_id for r in right.collect()}
    got = J.latest_before(left, right, ["k"], "l_ts", "r_ts", ["r_id"], "l_id")
    want = {}
    for i, k, ts in left_rows:
        past = [t for (rk, t) in kept if rk == k and t <= ts]
        want[i] = kept[(k, max(past))] if past else None
    assert {r.l_id: r.r_id for r in got.collect()} == want


@pytest.mark.parametrize(
    "listed,kept", [([2], [1, 3]), ([2, None], []), ([], [1, 2, 3, None])]
)
def test_not_in(spark, listed, kept):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x INT")
    other = spark.createDataFrame([(v,) for v in listed], "y INT")
    got = [r.x for r in J.not_in(df, F.col("x"), other, "y").collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)


def test_theta_and_constant_semi_joins(spark):
    foo = spark.createDataFrame([(i, i) for i in range(1, 6)], "x INT, y INT")
    bar = spark.createDataFrame([(1, "a"), (1, "aa"), (2, "b")], "i INT, s STRING")
    got = J.semi_where_sum_exceeds(foo, F.col("x"), bar, F.col("i"), 4)
    assert sorted(r.x for r in got.collect()) == [3, 4, 5]
    assert J.semi_if_any(foo.where("x = 1"), bar.where("i = 1")).count() == 1
    assert J.semi_if_any(foo, bar.where("i = 9")).count() == 0


def test_cogroup_apply_sees_both_sides(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "k INT, v INT")
    b = spark.createDataFrame([(1, 10), (3, 30)], "k INT, w INT")

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        k = (left if len(left) else right)["k"].iloc[0]
        return pd.DataFrame({"k": [k], "s": [left["v"].sum() + right["w"].sum()]})

    got = J.cogroup_apply(a, b, "k", both, "k INT, s BIGINT").collect()
    assert sorted(tuple(r) for r in got) == [(1, 13), (2, 5), (3, 30)]


def test_lookup_keeps_rows_without_answer(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    got = J.enrich_batches(df, "k", lambda ks: {k: k * 2 for k in ks if k < 40}, "d", "BIGINT", chunk_rows=7)
    rows = {r.k: r.d for r in got.collect()}
    assert len(rows) == 50 and rows[3] == 6 and rows[45] is None


def test_small_side_is_bounded(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    dim = spark.range(10)
    assert "broadcast" in plan(small_side(dim).join(spark.range(5), "id")).lower()
    spark.conf.set(BROADCAST_BYTES, "1")
    try:
        assert "strategy=broadcast" not in plan(small_side(dim).join(spark.range(5), "id"))
    finally:
        spark.conf.unset(BROADCAST_BYTES)
