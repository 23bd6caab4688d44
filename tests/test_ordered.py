"""Chunked ordered plans against the plain window, on a key with half of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered as O
from millrace.plans import REGISTRY
from millrace.sizing import ONE_TASK_BYTES
from tests.compare import differences
from tests.conftest import SMALL

CHUNKED = [
    "agg_28_running_keyed_sum",
    "win_06_cumulative_frames",
    "win_10_count_window_sliding",
    "jon_24_as_of_join",
    "snk_13_full_changelog",
    "str_05_session_window",
    "str_06_dynamic_session_window",
    "str_22_strict_pattern",
    "str_22_followed_by_pattern",
    "str_23_state_machine",
    "str_24_connected_components",
]


@pytest.fixture
def one_task_limit(spark):
    def set_limit(size):
        spark.conf.set(ONE_TASK_BYTES, str(size))

    yield set_limit
    spark.conf.unset(ONE_TASK_BYTES)


@pytest.mark.parametrize("name", CHUNKED)
def test_registered_query_in_chunks(name, spark, duck, one_task_limit):
    one_task_limit(2048)
    assert differences(REGISTRY[name](spark, SMALL), duck, REGISTRY[name].sql) is None


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = rng.choice([None, 1, 1, 1, 2, 3])
        value = rng.choice([None, rng.randint(-50, 50)])
        rows.append((i, key, rng.randint(0, 400), value))
    return spark.createDataFrame(rows, "id BIGINT, k INT, t BIGINT, v BIGINT").repartition(5).cache()


KINDS = ["sum", "count", "min", "max", "last", "lag", "last_before", "max_before", "row_number"]


@pytest.mark.parametrize("ascending", [True, False])
def test_all_kinds_agree(spark, skewed, one_task_limit, ascending):
    order = [O.By("t", ascending), O.By("id", ascending)]
    specs = [O.Running(f"o_{k}", k, F.col("v")) for k in KINDS]
    plain = {r["id"]: r.asDict() for r in O.running(skewed, ["k"], order, specs).collect()}
    one_task_limit(256)
    chunked = {r["id"]: r.asDict() for r in O.running(skewed, ["k"], order, specs).collect()}
    assert chunked == plain


def test_ranks_with_ties(spark, skewed, one_task_limit):
    specs = [O.Running("r", "rank"), O.Running("d", "dense_rank")]
    plain = sorted(O.running(skewed, ["k"], ["t"], specs).select("id", "r", "d").collect())
    one_task_limit(256)
    chunked = sorted(O.running(skewed, ["k"], ["t"], specs).select("id", "r", "d").collect())
    assert chunked == plain


def test_top_n_limits_before_the_shuffle(skewed):
    plan = O.top_n(skewed, ["k"], ["t", "id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_count_window_that_never_fills(spark):
    rows = spark.createDataFrame(
        [(1, "hi"), (2, "hello"), (3, "hi"), (4, "hello"), (5, "hi"), (6, "hello"), (6, "hello")], "n INT, w STRING"
    ).withColumn("i", F.monotonically_increasing_id())
    got = (
        O.fired_windows(O.count_windows(rows, ["w"], ["i"], 2), ["w"], [F.sum("n").alias("s")], 2).collect()
    )
    assert sorted((r.w, r.window_no, r.s) for r in got) == [("hello", 0, 6), ("hello", 1, 12), ("hi", 0, 4)]


def test_rows_without_a_key_are_spread(spark):
    """Small as stored, too many for the one task that a window without keys has."""
    n, conf = 400_000, "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        rows = O.running(spark.range(n).toDF("t"), [], ["t"], [O.Running("before", "lag", F.col("t"))])
        parts = rows.groupBy(F.spark_partition_id().alias("part")).count().collect()
        assert rows.where("before = t - 1").count() == n - 1
    finally:
        spark.conf.set(conf, before)
    assert sum(p["count"] for p in parts) == n and max(p["count"] for p in parts) < n
