"""The plans we rely on at scale."""

from pyspark.sql import functions as F

from millrace.operators import distribution as D
from millrace.operators import dml
from millrace.plans import REGISTRY
from millrace.tables import Tables
from tests.conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(REGISTRY["tpch_q6"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_shipdate)" in plan or "LessThan(l_quantity,24.0)" in plan
    assert (
        "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in plan
    )


def test_aggregates_combine_before_the_shuffle(spark):
    plan = D.executed_plan(REGISTRY["agg_26_two_phase"](spark, SMALL))
    assert plan.count("HashAggregate") == 2 and "partial_sum" in plan


def test_dedup_needs_no_sorted_window(spark):
    plan = D.executed_plan(REGISTRY["win_01_dedup_keep_last"](spark, SMALL))
    assert "Window" not in plan and "partial_max_by" in plan


def test_or_of_ands_is_an_equi_join(spark):
    plan = D.executed_plan(REGISTRY["prj_14_or_of_ands"](spark, SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in D.executed_plan(REGISTRY["srt_02_top_k"](spark, SMALL))
    df = Tables(spark, SMALL).orders.limit(7)
    plan = D.executed_plan(df.groupBy().count())
    assert "LocalLimit 7" in plan and "GlobalLimit 7" in plan


def test_pre_keyed_join_has_no_exchange(spark):
    db = dml.work_database(spark)
    t = Tables(spark, SMALL)
    o = D.save_keyed(t.orders.select("o_orderkey"), f"{db}.o", "o_orderkey", 4)
    l = D.save_keyed(t.lineitem.select("l_orderkey"), f"{db}.l", "l_orderkey", 4)
    joined = o.hint("merge").join(l, F.col("o_orderkey") == F.col("l_orderkey"))
    assert "Exchange" not in D.executed_plan(joined)


def test_count_windows_meet_no_other_rows_of_their_key(spark):
    plan = D.executed_plan(REGISTRY["win_10_count_window_sliding"](spark, SMALL))
    assert "Join" not in plan and "partial_count" in plan


def test_custom_partitioner_places_rows(spark):
    df = D.partition_by_id(spark.range(100), F.col("id") % 3, 3)
    got = df.select(F.spark_partition_id().alias("p"), (F.col("id") % 3).alias("m")).distinct().collect()
    assert {(r.p, r.m) for r in got} == {(0, 0), (1, 1), (2, 2)}


def test_cluster_by_sorts_inside_partitions(spark):
    df = D.cluster_by(Tables(spark, SMALL).customer, "c_nationkey", n=3)
    parts = df.select("c_nationkey", F.spark_partition_id().alias("p")).collect()
    for p in {r.p for r in parts}:
        keys = [r.c_nationkey for r in parts if r.p == p]
        assert keys == sorted(keys)
