"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.exact import money_sum
from millrace.plans.registry import query


def _ordering(t):
    return t.orders.where(F.year("o_orderdate") == 1996).select(F.col("o_custkey").alias("id"))


def _later(t):
    return t.orders.where(F.year("o_orderdate") == 1997).select(F.col("o_custkey").alias("id"))


_A = "SELECT o_custkey AS id FROM orders WHERE year(o_orderdate) = 1996"
_B = "SELECT o_custkey AS id FROM orders WHERE year(o_orderdate) = 1997"


@query(
    "SET-01",
    "union_all",
    """SELECT c_nationkey AS id, 'c' AS kind FROM customer
       UNION ALL SELECT s_suppkey, 's' FROM supplier""",
)
def union_all(t):
    # The INT and BIGINT key columns widen to BIGINT by position.
    return t.customer.select(F.col("c_nationkey").alias("id"), F.lit("c").alias("kind")).union(
        t.supplier.select("s_suppkey", F.lit("s"))
    )


@query("SET-02", "union_distinct", f"{_A} UNION {_B}")
def union_distinct(t):
    return _ordering(t).union(_later(t)).distinct()


@query("SET-03", "intersect", f"{_A} INTERSECT {_B}")
def intersect(t):
    return _ordering(t).intersect(_later(t))


@query("SET-04", "intersect_all", f"{_A} INTERSECT ALL {_B}")
def intersect_all(t):
    return _ordering(t).intersectAll(_later(t))


@query("SET-05", "except_distinct", f"{_A} EXCEPT {_B}")
def except_distinct(t):
    return _ordering(t).subtract(_later(t))


@query("SET-06", "except_all", f"{_A} EXCEPT ALL {_B}")
def except_all(t):
    return _ordering(t).exceptAll(_later(t))


@query(
    "SET-07",
    "channel_union_rollup",
    """SELECT channel, status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM (
         SELECT 'order' AS channel, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders
         UNION ALL
         SELECT 'line', l_linestatus, CAST(l_extendedprice AS DECIMAL(12,2)) FROM lineitem
         UNION ALL
         SELECT 'event', event_type, CAST(value AS DECIMAL(12,2)) FROM events)
       GROUP BY ROLLUP (channel, status)""",
)
def channel_union_rollup(t):
    channels = [
        ("order", t.orders, "o_orderstatus", "o_totalprice"),
        ("line", t.lineitem, "l_linestatus", "l_extendedprice"),
        ("event", t.events, "event_type", "value"),
    ]
    parts = [
        df.select(F.lit(name).alias("channel"), F.col(status).alias("status"), F.col(amount).alias("amount"))
        for name, df, status, amount in channels
    ]
    rows = parts[0].union(parts[1]).union(parts[2])
    return rows.rollup("channel", "status").agg(
        F.count("*").alias("n"), money_sum("amount").alias("amount")
    )
