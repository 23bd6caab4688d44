"""Joins and subqueries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.exact import discounted, money_sum, unit_sum, units
from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.plans.registry import query
from millrace.sizing import small_side

REVENUE = (
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))) AS DOUBLE)"
)


@query(
    "JON-01",
    "inner_join",
    """SELECT n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
       FROM customer JOIN nation ON nullif(c_nationkey, 3) = n_nationkey GROUP BY n_name""",
)
def inner_join(t):
    # NULL keys never match, so nation 3 drops out.
    key = F.nullif(F.col("c_nationkey"), F.lit(3))
    return (
        t.customer.join(t.nation, key == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("customers"), money_sum("c_acctbal").alias("balance"))
    )


@query(
    "JON-02",
    "left_outer",
    """SELECT c_custkey, o_orderkey, o_totalprice FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'""",
)
def left_outer(t):
    pending = t.orders.where("o_orderstatus = 'P'")
    return t.customer.join(pending, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "JON-03",
    "right_outer",
    """SELECT p_partkey, count(l_orderkey) AS lines FROM lineitem
       RIGHT JOIN part ON l_partkey = p_partkey AND l_quantity > 45 GROUP BY p_partkey""",
)
def right_outer(t):
    big = t.lineitem.where("l_quantity > 45")
    return (
        big.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "right")
        .groupBy("p_partkey")
        .agg(F.count("l_orderkey").alias("lines"))
    )


@query(
    "JON-04",
    "full_outer",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n96 FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1),
            b AS (SELECT o_custkey AS k, count(*) AS n97 FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
       SELECT coalesce(a.k, b.k) AS custkey, n96, n97 FROM a FULL JOIN b ON a.k = b.k""",
)
def full_outer(t):
    def of(year: int, name: str):
        return (
            t.orders.where(F.year("o_orderdate") == year)
            .groupBy(F.col("o_custkey").alias("custkey"))
            .agg(F.count("*").alias(name))
        )

    return of(1996, "n96").join(of(1997, "n97"), "custkey", "full")


@query(
    "JON-05",
    "left_semi",
    """SELECT c_custkey, c_name FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
)
def left_semi(t):
    large = t.orders.where("o_totalprice > 450000")
    return t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@query(
    "JON-06",
    "left_semi_theta",
    """SELECT c_custkey, c_acctbal FROM customer
       WHERE EXISTS (SELECT 1 FROM supplier WHERE c_acctbal + s_acctbal > 19000)""",
)
def left_semi_theta(t):
    return J.semi_where_sum_exceeds(
        t.customer.select("c_custkey", "c_acctbal"), F.col("c_acctbal"), t.supplier, F.col("s_acctbal"), 19000
    )


@query(
    "JON-06",
    "left_semi_constant",
    """SELECT c_mktsegment, count(*) AS n FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F') GROUP BY c_mktsegment""",
)
def left_semi_constant(t):
    kept = J.semi_if_any(t.customer, t.orders.where("o_orderstatus = 'F'"))
    return kept.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "JON-07",
    "cross_with_dimension",
    """SELECT c_custkey, r_name, c_nationkey + r_regionkey AS pair_value FROM customer CROSS JOIN region""",
)
def cross_with_dimension(t):
    return J.pair_with_dimension(
        t.customer,
        t.region,
        ["c_custkey", "r_name", (F.col("c_nationkey") + F.col("r_regionkey")).alias("pair_value")],
    )


@query(
    "JON-08",
    "join_with_function",
    """SELECT o_orderkey, c_name || ':' || o_orderpriority AS label,
              CASE WHEN c_acctbal > 0 THEN o_totalprice ELSE 0.0 END AS covered
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_with_function(t):
    def pair(order, customer):
        return [
            order["o_orderkey"],
            F.concat(customer["c_name"], F.lit(":"), order["o_orderpriority"]).alias("label"),
            F.when(customer["c_acctbal"] > 0, order["o_totalprice"]).otherwise(0.0).alias("covered"),
        ]

    o, c = t.orders, t.customer
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(*pair(o, c))


@query(
    "JON-09",
    "self_join_inequality",
    """SELECT a.l_orderkey, count(*) AS pairs FROM lineitem a
       JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey
       GROUP BY a.l_orderkey""",
)
def self_join_inequality(t):
    # Pairs with different suppliers follow from the supplier counts of each
    # order, so no pair is ever listed.
    per_supplier = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("c"))
    return (
        per_supplier.groupBy("l_orderkey")
        .agg(A.distinct_pairs(F.sum("c"), F.sum(F.col("c") * F.col("c"))).alias("pairs"))
        .where("pairs > 0")
    )


@query(
    "JON-10",
    "inequality_residuals",
    f"""SELECT p_brand, count(*) AS n, {REVENUE} AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 5 DAY
       JOIN part ON l_partkey = p_partkey AND l_quantity < p_size
       GROUP BY p_brand""",
)
def inequality_residuals(t):
    shipped_late = (F.col("l_orderkey") == F.col("o_orderkey")) & (
        F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 5 days")
    )
    small_lot = (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_quantity") < F.col("p_size"))
    return (
        t.lineitem.join(t.part, small_lot)
        .join(t.orders, shipped_late)
        .groupBy("p_brand")
        .agg(F.count("*").alias("n"), unit_sum(discounted(), 4).alias("revenue"))
    )


@query(
    "JON-10",
    "pure_range",
    """SELECT a.event_id AS purchase_id, b.event_id AS error_id FROM events a JOIN events b
       ON a.event_type = 'purchase' AND b.event_type = 'error'
      AND a.ts BETWEEN b.ts AND b.ts + INTERVAL 120 SECOND""",
)
def pure_range(t):
    purchases = t.events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought")
    )
    errors = t.events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("failed")
    )
    return J.band_join(purchases, errors, [], "bought", "failed", 0, 120).select("purchase_id", "error_id")


@F.pandas_udf(T.IntegerType())
def _nation_code(custkey: pd.Series) -> pd.Series:
    return ((custkey * 7 + 3) % 25).astype("int32")


@query(
    "JON-11",
    "udf_key",
    """SELECT n_name, count(*) AS n FROM orders JOIN nation ON (o_custkey * 7 + 3) % 25 = n_nationkey
       GROUP BY n_name""",
)
def udf_key(t):
    keyed = t.orders.select(_nation_code("o_custkey").alias("code"))
    return (
        keyed.join(t.nation, F.col("code") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("n"))
    )


@query(
    "JON-12",
    "derived_table",
    """SELECT p_partkey, part.p_brand, p_retailprice FROM part
       JOIN (SELECT p_brand AS brand, max(p_retailprice) AS top FROM part GROUP BY p_brand) d
         ON part.p_brand = d.brand AND part.p_retailprice = d.top""",
)
def derived_table(t):
    top = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.max("p_retailprice").alias("top"))
    return t.part.join(
        top, (F.col("p_brand") == F.col("brand")) & (F.col("p_retailprice") == F.col("top"))
    ).select("p_partkey", "p_brand", "p_retailprice")


@query(
    "JON-13",
    "anti_join",
    """SELECT c_custkey FROM customer LEFT JOIN orders
         ON c_custkey = o_custkey AND year(o_orderdate) = 1998 WHERE o_orderkey IS NULL""",
)
def anti_join(t):
    year = t.orders.where(F.year("o_orderdate") == 1998)
    return t.customer.join(year, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query(
    "JON-14",
    "exists_not_exists",
    """SELECT l_suppkey, count(*) AS waiting FROM lineitem l1
       WHERE l_returnflag = 'R'
         AND EXISTS (SELECT 1 FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
         AND NOT EXISTS (SELECT 1 FROM lineitem l3 WHERE l3.l_orderkey = l1.l_orderkey
                         AND l3.l_suppkey <> l1.l_suppkey AND l3.l_returnflag = 'R')
       GROUP BY l_suppkey""",
)
def exists_not_exists(t):
    # "Some line of this order has another supplier" holds when the smallest or
    # largest supplier of the order differs; no line meets its siblings.
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.min("l_suppkey").alias("lo"),
        F.max("l_suppkey").alias("hi"),
        F.min(returned).alias("r_lo"),
        F.max(returned).alias("r_hi"),
    )
    s = F.col("l_suppkey")
    return (
        t.lineitem.where("l_returnflag = 'R'")
        .join(per_order, F.col("l_orderkey") == F.col("k"))
        .where(((F.col("lo") != s) | (F.col("hi") != s)) & (F.col("r_lo") == s) & (F.col("r_hi") == s))
        .groupBy("l_suppkey")
        .agg(F.count("*").alias("waiting"))
    )


@query(
    "JON-15",
    "exists_or_exists",
    """SELECT c_nationkey, count(*) AS n FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)
          OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
                     AND year(o_orderdate) = 1997)
       GROUP BY c_nationkey""",
)
def exists_or_exists(t):
    large = t.orders.where("o_totalprice > 480000")
    urgent = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1997))
    flagged = J.exists_flag(t.customer, large, "c_custkey", "o_custkey", "has_large")
    flagged = J.exists_flag(flagged, urgent, "c_custkey", "o_custkey", "has_urgent")
    return (
        flagged.where("has_large OR has_urgent").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    )


@query(
    "JON-16",
    "nested_in",
    """SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (
         SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_partkey IN (
           SELECT p_partkey FROM part WHERE p_name LIKE 'red%'))""",
)
def nested_in(t):
    red = t.part.where(F.col("p_name").like("red%"))
    lines = t.lineitem.where("l_quantity > 49").join(
        red, F.col("l_partkey") == F.col("p_partkey"), "left_semi"
    )
    return t.supplier.join(lines, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select(
        "s_suppkey", "s_name"
    )


@query(
    "JON-17",
    "not_in",
    """SELECT c_custkey, c_nationkey FROM customer
       WHERE nullif(c_nationkey, 5) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)""",
)
def not_in(t):
    rich = t.supplier.where("s_acctbal > 8000")
    key = F.nullif(F.col("c_nationkey"), F.lit(5))
    return J.not_in(t.customer.select("c_custkey", "c_nationkey"), key, rich, "s_nationkey")


@query(
    "JON-17",
    "not_in_with_null",
    """SELECT c_mktsegment, count(*) AS n FROM customer
       WHERE c_nationkey NOT IN (SELECT nullif(s_nationkey, 7) FROM supplier) GROUP BY c_mktsegment""",
)
def not_in_with_null(t):
    keys = t.supplier.select(F.nullif(F.col("s_nationkey"), F.lit(7)).alias("k"))
    kept = J.not_in(t.customer, F.col("c_nationkey"), keys, "k")
    return kept.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "JON-18",
    "in_correlated_count",
    """SELECT c_custkey FROM customer
       WHERE c_custkey % 20 IN (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)""",
)
def in_correlated_count(t):
    placed = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = t.customer.join(placed, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(F.col("c_custkey") % 20 == F.coalesce("n", F.lit(0))).select("c_custkey")


@query(
    "JON-19",
    "scalar_subquery",
    """SELECT o_orderkey, o_totalprice,
         CASE WHEN o_totalprice > 1.8 * (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM orders)
              THEN 'top' ELSE 'high' END AS band
       FROM orders
       WHERE o_totalprice > 1.5 * (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM orders)""",
)
def scalar_subquery(t):
    mean = t.orders.agg((money_sum("o_totalprice") / F.count("*")).alias("mean"))
    joined = t.orders.crossJoin(F.broadcast(mean))
    return joined.where(F.col("o_totalprice") > 1.5 * F.col("mean")).select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_totalprice") > 1.8 * F.col("mean"), "top").otherwise("high").alias("band"),
    )


@query(
    "JON-20",
    "correlated_aggregate",
    """SELECT l_partkey, count(*) AS small_lines,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total
       FROM lineitem l WHERE l_quantity < (SELECT 0.3 * CAST(sum(CAST(i.l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*)
                                           FROM lineitem i WHERE i.l_partkey = l.l_partkey)
       GROUP BY l_partkey""",
)
def correlated_aggregate(t):
    mean = t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(
        (0.3 * money_sum("l_quantity") / F.count("*")).alias("bound")
    )
    return (
        t.lineitem.join(mean, F.col("l_partkey") == F.col("k"))
        .where(F.col("l_quantity") < F.col("bound"))
        .groupBy("l_partkey")
        .agg(F.count("*").alias("small_lines"), money_sum("l_extendedprice").alias("total"))
    )


@query(
    "JON-20",
    "correlated_count",
    """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS pending
       FROM customer""",
)
def correlated_count(t):
    n = t.orders.where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("pending")
    )


_BANDS = [(1, 10), (11, 20), (21, 30), (31, 40), (41, 50)]


@query(
    "JON-21",
    "single_row_report",
    "SELECT * FROM "
    + ", ".join(
        f"""(SELECT count(*) AS n_{i}, count(DISTINCT l_suppkey) AS suppliers_{i},
              CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_{i}
              FROM lineitem WHERE l_quantity BETWEEN {lo} AND {hi})"""
        for i, (lo, hi) in enumerate(_BANDS)
    ),
)
def single_row_report(t):
    # One pass: first per (band, supplier), then the bands side by side.
    band = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(_BANDS):
        band = F.when(F.col("l_quantity").between(lo, hi), i).otherwise(band)
    partial = (
        t.lineitem.groupBy(band.alias("band"), "l_suppkey")
        .agg(F.count("*").alias("n"), F.sum(units("l_extendedprice").cast("decimal(18,0)")).alias("u"))
    )
    columns = []
    for i in range(len(_BANDS)):
        mine = F.col("band") == i
        columns += [
            F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n_{i}"),
            F.count_if(mine).alias(f"suppliers_{i}"),
            (F.sum(F.when(mine, F.col("u"))).cast("double") / 100).alias(f"total_{i}"),
        ]
    return partial.agg(*columns)


def _of_type(t, kind: str, prefix: str):
    return t.events.where(F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"), "user_id",
        F.col("value").alias(f"{prefix}_value"),
    )


@query(
    "JON-22",
    "interval_join",
    """SELECT b.user_id, a.event_id AS click_id, b.event_id AS buy_id
       FROM events a JOIN events b ON a.user_id = b.user_id
        AND a.event_type = 'click' AND b.event_type = 'purchase'
        AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR""",
)
def interval_join(t):
    return J.band_join(
        _of_type(t, "purchase", "buy"), _of_type(t, "click", "click"), ["user_id"], "buy_ts", "click_ts", 0, 3600
    ).select("user_id", "click_id", "buy_id")


@query(
    "JON-23",
    "window_join",
    """SELECT a.user_id, time_bucket(INTERVAL 1 HOUR, a.ts) AS window_start, count(*) AS pairs,
              CAST(sum(CAST(b.value AS DECIMAL(12,2))) AS DOUBLE) AS pair_value
       FROM events a JOIN events b ON a.user_id = b.user_id
        AND a.event_type = 'view' AND b.event_type = 'purchase'
        AND time_bucket(INTERVAL 1 HOUR, a.ts) = time_bucket(INTERVAL 1 HOUR, b.ts)
       GROUP BY 1, 2""",
)
def window_join(t):
    def side(kind: str):
        return t.events.where(F.col("event_type") == kind).withColumn(
            "window_start", F.window("ts", "1 hour").start
        )

    totals = J.window_join_totals(
        side("view"),
        side("purchase"),
        ["user_id", "window_start"],
        [F.count("*").alias("views")],
        [F.count("*").alias("buys"), F.sum(units("value").cast("decimal(18,0)")).alias("spent")],
    )
    return totals.select(
        "user_id",
        "window_start",
        (F.col("views") * F.col("buys")).alias("pairs"),
        ((F.col("spent") * F.col("views")).cast("double") / 100).alias("pair_value"),
    )


@query(
    "JON-24",
    "as_of_join",
    """SELECT a.event_id, a.user_id, b.event_id AS view_id, b.value AS view_value
       FROM (SELECT * FROM events WHERE event_type = 'purchase') a
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b
         ON a.user_id = b.user_id AND a.ts >= b.ts""",
)
def as_of_join(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    joined = J.latest_before(
        purchases, _of_type(t, "view", "view"), ["user_id"], "ts", "view_ts", ["view_id", "view_value"], "event_id"
    )
    return joined.select("event_id", "user_id", "view_id", "view_value")


def with_customer(events, customers):
    """Events enriched from the customer dimension; events of no customer keep NULLs."""
    wanted = customers.select("c_custkey", "c_name", "c_mktsegment")
    return events.join(small_side(wanted), F.col("user_id") == F.col("c_custkey"), "left").select(
        "event_id", "user_id", "c_name", "c_mktsegment"
    )


@query(
    "JON-25",
    "lookup_enrichment",
    """SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
def lookup_enrichment(t):
    return with_customer(t.events, t.customer)


@query(
    "JON-26",
    "cogroup",
    """WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS customers,
                         max(c_acctbal) AS top_balance FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
            s AS (SELECT s_nationkey AS nationkey, count(*) AS suppliers,
                         min(s_acctbal) AS low_balance FROM supplier GROUP BY 1)
       SELECT nationkey, customers, top_balance, suppliers, low_balance
       FROM c FULL JOIN s USING (nationkey)""",
)
def cogroup(t):
    return J.cogroup_totals(
        t.customer.where("c_acctbal > 9000").withColumnRenamed("c_nationkey", "nationkey"),
        t.supplier.withColumnRenamed("s_nationkey", "nationkey"),
        "nationkey",
        [F.count("*").alias("customers"), F.max("c_acctbal").alias("top_balance")],
        [F.count("*").alias("suppliers"), F.min("s_acctbal").alias("low_balance")],
    )


@query(
    "JON-27",
    "broadcast_side",
    f"""SELECT n_name, {REVENUE} AS revenue FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def broadcast_side(t):
    dims = t.supplier.join(small_side(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        t.lineitem.join(small_side(dims), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("n_name")
        .agg(unit_sum(discounted(), 4).alias("revenue"))
    )
