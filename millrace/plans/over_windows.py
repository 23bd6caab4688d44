"""OVER-window queries: dedup, top-n, shares, frames, ranks, count windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.functions.exact import money_sum, units
from millrace.operators.ordered import By, Running, count_windows, fired_windows, keep_one, running, top_n
from millrace.plans.registry import query

_D = "CAST({} AS DECIMAL(12,2))".format


@query(
    "WIN-01",
    "dedup_keep_first",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def dedup_keep_first(t):
    return keep_one(t.events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "WIN-01",
    "dedup_keep_last",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_keep_last(t):
    return keep_one(t.events, ["user_id", "event_type"], ["ts", "event_id"], latest=True)


@query(
    "WIN-02",
    "top_n_per_group",
    """SELECT p_brand, p_partkey, p_retailprice,
              CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rn
       FROM part QUALIFY rn <= 5""",
)
def top_n_per_group(t):
    return top_n(
        t.part.select("p_brand", "p_partkey", "p_retailprice"),
        ["p_brand"],
        [By("p_retailprice", False), By("p_partkey")],
        5,
    )


@query(
    "WIN-03",
    "best_and_worst",
    f"""WITH s AS (SELECT l_suppkey AS k, CAST(sum({_D('l_extendedprice')}) AS DOUBLE) / count(*) AS m
                  FROM lineitem GROUP BY 1),
         up AS (SELECT k, rank() OVER (ORDER BY m) AS r FROM s),
         down AS (SELECT k, rank() OVER (ORDER BY m DESC) AS r FROM s)
       SELECT CAST(up.r AS INTEGER) AS rnk, up.k AS worst, down.k AS best
       FROM up JOIN down ON up.r = down.r WHERE up.r <= 10""",
)
def best_and_worst(t):
    # Aggregated first; each rank is cut at 10 per task before the one-task step.
    means = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(
        (money_sum("l_extendedprice") / F.count("*")).alias("m")
    )

    def ranked(order, name: str):
        return (
            means.withColumn("rnk", F.rank().over(Window.orderBy(order)))
            .where("rnk <= 10")
            .select("rnk", F.col("k").alias(name))
        )

    return ranked(F.asc("m"), "worst").join(ranked(F.desc("m"), "best"), "rnk")


@query(
    "WIN-04",
    "share_of_partition",
    f"""SELECT p_type, p_brand, CAST(s AS DOUBLE) AS revenue,
              round(CAST(s AS DOUBLE) * 100 / CAST(sum(s) OVER (PARTITION BY p_type) AS DOUBLE), 6) AS share
       FROM (SELECT p_type, p_brand, sum({_D('l_extendedprice')}) AS s
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
)
def share_of_partition(t):
    sums = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", "p_brand")
        .agg(F.sum(units("l_extendedprice").cast("decimal(18,0)")).alias("s"))
    )
    whole = F.sum("s").over(Window.partitionBy("p_type")).cast("double") / 100
    revenue = F.col("s").cast("double") / 100
    return sums.select(
        "p_type", "p_brand", revenue.alias("revenue"), F.round(revenue * 100 / whole, 6).alias("share")
    )


@query(
    "WIN-05",
    "deviation_from_mean",
    f"""SELECT * FROM (
         SELECT p_brand, m, CAST(s AS DOUBLE) AS monthly,
           round(CAST(sum(s) OVER (PARTITION BY p_brand) AS DOUBLE) / count(*) OVER (PARTITION BY p_brand), 6) AS mean
         FROM (SELECT p_brand, CAST(month(l_shipdate) AS INTEGER) AS m, sum({_D('l_quantity')}) AS s
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))
       WHERE CASE WHEN mean > 0 THEN abs(monthly - mean) / mean ELSE NULL END > 0.1""",
)
def deviation_from_mean(t):
    sums = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", F.month("l_shipdate").alias("m"))
        .agg(money_sum("l_quantity").alias("monthly"))
    )
    brand = Window.partitionBy("p_brand")
    mean = F.round(F.sum("monthly").over(brand) / F.count("*").over(brand), 6)
    off = F.when(F.col("mean") > 0, F.abs(F.col("monthly") - F.col("mean")) / F.col("mean"))
    return sums.withColumn("mean", mean).where(off > 0.1)


@query(
    "WIN-06",
    "cumulative_frames",
    """SELECT o_orderkey, o_custkey,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS BIGINT) AS cume_cents,
         max(o_totalprice) OVER w AS cume_max
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def cumulative_frames(t):
    return running(
        t.orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        [
            Running("cume_cents", "sum", units("o_totalprice")),
            Running("cume_max", "max", F.col("o_totalprice")),
        ],
    ).select("o_orderkey", "o_custkey", "cume_cents", "cume_max")


@query(
    "WIN-07",
    "rank_in_rollup_level",
    f"""SELECT p_type, p_brand, level, CAST(total AS DOUBLE) AS total,
         CAST(rank() OVER (PARTITION BY level, CASE WHEN level = 0 THEN p_type END ORDER BY total DESC) AS INTEGER) AS rnk
       FROM (SELECT p_type, p_brand, CAST(grouping(p_type) + grouping(p_brand) AS INTEGER) AS level,
                    sum({_D('l_quantity')}) AS total
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_type, p_brand))""",
)
def rank_in_rollup_level(t):
    sums = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .rollup("p_type", "p_brand")
        .agg(
            (F.grouping("p_type") + F.grouping("p_brand")).cast("int").alias("level"),
            money_sum("l_quantity").alias("total"),
        )
    )
    parent = F.when(F.col("level") == 0, F.col("p_type"))
    w = Window.partitionBy("level", parent).orderBy(F.desc("total"))
    return sums.withColumn("rnk", F.rank().over(w))


@query(
    "WIN-08",
    "neighbour_periods",
    f"""WITH m AS (SELECT o_orderpriority AS p, date_trunc('month', o_orderdate)::DATE AS mon,
                         CAST(sum({_D('o_totalprice')}) AS DOUBLE) AS s FROM orders GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY mon) AS rn FROM m)
       SELECT a.p, a.mon, a.s, b.s AS prev, c.s AS next FROM r a
       JOIN r b ON a.p = b.p AND a.rn = b.rn + 1 JOIN r c ON a.p = c.p AND a.rn = c.rn - 1""",
)
def neighbour_periods(t):
    monthly = t.orders.groupBy(
        F.col("o_orderpriority").alias("p"), F.to_date(F.trunc("o_orderdate", "month")).alias("mon")
    ).agg(money_sum("o_totalprice").alias("s"))
    w = Window.partitionBy("p").orderBy("mon")
    return monthly.select(
        "p", "mon", "s", F.lag("s").over(w).alias("prev"), F.lead("s").over(w).alias("next")
    ).where("prev IS NOT NULL AND next IS NOT NULL")


@query(
    "WIN-09",
    "rank_in_subquery",
    f"""SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE n_nationkey IN (SELECT k FROM (
           SELECT s_nationkey AS k, rank() OVER (ORDER BY CAST(sum({_D('s_acctbal')}) AS DOUBLE) DESC) AS r
           FROM supplier GROUP BY 1) WHERE r <= 5)
       GROUP BY n_name""",
)
def rank_in_subquery(t):
    balances = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(money_sum("s_acctbal").alias("b"))
    top = balances.withColumn("r", F.rank().over(Window.orderBy(F.desc("b")))).where("r <= 5")
    kept = t.customer.join(top, F.col("c_nationkey") == F.col("k"), "left_semi")
    return (
        kept.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("customers"))
    )


def _windows(t, size, slide=None):
    rows = t.events.select("user_id", "ts", "event_id", units("value").alias("cents"))
    assigned = count_windows(rows, ["user_id"], ["ts", "event_id"], size, slide)
    totals = [F.sum("cents").alias("cents"), F.min("event_id").alias("first_event")]
    return fired_windows(assigned, ["user_id"], totals, size)


@query(
    "WIN-10",
    "count_window_tumbling",
    """SELECT user_id, CAST(floor((rn - 1) / 5) AS BIGINT) AS window_no,
              CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, min(event_id) AS first_event
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       GROUP BY 1, 2 HAVING count(*) = 5""",
)
def count_window_tumbling(t):
    return _windows(t, 5)


@query(
    "WIN-10",
    "count_window_sliding",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
            n AS (SELECT user_id, count(*) AS c FROM events GROUP BY 1),
            w AS (SELECT user_id, c, unnest(range(0, (c // 4) + 1)) AS window_no FROM n)
       SELECT w.user_id, CAST(window_no AS BIGINT) AS window_no,
              CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, min(event_id) AS first_event
       FROM w JOIN r ON r.user_id = w.user_id AND rn BETWEEN window_no * 4 + 1 AND window_no * 4 + 10
       WHERE window_no * 4 + 10 <= c GROUP BY 1, 2""",
)
def count_window_sliding(t):
    return _windows(t, 10, 4)
