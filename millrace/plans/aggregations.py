"""Grouping, distinct sets, subtotals, distributions and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.functions.exact import discounted, money_avg, money_sum, unit_sum, units
from millrace.operators import aggregates as A
from millrace.operators.ordered import Running, running, top_n
from millrace.plans.registry import query
from millrace.sources.sinks import discard


def dec(column: str) -> str:
    return f"CAST({column} AS DECIMAL(12,2))"


def total(expression: str) -> str:
    return f"CAST(sum({expression}) AS DOUBLE)"


@query(
    "AGG-01",
    "group_by",
    f"""SELECT l_returnflag, l_linestatus, {total(dec('l_quantity'))} AS sum_qty,
         {total(dec('l_extendedprice'))} AS sum_price,
         {total(dec('l_extendedprice'))} / count(l_extendedprice) AS avg_price,
         min(l_discount) AS low, max(l_discount) AS high, count(*) AS n,
         count(nullif(l_linenumber, 1)) AS non_null
       FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2""",
)
def group_by(t):
    return (
        t.lineitem.where(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            money_sum("l_quantity").alias("sum_qty"),
            money_sum("l_extendedprice").alias("sum_price"),
            money_avg("l_extendedprice").alias("avg_price"),
            F.min("l_discount").alias("low"),
            F.max("l_discount").alias("high"),
            F.count("*").alias("n"),
            F.count(F.nullif(F.col("l_linenumber"), F.lit(1))).alias("non_null"),
        )
    )


@query(
    "AGG-02",
    "global_aggregate",
    f"""SELECT count(*) AS n, {total(dec('o_totalprice'))} AS total, max(o_orderdate) AS latest
       FROM orders WHERE o_totalprice < 0""",
)
def global_aggregate(t):
    # One row even though nothing qualifies.
    return t.orders.where("o_totalprice < 0").agg(
        F.count("*").alias("n"),
        money_sum("o_totalprice").alias("total"),
        F.max("o_orderdate").alias("latest"),
    )


@query(
    "AGG-03",
    "count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts,
              count(DISTINCT l_linenumber) AS numbers, count(*) AS n FROM lineitem GROUP BY l_returnflag""",
)
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_linenumber").alias("numbers"),
        F.count("*").alias("n"),
    )


@query(
    "AGG-04",
    "having",
    f"""SELECT o_custkey, {total(dec('o_totalprice'))} AS total FROM orders GROUP BY o_custkey
       HAVING sum({dec('o_totalprice')}) > 2000000 AND min(o_totalprice) > 20000""",
)
def having(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(money_sum("o_totalprice").alias("total"), F.min("o_totalprice").alias("low"))
        .where("total > 2000000 AND low > 20000")
        .select("o_custkey", "total")
    )


@query(
    "AGG-05",
    "having_scalar_subquery",
    f"""SELECT l_partkey, {total(dec('l_quantity'))} AS quantity FROM lineitem GROUP BY l_partkey
       HAVING sum({dec('l_quantity')}) > (SELECT sum({dec('l_quantity')}) / count(DISTINCT l_partkey) * 1.3 FROM lineitem)""",
)
def having_scalar_subquery(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(money_sum("l_quantity").alias("quantity"))
    bound = per_part.agg((F.sum("quantity") / F.count("*") * 1.3).alias("bound"))
    return per_part.crossJoin(F.broadcast(bound)).where("quantity > bound").drop("bound")


@query(
    "AGG-06",
    "constant_keys",
    "SELECT o_orderpriority, CAST(NULL AS INTEGER) AS n FROM orders GROUP BY o_orderpriority",
)
def constant_keys(t):
    grouped = t.orders.groupBy("o_orderpriority", F.lit("a"), F.lit(None).cast("int").alias("n"))
    return grouped.agg(F.count("*")).select("o_orderpriority", "n")


@query(
    "AGG-07",
    "aggregate_of_aggregate",
    f"""SELECT max(c) AS most, min(c) AS least, CAST(sum(s) AS DOUBLE) / count(*) AS mean_total FROM (
         SELECT o_custkey, count(*) AS c, sum({dec('o_totalprice')}) AS s FROM orders GROUP BY o_custkey)""",
)
def aggregate_of_aggregate(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("c"), F.sum(units("o_totalprice").cast("decimal(18,0)")).alias("s")
    )
    return per.agg(
        F.max("c").alias("most"),
        F.min("c").alias("least"),
        (F.sum("s").cast("double") / 100 / F.count("*")).alias("mean_total"),
    )


_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


@query(
    "AGG-08",
    "day_of_week_pivot",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"CAST(sum(CASE WHEN dayname(o_orderdate) = '{d}' THEN {dec('o_totalprice')} END) AS DOUBLE) AS {d.lower()}"
        for d in _DAYS
    )
    + " FROM orders GROUP BY o_orderpriority",
)
def day_of_week_pivot(t):
    day = F.dayofweek("o_orderdate")
    return t.orders.groupBy("o_orderpriority").agg(
        *[
            unit_sum(F.when(day == i + 1, units("o_totalprice"))).alias(d.lower())
            for i, d in enumerate(_DAYS)
        ]
    )


@query(
    "AGG-08",
    "year_over_year",
    f"""WITH w AS (SELECT o_orderpriority AS p, year(o_orderdate) AS y, month(o_orderdate) AS m,
                         sum({dec('o_totalprice')}) AS s FROM orders GROUP BY 1, 2, 3)
       SELECT a.p AS priority, CAST(a.m AS INTEGER) AS month,
              round(CAST(b.s AS DOUBLE) / CAST(a.s AS DOUBLE), 6) AS ratio
       FROM w a JOIN w b ON a.p = b.p AND a.m = b.m AND a.y = 1997 AND b.y = 1998""",
)
def year_over_year(t):
    by = t.orders.groupBy(
        F.col("o_orderpriority").alias("priority"), F.month("o_orderdate").alias("month")
    )
    year = F.year("o_orderdate")
    pair = by.agg(
        unit_sum(F.when(year == 1997, units("o_totalprice"))).alias("a"),
        unit_sum(F.when(year == 1998, units("o_totalprice"))).alias("b"),
    ).where("a IS NOT NULL AND b IS NOT NULL")
    return pair.select("priority", "month", F.round(F.col("b") / F.col("a"), 6).alias("ratio"))


@query(
    "AGG-09",
    "elapsed_buckets",
    """SELECT l_linestatus,
         count(*) FILTER (WHERE d <= 30) AS upto_30,
         count(*) FILTER (WHERE d > 30 AND d <= 60) AS upto_60,
         count(*) FILTER (WHERE d > 60 AND d <= 120) AS upto_120,
         count(*) FILTER (WHERE d > 120) AS beyond
       FROM (SELECT l_linestatus, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY l_linestatus""",
)
def elapsed_buckets(t):
    d = F.date_diff("l_shipdate", "o_orderdate")
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_linestatus").agg(
        F.count_if(d <= 30).alias("upto_30"),
        F.count_if((d > 30) & (d <= 60)).alias("upto_60"),
        F.count_if((d > 60) & (d <= 120)).alias("upto_120"),
        F.count_if(d > 120).alias("beyond"),
    )


@query(
    "AGG-10",
    "before_after_band",
    f"""SELECT * FROM (SELECT l_partkey,
           CAST(sum(CASE WHEN l_shipdate < TIMESTAMP '1998-06-01' THEN {dec('l_quantity')} ELSE 0 END) AS DOUBLE) AS before_qty,
           CAST(sum(CASE WHEN l_shipdate >= TIMESTAMP '1998-06-01' THEN {dec('l_quantity')} ELSE 0 END) AS DOUBLE) AS after_qty
         FROM lineitem GROUP BY l_partkey)
       WHERE before_qty > 0 AND after_qty / before_qty BETWEEN 2.0 / 3.0 AND 3.0 / 2.0""",
)
def before_after_band(t):
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    q = units("l_quantity")
    sums = t.lineitem.groupBy("l_partkey").agg(
        unit_sum(F.when(early, q).otherwise(0)).alias("before_qty"),
        unit_sum(F.when(early, 0).otherwise(q)).alias("after_qty"),
    )
    return sums.where(
        S.in_band(F.col("after_qty"), F.col("before_qty"), F.lit(2.0) / 3.0, F.lit(3.0) / 2.0)
    )


@query(
    "AGG-11",
    "rollup",
    f"""SELECT p_type, p_brand, {total(dec('l_quantity'))} AS quantity, count(*) AS n
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_type, p_brand)""",
)
def rollup(t):
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .rollup("p_type", "p_brand")
        .agg(money_sum("l_quantity").alias("quantity"), F.count("*").alias("n"))
    )


@query(
    "AGG-12",
    "grouping_flags",
    """SELECT status, o_orderpriority, CAST(grouping(status) AS INTEGER) AS g_status,
              CAST(grouping(status) + grouping(o_orderpriority) AS INTEGER) AS level, count(*) AS n
       FROM (SELECT nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)
       GROUP BY ROLLUP (status, o_orderpriority)""",
)
def grouping_flags(t):
    rows = t.orders.select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_orderpriority"
    )
    return rows.rollup("status", "o_orderpriority").agg(
        F.grouping("status").cast("int").alias("g_status"),
        (F.grouping("status") + F.grouping("o_orderpriority")).cast("int").alias("level"),
        F.count("*").alias("n"),
    )


@query(
    "AGG-13",
    "cube",
    """SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
       GROUP BY CUBE (c_mktsegment, c_nationkey)""",
)
def cube(t):
    return t.customer.cube("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))


@query(
    "AGG-13",
    "grouping_sets",
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())""",
)
def grouping_sets(t):
    flag, status, number = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return t.lineitem.groupingSets([[flag, status], [number], []], flag, status, number).agg(
        F.count("*").alias("n")
    )


@query(
    "AGG-14",
    "sample_deviation",
    """SELECT p_brand, round(stddev_samp(l_quantity), 6) AS deviation,
              round(CASE WHEN avg(l_quantity) = 0 THEN NULL ELSE stddev_samp(l_quantity) / avg(l_quantity) END, 6) AS variation
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def sample_deviation(t):
    q = F.col("l_quantity")
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(
            F.round(F.stddev_samp(q), 6).alias("deviation"),
            F.round(S.ratio(F.stddev_samp(q), F.avg(q)), 6).alias("variation"),
        )
    )


@query(
    "AGG-15",
    "percentile",
    """SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.9) AS p90
       FROM lineitem GROUP BY l_returnflag""",
)
def percentile(t):
    return A.exact_percentiles(t.lineitem, ["l_returnflag"], "l_quantity", {"median": 0.5, "p90": 0.9})


@query(
    "AGG-15",
    "percentile_of_prices",
    """SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
              round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem""",
)
def percentile_of_prices(t):
    # Nearly every price is distinct: the case the built-in cannot hold.
    found = A.exact_percentiles(t.lineitem, [], "l_extendedprice", {"median": 0.5, "p99": 0.99})
    return found.select(F.round("median", 6).alias("median"), F.round("p99", 6).alias("p99"))


@query(
    "AGG-16",
    "collect_list",
    """SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS numbers
       FROM lineitem GROUP BY l_orderkey""",
)
def collect_list(t):
    # A list of all values is one row by definition; the values come from a
    # small domain, so each is collected once with its count and then repeated.
    counted = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").cast("int").alias("c"))
    grouped = counted.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "c"))).alias("bag")
    )
    values = F.flatten(
        F.transform("bag", lambda e: F.array_repeat(e["l_linenumber"].cast("string"), e["c"]))
    )
    return grouped.select("l_orderkey", F.array_join(values, ",").alias("numbers"))


@query(
    "AGG-17",
    "select_distinct",
    "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
)
def select_distinct(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "AGG-18",
    "chained_aggregates",
    f"""SELECT l_suppkey, {total(dec('l_quantity'))} AS sum_q, min(l_extendedprice) AS min_p,
              max(l_tax) AS max_t FROM lineitem GROUP BY l_suppkey""",
)
def chained_aggregates(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        money_sum("l_quantity").alias("sum_q"),
        F.min("l_extendedprice").alias("min_p"),
        F.max("l_tax").alias("max_t"),
    )


@query(
    "AGG-19",
    "min_by_max_by",
    """SELECT 'min' AS side, * FROM (SELECT * FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderdate, o_orderkey) = 1)
       UNION ALL SELECT 'max', * FROM (SELECT * FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1)""",
)
def min_by_max_by(t):
    low = A.extreme_row(t.orders, ["o_custkey"], ["o_totalprice", "o_orderdate"], ["o_orderkey"])
    high = A.extreme_row(t.orders, ["o_custkey"], ["o_totalprice"], ["o_orderkey"], largest=True)
    return low.select(F.lit("min").alias("side"), "*").union(high.select(F.lit("max"), "*"))


@query(
    "AGG-20",
    "first_n",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 3""",
)
def first_n(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return top_n(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).drop("rn")


def _spend_fold(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby("user_id", as_index=False, dropna=False).agg(
        cents=("cents", "sum"), top=("top", "max"), n=("n", "sum")
    )


@query(
    "AGG-21",
    "reduce_groups",
    """SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
              max(event_id) AS top, count(*) AS n FROM events GROUP BY user_id""",
)
def reduce_groups(t):
    rows = t.events.select(
        "user_id", units("value").alias("cents"), F.col("event_id").alias("top"), F.lit(1).cast("bigint").alias("n")
    )
    return A.combine_then_reduce(
        rows, ["user_id"], "user_id BIGINT, cents BIGINT, top BIGINT, n BIGINT", _spend_fold
    )


@query(
    "AGG-22",
    "accumulators",
    """SELECT count(*) AS n_rows, CAST(min(l_quantity) AS INTEGER) AS low, CAST(max(l_quantity) AS INTEGER) AS high
       FROM lineitem""",
)
def accumulators(t):
    q = F.col("l_quantity").cast("int")
    rows, seen = A.observed(
        t.lineitem, "line_counters", {"n_rows": F.count("*"), "low": F.min(q), "high": F.max(q)}
    )
    discard(rows.select("l_quantity"))
    got = seen.get
    return t.spark.createDataFrame(
        [(got["n_rows"], got["low"], got["high"])], "n_rows BIGINT, low INT, high INT"
    )


@query(
    "AGG-23",
    "histogram",
    "SELECT CAST(l_quantity AS INTEGER) AS quantity, count(*) AS n FROM lineitem GROUP BY 1",
)
def histogram(t):
    return A.histogram(t.lineitem.select(F.col("l_quantity").cast("int").alias("quantity")), "quantity")


_SUMMARY = ["o_orderkey", "status", "small_price"]


@query(
    "AGG-24",
    "column_summary",
    """WITH s AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
                         CASE WHEN o_totalprice < 100000 THEN o_totalprice END AS small_price FROM orders)
       """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS null_count,
                   count({c}) AS non_null_count FROM s"""
        for c in _SUMMARY
    ),
)
def column_summary(t):
    rows = t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") < 100000, F.col("o_totalprice")).alias("small_price"),
    )
    return A.summary(rows, _SUMMARY)


@query(
    "AGG-25",
    "hash_sample",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE (o_orderkey * 7919 + 13) % 1000 < 150""",
)
def hash_sample(t):
    # Sampling is the operator here: a fixed share of the key space.
    key = F.col("o_orderkey") * 7919 + 13
    return A.hash_sample(t.orders, key, 150, 1000).select("o_orderkey", "o_totalprice")


@query(
    "AGG-26",
    "two_phase",
    f"""SELECT l_partkey, count(*) AS n, {total(dec('l_extendedprice'))} AS price
       FROM lineitem GROUP BY l_partkey""",
)
def two_phase(t):
    return t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("n"), money_sum("l_extendedprice").alias("price")
    )


@query(
    "AGG-27",
    "share_report",
    f"""SELECT year(l_shipdate)::INTEGER AS y,
         round(100 * CAST(sum(CASE WHEN p_type = 'PROMO' THEN {dec('l_extendedprice')} * (1 - {dec('l_discount')}) ELSE 0 END) AS DOUBLE)
               / CAST(sum({dec('l_extendedprice')} * (1 - {dec('l_discount')})) AS DOUBLE), 6) AS promo_share
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def share_report(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    promo = unit_sum(F.when(F.col("p_type") == "PROMO", discounted()).otherwise(0), 4)
    return joined.groupBy(F.year("l_shipdate").alias("y")).agg(
        F.round(100 * promo / unit_sum(discounted(), 4), 6).alias("promo_share")
    )


@query(
    "AGG-27",
    "channel_deviation_bands",
    f"""WITH c AS (
         SELECT o_orderpriority AS p,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {dec('o_totalprice')} END) AS DOUBLE) AS f,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {dec('o_totalprice')} END) AS DOUBLE) AS o,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN {dec('o_totalprice')} END) AS DOUBLE) AS w
         FROM orders GROUP BY 1)
       SELECT p, round(f / ((f + o + w) / 3) * 100, 6) AS f_dev, round(o / ((f + o + w) / 3) * 100, 6) AS o_dev,
              round(w / ((f + o + w) / 3) * 100, 6) AS w_dev
       FROM c WHERE f BETWEEN 0.8 * o AND 1.2 * o""",
)
def channel_deviation_bands(t):
    def of(status: str):
        return unit_sum(F.when(F.col("o_orderstatus") == status, units("o_totalprice")))

    sums = t.orders.groupBy(F.col("o_orderpriority").alias("p")).agg(
        of("F").alias("f"), of("O").alias("o"), of("P").alias("w")
    )
    mean = (F.col("f") + F.col("o") + F.col("w")) / 3
    return sums.where(F.col("f").between(0.8 * F.col("o"), 1.2 * F.col("o"))).select(
        "p", *[F.round(F.col(c) / mean * 100, 6).alias(f"{c}_dev") for c in "fow"]
    )


@query(
    "AGG-28",
    "running_keyed_sum",
    """SELECT event_id, user_id,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_cents FROM events""",
)
def running_keyed_sum(t):
    rows = t.events.select("event_id", "user_id", "ts", units("value").alias("cents"))
    return running(
        rows, ["user_id"], ["ts", "event_id"], [Running("running_cents", "sum", F.col("cents"))]
    ).select("event_id", "user_id", "running_cents")


@query(
    "AGG-29",
    "overlap_counts",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
            b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')
       SELECT CAST(count(*) FILTER (WHERE b.k IS NULL) AS BIGINT) AS only_first,
              CAST(count(*) FILTER (WHERE a.k IS NULL) AS BIGINT) AS only_second,
              CAST(count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS BIGINT) AS both
       FROM a FULL JOIN b ON a.k = b.k""",
)
def overlap_counts(t):
    # One grouping gives both membership flags; no join is needed.
    flags = t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("a"),
        F.bool_or(F.col("o_orderstatus") == "O").alias("b"),
    )
    return flags.agg(
        F.count_if(F.col("a") & ~F.col("b")).alias("only_first"),
        F.count_if(~F.col("a") & F.col("b")).alias("only_second"),
        F.count_if(F.col("a") & F.col("b")).alias("both"),
    )


@query(
    "AGG-30",
    "segment_histogram",
    f"""SELECT segment, count(*) AS customers, segment * 50000 AS segment_base FROM (
         SELECT o_custkey, CAST(floor(sum({dec('o_totalprice')}) / 50000) AS INTEGER) AS segment
         FROM orders GROUP BY o_custkey) GROUP BY segment""",
)
def segment_histogram(t):
    spend = t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("s"))
    return (
        spend.groupBy(F.floor(F.col("s") / 50000).cast("int").alias("segment"))
        .agg(F.count("*").alias("customers"))
        .withColumn("segment_base", F.col("segment") * 50000)
    )
