"""The 22 TPC-H questions on the columns this data set has.

Absent columns get a substitute predicate.  ``partsupp`` is derived from the
line items: per (part, supplier) the quantity shipped is the availability and
the mean unit price is the supply cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exact import charged, discounted, money_avg, money_sum, unit_sum, units
from millrace.plans.registry import query

_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_VOLUME = f"{_PRICE} * (1 - CAST(l_discount AS DECIMAL(12,2)))"
_PARTSUPP = """ps AS (SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
    CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS ps_availqty,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS ps_supplycost
  FROM lineitem GROUP BY 1, 2)"""


def _day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _between(column: str, start: str, end: str):
    return (F.col(column) >= _day(start)) & (F.col(column) < _day(end))


def _volume():
    return unit_sum(discounted(), 4)


def _partsupp(lines: DataFrame) -> DataFrame:
    """Offers of the given lines; filter lines by part or supplier before, not after."""
    return lines.groupBy(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
    ).agg(
        money_sum("l_quantity").alias("ps_availqty"),
        (money_sum("l_extendedprice") / money_sum("l_quantity")).alias("ps_supplycost"),
    )


def _eq(a: str, b: str):
    return F.col(a) == F.col(b)


@query(
    "TPCH",
    "q1",
    f"""SELECT l_returnflag, l_linestatus,
         CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
         CAST(sum({_PRICE}) AS DOUBLE) AS sum_base_price,
         CAST(sum({_VOLUME}) AS DOUBLE) AS sum_disc_price,
         CAST(sum({_VOLUME} * (1 + CAST(l_tax AS DECIMAL(12,2)))) AS DOUBLE) AS sum_charge,
         CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_qty,
         CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS avg_price,
         CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_disc,
         count(*) AS count_order
       FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02'
       GROUP BY 1, 2 ORDER BY 1, 2""",
)
def q1(t):
    return (
        t.lineitem.where(F.col("l_shipdate") <= _day("2001-09-02"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            money_sum("l_quantity").alias("sum_qty"),
            money_sum("l_extendedprice").alias("sum_base_price"),
            _volume().alias("sum_disc_price"),
            unit_sum(charged(), 6).alias("sum_charge"),
            money_avg("l_quantity").alias("avg_qty"),
            money_avg("l_extendedprice").alias("avg_price"),
            money_avg("l_discount").alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query(
    "TPCH",
    "q2",
    f"""WITH {_PARTSUPP}, x AS (
         SELECT * FROM ps JOIN supplier ON s_suppkey = ps_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')
       SELECT s_acctbal, s_name, n_name, p_partkey, p_brand FROM part JOIN x ON p_partkey = ps_partkey
       WHERE p_size < 15 AND p_type = 'SMALL'
         AND ps_supplycost = (SELECT min(ps_supplycost) FROM x y WHERE y.ps_partkey = p_partkey)
       ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""",
)
def q2(t):
    european = (
        t.supplier.join(t.nation, _eq("s_nationkey", "n_nationkey"))
        .join(t.region.where("r_name = 'EUROPE'"), _eq("n_regionkey", "r_regionkey"))
    )
    wanted = t.part.where("p_size < 15 AND p_type = 'SMALL'")
    lines = t.lineitem.join(wanted, _eq("l_partkey", "p_partkey"), "left_semi").join(
        european, _eq("l_suppkey", "s_suppkey"), "left_semi"
    )
    offers = (
        _partsupp(lines).join(wanted, _eq("ps_partkey", "p_partkey")).join(european, _eq("ps_suppkey", "s_suppkey"))
    )
    w = Window.partitionBy("p_partkey").orderBy("ps_supplycost")
    return (
        offers.withColumn("r", F.rank().over(w))
        .where("r = 1")
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_brand")
        .orderBy(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
        .limit(100)
    )


@query(
    "TPCH",
    "q3",
    f"""SELECT l_orderkey, CAST(sum({_VOLUME}) AS DOUBLE) AS revenue, o_orderdate FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
       GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10""",
)
def q3(t):
    open_orders = (
        t.orders.where(F.col("o_orderdate") < _day("1998-03-15"))
        .join(t.customer.where("c_mktsegment = 'BUILDING'"), _eq("o_custkey", "c_custkey"))
    )
    return (
        t.lineitem.where(F.col("l_shipdate") > _day("1998-03-15"))
        .join(open_orders, _eq("l_orderkey", "o_orderkey"))
        .groupBy("l_orderkey", "o_orderdate")
        .agg(_volume().alias("revenue"))
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
        .limit(10)
        .select("l_orderkey", "revenue", "o_orderdate")
    )


@query(
    "TPCH",
    "q4",
    """SELECT o_orderpriority, count(*) AS order_count FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1997-10-01'
         AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
       GROUP BY o_orderpriority""",
)
def q4(t):
    late = t.lineitem.where("l_returnflag = 'R'")
    return (
        t.orders.where(_between("o_orderdate", "1997-07-01", "1997-10-01"))
        .join(late, _eq("o_orderkey", "l_orderkey"), "left_semi")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("order_count"))
    )


@query(
    "TPCH",
    "q5",
    f"""SELECT n_name, CAST(sum({_VOLUME}) AS DOUBLE) AS revenue FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
       GROUP BY n_name ORDER BY revenue DESC""",
)
def q5(t):
    asia = t.nation.join(t.region.where("r_name = 'ASIA'"), _eq("n_regionkey", "r_regionkey"))
    sellers = t.supplier.join(asia, _eq("s_nationkey", "n_nationkey"))
    placed = t.orders.where(_between("o_orderdate", "1997-01-01", "1998-01-01")).join(
        t.customer, _eq("o_custkey", "c_custkey")
    )
    return (
        t.lineitem.join(sellers, _eq("l_suppkey", "s_suppkey"))
        .join(placed, _eq("l_orderkey", "o_orderkey") & _eq("c_nationkey", "s_nationkey"))
        .groupBy("n_name")
        .agg(_volume().alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


@query(
    "TPCH",
    "q6",
    f"""SELECT CAST(sum({_PRICE} * CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
         AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
)
def q6(t):
    return t.lineitem.where(
        _between("l_shipdate", "1997-01-01", "1998-01-01")
        & F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24)
    ).agg(unit_sum(units("l_extendedprice") * units("l_discount"), 4).alias("revenue"))


@query(
    "TPCH",
    "q7",
    f"""SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, CAST(year(l_shipdate) AS INTEGER) AS l_year,
              CAST(sum({_VOLUME}) AS DOUBLE) AS revenue
       FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
       JOIN customer ON c_custkey = o_custkey JOIN nation n1 ON s_nationkey = n1.n_nationkey
       JOIN nation n2 ON c_nationkey = n2.n_nationkey
       WHERE ((n1.n_name = 'NATION_3' AND n2.n_name = 'NATION_7') OR (n1.n_name = 'NATION_7' AND n2.n_name = 'NATION_3'))
         AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
       GROUP BY 1, 2, 3""",
)
def q7(t):
    pair = t.nation.where(F.col("n_name").isin("NATION_3", "NATION_7"))
    n1 = pair.select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("supp_nation"))
    n2 = pair.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("cust_nation"))
    sellers = t.supplier.join(n1, _eq("s_nationkey", "k1"))
    buyers = t.orders.join(t.customer.join(n2, _eq("c_nationkey", "k2")), _eq("o_custkey", "c_custkey"))
    return (
        t.lineitem.where(_between("l_shipdate", "1996-01-01", "1998-01-01"))
        .join(sellers, _eq("l_suppkey", "s_suppkey"))
        .join(buyers, _eq("l_orderkey", "o_orderkey"))
        .where("supp_nation <> cust_nation")
        .groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year"))
        .agg(_volume().alias("revenue"))
    )


@query(
    "TPCH",
    "q8",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year,
         round(CAST(sum(CASE WHEN sn.n_name = 'NATION_3' THEN {_VOLUME} ELSE 0 END) AS DOUBLE) / CAST(sum({_VOLUME}) AS DOUBLE), 6) AS mkt_share
       FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region ON cn.n_regionkey = r_regionkey
       JOIN nation sn ON s_nationkey = sn.n_nationkey
       WHERE r_name = 'AMERICA' AND p_type = 'ECONOMY'
         AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
       GROUP BY 1""",
)
def q8(t):
    american = t.nation.join(t.region.where("r_name = 'AMERICA'"), _eq("n_regionkey", "r_regionkey")).select(
        F.col("n_nationkey").alias("ck")
    )
    sellers = t.supplier.join(
        t.nation.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("seller")), _eq("s_nationkey", "sk")
    )
    placed = (
        t.orders.where(_between("o_orderdate", "1996-01-01", "1998-01-01"))
        .join(t.customer.join(american, _eq("c_nationkey", "ck")), _eq("o_custkey", "c_custkey"))
    )
    volume = F.when(F.col("seller") == "NATION_3", discounted()).otherwise(0)
    return (
        t.lineitem.join(t.part.where("p_type = 'ECONOMY'"), _eq("l_partkey", "p_partkey"))
        .join(sellers, _eq("l_suppkey", "s_suppkey"))
        .join(placed, _eq("l_orderkey", "o_orderkey"))
        .groupBy(F.year("o_orderdate").alias("o_year"))
        .agg(F.round(unit_sum(volume, 4) / _volume(), 6).alias("mkt_share"))
    )


@query(
    "TPCH",
    "q9",
    f"""WITH {_PARTSUPP}
       SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS o_year,
              round(CAST(sum({_VOLUME}) AS DOUBLE) - sum(ps_supplycost * l_quantity), 2) AS sum_profit
       FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
       JOIN ps ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
       JOIN orders ON o_orderkey = l_orderkey JOIN nation ON s_nationkey = n_nationkey
       WHERE p_name LIKE '%red%' GROUP BY 1, 2""",
)
def q9(t):
    red = t.part.where(F.col("p_name").like("%red%"))
    lines = t.lineitem.join(red, _eq("l_partkey", "p_partkey"))
    sellers = t.supplier.join(t.nation, _eq("s_nationkey", "n_nationkey"))
    cost = _partsupp(lines)
    same = _eq("ps_partkey", "l_partkey") & _eq("ps_suppkey", "l_suppkey")
    profit = _volume() - F.sum(F.col("ps_supplycost") * F.col("l_quantity"))
    return (
        lines.join(sellers, _eq("l_suppkey", "s_suppkey"))
        .join(cost, same)
        .join(t.orders, _eq("l_orderkey", "o_orderkey"))
        .groupBy(F.col("n_name").alias("nation"), F.year("o_orderdate").alias("o_year"))
        .agg(F.round(profit, 2).alias("sum_profit"))
    )


@query(
    "TPCH",
    "q10",
    f"""SELECT c_custkey, c_name, CAST(sum({_VOLUME}) AS DOUBLE) AS revenue, c_acctbal, n_name FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderdate >= TIMESTAMP '1997-10-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND l_returnflag = 'R'
       GROUP BY c_custkey, c_name, c_acctbal, n_name ORDER BY revenue DESC, c_custkey LIMIT 20""",
)
def q10(t):
    # Revenue per customer key first; names join only the twenty that stay.
    placed = t.orders.where(_between("o_orderdate", "1997-10-01", "1998-01-01"))
    top = (
        t.lineitem.where("l_returnflag = 'R'")
        .join(placed, _eq("l_orderkey", "o_orderkey"))
        .groupBy("o_custkey")
        .agg(_volume().alias("revenue"))
        .orderBy(F.desc("revenue"), "o_custkey")
        .limit(20)
    )
    return (
        t.customer.join(top, _eq("c_custkey", "o_custkey"))
        .join(t.nation, _eq("c_nationkey", "n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name")
        .orderBy(F.desc("revenue"), "c_custkey")
    )


@query(
    "TPCH",
    "q11",
    f"""WITH {_PARTSUPP}, g AS (
         SELECT ps_partkey, round(sum(ps_supplycost * ps_availqty), 2) AS value FROM ps
         JOIN supplier ON ps_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         WHERE n_name IN ('NATION_7', 'NATION_3', 'NATION_1') GROUP BY 1)
       SELECT ps_partkey, value FROM g WHERE value > (SELECT sum(value) * 0.001 FROM g)""",
)
def q11(t):
    german = t.supplier.join(
        t.nation.where(F.col("n_name").isin("NATION_7", "NATION_3", "NATION_1")), _eq("s_nationkey", "n_nationkey")
    )
    value = (
        _partsupp(t.lineitem.join(german, _eq("l_suppkey", "s_suppkey"), "left_semi"))
        .groupBy("ps_partkey")
        .agg(F.round(F.sum(F.col("ps_supplycost") * F.col("ps_availqty")), 2).alias("value"))
    )
    bound = value.agg((F.sum("value") * 0.001).alias("bound"))
    return value.crossJoin(F.broadcast(bound)).where("value > bound").drop("bound")


@query(
    "TPCH",
    "q12",
    """SELECT l_returnflag, count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS high_line_count,
              count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS low_line_count
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE l_returnflag IN ('A', 'R') AND l_shipdate > o_orderdate
         AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
       GROUP BY l_returnflag""",
)
def q12(t):
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        t.lineitem.where(
            F.col("l_returnflag").isin("A", "R") & _between("l_shipdate", "1997-01-01", "1998-01-01")
        )
        .join(t.orders, _eq("l_orderkey", "o_orderkey") & (F.col("l_shipdate") > F.col("o_orderdate")))
        .groupBy("l_returnflag")
        .agg(F.count_if(high).alias("high_line_count"), F.count_if(~high).alias("low_line_count"))
    )


@query(
    "TPCH",
    "q13",
    """SELECT c_count, count(*) AS custdist FROM (
         SELECT c_custkey, count(o_orderkey) AS c_count FROM customer
         LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '1-URGENT' GROUP BY c_custkey)
       GROUP BY c_count""",
)
def q13(t):
    placed = t.orders.where("o_orderpriority <> '1-URGENT'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return (
        t.customer.join(placed, _eq("c_custkey", "o_custkey"), "left")
        .groupBy(F.coalesce("n", F.lit(0)).alias("c_count"))
        .agg(F.count("*").alias("custdist"))
    )


@query(
    "TPCH",
    "q14",
    f"""SELECT round(100.0 * CAST(sum(CASE WHEN p_type = 'PROMO' THEN {_VOLUME} ELSE 0 END) AS DOUBLE)
                    / CAST(sum({_VOLUME}) AS DOUBLE), 6) AS promo_revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_shipdate >= TIMESTAMP '1997-09-01' AND l_shipdate < TIMESTAMP '1997-10-01'""",
)
def q14(t):
    promo = F.when(F.col("p_type") == "PROMO", discounted()).otherwise(0)
    return (
        t.lineitem.where(_between("l_shipdate", "1997-09-01", "1997-10-01"))
        .join(t.part, _eq("l_partkey", "p_partkey"))
        .agg(F.round(100.0 * unit_sum(promo, 4) / _volume(), 6).alias("promo_revenue"))
    )


@query(
    "TPCH",
    "q15",
    f"""WITH r AS (SELECT l_suppkey AS k, CAST(sum({_VOLUME}) AS DOUBLE) AS total_revenue FROM lineitem
         WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-04-01' GROUP BY 1)
       SELECT s_suppkey, s_name, total_revenue FROM supplier JOIN r ON s_suppkey = k
       WHERE total_revenue = (SELECT max(total_revenue) FROM r)""",
)
def q15(t):
    revenue = (
        t.lineitem.where(_between("l_shipdate", "1997-01-01", "1997-04-01"))
        .groupBy(F.col("l_suppkey").alias("k"))
        .agg(_volume().alias("total_revenue"))
    )
    best = revenue.withColumn("r", F.rank().over(Window.orderBy(F.desc("total_revenue")))).where("r = 1")
    return t.supplier.join(best, _eq("s_suppkey", "k")).select("s_suppkey", "s_name", "total_revenue")


@query(
    "TPCH",
    "q16",
    """SELECT p_brand, p_type, p_size, count(DISTINCT l_suppkey) AS supplier_cnt FROM lineitem
       JOIN part ON p_partkey = l_partkey
       WHERE p_brand <> 'Brand#15' AND p_type <> 'MEDIUM' AND p_size IN (3, 9, 14, 19, 23, 36, 45, 49)
         AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
       GROUP BY 1, 2, 3""",
)
def q16(t):
    kept = t.part.where("p_brand <> 'Brand#15' AND p_type <> 'MEDIUM'").where(
        F.col("p_size").isin(3, 9, 14, 19, 23, 36, 45, 49)
    )
    poor = t.supplier.where("s_acctbal < 0")
    return (
        t.lineitem.join(kept, _eq("l_partkey", "p_partkey"))
        .join(poor, _eq("l_suppkey", "s_suppkey"), "left_anti")
        .groupBy("p_brand", "p_type", "p_size")
        .agg(F.count_distinct("l_suppkey").alias("supplier_cnt"))
    )


@query(
    "TPCH",
    "q17",
    f"""SELECT round(CAST(sum({_PRICE}) AS DOUBLE) / 7.0, 6) AS avg_yearly FROM lineitem JOIN part ON p_partkey = l_partkey
       WHERE p_brand = 'Brand#23' AND l_quantity < (
         SELECT 0.4 * CAST(sum(CAST(i.l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM lineitem i WHERE i.l_partkey = p_partkey)""",
)
def q17(t):
    lines = t.lineitem.join(t.part.where("p_brand = 'Brand#23'"), _eq("l_partkey", "p_partkey"))
    bound = lines.groupBy(F.col("l_partkey").alias("k")).agg(
        (0.4 * money_sum("l_quantity") / F.count("*")).alias("bound")
    )
    return (
        lines.join(bound, _eq("l_partkey", "k"))
        .where("l_quantity < bound")
        .agg(F.round(money_sum("l_extendedprice") / 7.0, 6).alias("avg_yearly"))
    )


@query(
    "TPCH",
    "q18",
    """SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, q AS sum_qty FROM (
         SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS q FROM lineitem GROUP BY 1)
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       WHERE q > 200 ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 100""",
)
def q18(t):
    big = t.lineitem.groupBy("l_orderkey").agg(money_sum("l_quantity").alias("sum_qty")).where("sum_qty > 200")
    return (
        t.orders.join(big, _eq("o_orderkey", "l_orderkey"))
        .join(t.customer, _eq("o_custkey", "c_custkey"))
        .select("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "sum_qty")
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
        .limit(100)
    )


@query(
    "TPCH",
    "q19",
    f"""SELECT CAST(sum({_VOLUME}) AS DOUBLE) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey
       WHERE (p_brand = 'Brand#12' AND p_size BETWEEN 1 AND 15 AND l_quantity BETWEEN 1 AND 11)
          OR (p_brand = 'Brand#23' AND p_size BETWEEN 1 AND 20 AND l_quantity BETWEEN 10 AND 20)
          OR (p_brand = 'Brand#3' AND p_size BETWEEN 1 AND 25 AND l_quantity BETWEEN 20 AND 30)""",
)
def q19(t):
    branches = [("Brand#12", 15, 1, 11), ("Brand#23", 20, 10, 20), ("Brand#3", 25, 20, 30)]
    fits = F.lit(False)
    for brand, size, low, high in branches:
        fits |= (
            (F.col("p_brand") == brand)
            & F.col("p_size").between(1, size)
            & F.col("l_quantity").between(low, high)
        )
    return t.lineitem.join(t.part, _eq("l_partkey", "p_partkey") & fits).agg(_volume().alias("revenue"))


@query(
    "TPCH",
    "q20",
    f"""WITH {_PARTSUPP}, y AS (
         SELECT l_partkey, l_suppkey, 0.5 * CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS half FROM lineitem
         WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2)
       SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
       WHERE n_name IN ('NATION_3', 'NATION_4', 'NATION_5') AND s_suppkey IN (
         SELECT ps_suppkey FROM ps JOIN y ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
         WHERE ps_availqty > half AND ps_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE 'small%'))""",
)
def q20(t):
    small = t.part.where(F.col("p_name").like("small%"))
    # Availability and the year's half come from one grouping of the same rows.
    year = _between("l_shipdate", "1997-01-01", "1998-01-01")
    stock = (
        t.lineitem.join(small, _eq("l_partkey", "p_partkey"), "left_semi")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            money_sum("l_quantity").alias("available"),
            (0.5 * unit_sum(F.when(year, units("l_quantity")))).alias("half"),
        )
        .where("available > half")
    )
    chosen = t.nation.where(F.col("n_name").isin("NATION_3", "NATION_4", "NATION_5"))
    return (
        t.supplier.join(chosen, _eq("s_nationkey", "n_nationkey"))
        .join(stock, _eq("s_suppkey", "l_suppkey"), "left_semi")
        .select("s_name", "n_name")
    )


@query(
    "TPCH",
    "q21",
    """SELECT s_name, count(*) AS numwait FROM supplier JOIN lineitem l1 ON s_suppkey = l1.l_suppkey
       JOIN orders ON o_orderkey = l1.l_orderkey JOIN nation ON s_nationkey = n_nationkey
       WHERE o_orderstatus = 'F' AND n_name IN ('NATION_2', 'NATION_20') AND l1.l_returnflag = 'R'
         AND EXISTS (SELECT 1 FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
         AND NOT EXISTS (SELECT 1 FROM lineitem l3 WHERE l3.l_orderkey = l1.l_orderkey
                         AND l3.l_suppkey <> l1.l_suppkey AND l3.l_returnflag = 'R')
       GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100""",
)
def q21(t):
    # Other suppliers of an order show in its smallest and largest supplier key.
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))
    finished = t.orders.where("o_orderstatus = 'F'")
    per_order = (
        t.lineitem.join(finished, _eq("l_orderkey", "o_orderkey"), "left_semi")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("lo"),
            F.max("l_suppkey").alias("hi"),
            F.min(returned).alias("r_lo"),
            F.max(returned).alias("r_hi"),
            F.count(returned).alias("returns"),
        )
        .where("lo <> hi AND r_lo = r_hi")
    )
    # One supplier holds all returned lines of the order: each of them counts.
    sellers = t.supplier.join(
        t.nation.where(F.col("n_name").isin("NATION_2", "NATION_20")), _eq("s_nationkey", "n_nationkey")
    )
    return (
        per_order.join(sellers, _eq("r_lo", "s_suppkey"))
        .groupBy("s_name")
        .agg(F.sum("returns").alias("numwait"))
        .orderBy(F.desc("numwait"), "s_name")
        .limit(100)
    )


@query(
    "TPCH",
    "q22",
    """WITH c AS (SELECT c_nationkey AS code, c_acctbal, c_custkey FROM customer WHERE c_nationkey IN (3, 5, 7, 11, 13, 17, 19))
       SELECT code, count(*) AS numcust, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS totacctbal FROM c
       WHERE c_acctbal > (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM c WHERE c_acctbal > 0)
         AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2000-01-01')
       GROUP BY code""",
)
def q22(t):
    chosen = t.customer.where(F.col("c_nationkey").isin(3, 5, 7, 11, 13, 17, 19))
    mean = chosen.where("c_acctbal > 0").agg((money_sum("c_acctbal") / F.count("*")).alias("mean"))
    recent = t.orders.where(F.col("o_orderdate") >= _day("2000-01-01"))
    return (
        chosen.crossJoin(F.broadcast(mean))
        .where("c_acctbal > mean")
        .join(recent, _eq("c_custkey", "o_custkey"), "left_anti")
        .groupBy(F.col("c_nationkey").alias("code"))
        .agg(F.count("*").alias("numcust"), money_sum("c_acctbal").alias("totacctbal"))
    )
