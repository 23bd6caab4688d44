"""Sorting, limits and explicit data layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.exact import money_sum
from millrace.operators import distribution as D
from millrace.operators.dml import work_database
from millrace.plans.registry import query


@query(
    "SRT-01",
    "order_by",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders
       ORDER BY status ASC NULLS FIRST, o_totalprice DESC NULLS LAST, o_orderkey""",
)
def order_by(t):
    return t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        "o_totalprice",
    ).orderBy(F.asc("status"), F.desc("o_totalprice"), "o_orderkey")


@query(
    "SRT-02",
    "top_k",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
)
def top_k(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(25)
    )


@query(
    "SRT-03",
    "offset_fetch",
    """SELECT c_custkey, c_acctbal FROM customer
       ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 15""",
)
def offset_fetch(t):
    return (
        t.customer.select("c_custkey", "c_acctbal")
        .orderBy("c_acctbal", "c_custkey")
        .offset(15)
        .limit(20)
    )


@query(
    "SRT-04",
    "order_by_expression",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part
       ORDER BY split_part(p_name, ' ', 2), CAST(p_size AS DOUBLE) DESC, p_partkey LIMIT 40""",
)
def order_by_expression(t):
    named = t.part.withColumn("name_parts", F.split("p_name", " "))
    return (
        named.orderBy(
            F.col("name_parts")[1], F.col("p_size").cast("double").desc(), "p_partkey"
        )
        .limit(40)
        .select("p_partkey", F.col("name_parts")[0].alias("first_word"))
    )


@query("SRT-05", "sort_by", "SELECT o_custkey, o_orderkey FROM orders")
def sort_by(t):
    return t.orders.select("o_custkey", "o_orderkey").sortWithinPartitions("o_custkey", "o_orderkey")


@query("SRT-06", "cluster_by", "SELECT c_nationkey, c_custkey FROM customer")
def cluster_by(t):
    return D.cluster_by(t.customer.select("c_nationkey", "c_custkey"), "c_nationkey", "c_custkey")


@query(
    "SRT-07",
    "limit_after_sort",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50""",
)
def limit_after_sort(t):
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
        .limit(50)
    )


@query(
    "SRT-08",
    "custom_partitioner",
    """SELECT CAST(o_custkey % 5 AS INTEGER) AS part_no, count(*) AS n,
              CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
       FROM orders GROUP BY 1""",
)
def custom_partitioner(t):
    # Five logical partitions, each spread over as many tasks as the cluster takes.
    width = max(1, int(t.spark.conf.get("spark.sql.shuffle.partitions")) // 5)
    spread = F.col("o_custkey") % 5 + 5 * F.pmod(F.xxhash64("o_orderkey"), F.lit(width))
    placed = D.partition_by_id(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), spread, 5 * width)
    return placed.groupBy((F.spark_partition_id() % 5).alias("part_no")).agg(
        F.count("*").alias("n"), money_sum("o_totalprice").alias("total")
    )


@query(
    "SRT-09",
    "key_selector",
    """SELECT lower(substr(c_mktsegment, 1, 2)) || '-' || CAST(c_nationkey % 3 AS VARCHAR) AS k,
              count(*) AS n FROM customer GROUP BY 1""",
)
def key_selector(t):
    key = F.concat(
        F.lower(F.substring("c_mktsegment", 1, 2)),
        F.lit("-"),
        (F.col("c_nationkey") % 3).cast("string"),
    )
    return t.customer.groupBy(key.alias("k")).agg(F.count("*").alias("n"))


@query(
    "SRT-10",
    "pre_keyed",
    """SELECT o_orderpriority, count(*) AS lines,
              CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority""",
)
def pre_keyed(t):
    # Both tables are written once by the join key; the join itself then
    # reads matching buckets and has no exchange on either side.
    db = work_database(t.spark)
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    orders = D.save_keyed(t.orders.select("o_orderkey", "o_orderpriority"), f"{db}.o", "o_orderkey", buckets)
    lines = D.save_keyed(t.lineitem.select("l_orderkey", "l_quantity"), f"{db}.l", "l_orderkey", buckets)
    return (
        orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("lines"), money_sum("l_quantity").alias("quantity"))
    )


@query(
    "SRT-11",
    "redistribute",
    "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang",
)
def redistribute(t):
    spread = D.rebalance(t.documents.select("lang", "n_chars"))
    return spread.groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "SRT-11",
    "layouts",
    """SELECT 'round-robin' AS layout, count(*) AS n FROM documents
       UNION ALL SELECT 'forward', count(*) FROM documents
       UNION ALL SELECT 'broadcast', count(*) FROM nation""",
)
def layouts(t):
    # Rows that are where the layout says: dealt in turn over all partitions,
    # left where they were read, and all of a small table in every partition.
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    here = F.spark_partition_id()
    dealt = D.rebalance(t.documents.select("doc_id"), n).groupBy(here.alias("p")).agg(F.count("*").alias("c"))
    in_turn = dealt.agg(F.lit("round-robin").alias("layout"), F.sum("c").alias("n"))
    kept = t.documents.select("doc_id", here.alias("before")).where("doc_id IS NOT NULL")
    forward = kept.where(F.col("before") == here).agg(F.lit("forward"), F.count("*"))
    copies = D.to_every_partition(t.nation.select("n_nationkey"), n).groupBy(here.alias("p")).agg(
        F.count("*").alias("c")
    )
    everywhere = copies.agg(F.lit("broadcast"), F.when(F.count("*") == n, F.min("c")))
    return in_turn.union(forward).union(everywhere)
