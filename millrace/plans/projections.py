"""Projections, filters, predicates and row functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.exact import discounted, money_sum, unit_sum, units
from millrace.operators import projection as P
from millrace.plans.registry import query


@query(
    "PRJ-01",
    "select_star",
    """SELECT o.*, CAST(year(o_orderdate) AS INTEGER) AS order_year,
              o_orderkey * 2 + 1 AS odd_key FROM orders o""",
)
def select_star(t):
    return t.orders.select(
        "*", F.year("o_orderdate").alias("order_year"), (F.col("o_orderkey") * 2 + 1).alias("odd_key")
    )


@query(
    "PRJ-02",
    "where",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE nullif(o_orderstatus, 'P') <> 'F' AND o_totalprice > 100000""",
)
def where(t):
    # A NULL comparison drops the row: status P is neither F nor not F here.
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.where((status != "F") & (F.col("o_totalprice") > 100000)).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "PRJ-03",
    "add_columns",
    "SELECT *, s_suppkey + s_nationkey AS key_sum, upper(s_name) AS loud FROM supplier",
)
def add_columns(t):
    return P.add_columns(
        t.supplier,
        {"key_sum": F.col("s_suppkey") + F.col("s_nationkey"), "loud": F.upper("s_name")},
    )


@query(
    "PRJ-04",
    "add_or_replace_columns",
    """SELECT p_partkey + 1 AS p_partkey, p_name, p_brand, p_type,
              p_size * 2 AS p_size, p_retailprice, p_partkey + p_size AS mixed FROM part""",
)
def add_or_replace_columns(t):
    return P.add_or_replace_columns(
        t.part,
        {
            "p_partkey": F.col("p_partkey") + 1,
            "p_size": F.col("p_size") * 2,
            "mixed": F.col("p_partkey") + F.col("p_size"),
        },
    )


@query(
    "PRJ-05",
    "rename_columns",
    """SELECT c_custkey AS id, c_name, c_nationkey AS nation, c_acctbal, c_mktsegment
       FROM customer""",
)
def rename_columns(t):
    return P.rename_columns(t.customer, {"c_custkey": "id", "c_nationkey": "nation"})


@query("PRJ-06", "drop_columns", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def drop_columns(t):
    return P.drop_columns(t.customer, "c_name", "c_nationkey")


@query("PRJ-07", "project_positions", "SELECT o_totalprice, o_orderdate, o_orderstatus FROM orders")
def project_positions(t):
    return P.project_positions(t.orders, 3, 4, 2)


@query("PRJ-08", "regex_columns", "SELECT p_brand, p_size FROM part")
def regex_columns(t):
    return P.select_matching(t.part, r"p_(brand|s.*)")


@query(
    "PRJ-09",
    "case_if",
    """SELECT p_partkey,
         CASE WHEN p_size > 30 THEN 'big' WHEN p_size > 10 THEN 'mid' END AS searched,
         CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 ELSE 0 END AS simple,
         CASE WHEN p_size > 25 THEN p_name END AS only_if
       FROM part""",
)
def case_if(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(size > 30, "big").when(size > 10, "mid").alias("searched"),
        F.when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "SMALL", 2).otherwise(0).alias("simple"),
        F.expr("if(p_size > 25, p_name, null)").alias("only_if"),
    )


@query(
    "PRJ-10",
    "in_between",
    """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS revenue,
              count(*) AS n FROM lineitem
       WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
         AND l_returnflag IN ('A', 'R')""",
)
def in_between(t):
    kept = t.lineitem.where(
        F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24)
        & F.col("l_returnflag").isin("A", "R")
    )
    return kept.agg(
        unit_sum(units("l_extendedprice") * units("l_discount"), 4).alias("revenue"),
        F.count("*").alias("n"),
    )


@query(
    "PRJ-11",
    "like",
    """SELECT p_partkey, p_name FROM part
       WHERE p_name LIKE '%ed %' OR p_name LIKE '_ot%'""",
)
def like(t):
    return t.part.where(F.col("p_name").like("%ed %") | F.col("p_name").like("_ot%")).select(
        "p_partkey", "p_name"
    )


@query(
    "PRJ-12",
    "null_tests",
    """SELECT o_orderpriority, count(*) FILTER (WHERE s IS NULL) AS missing,
              count(*) FILTER (WHERE s IS NOT NULL) AS present
       FROM (SELECT o_orderpriority, nullif(o_orderstatus, 'O') AS s FROM orders)
       GROUP BY o_orderpriority""",
)
def null_tests(t):
    s = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(s.isNull()).alias("missing"), F.count_if(s.isNotNull()).alias("present")
    )


@query(
    "PRJ-13",
    "coalesce_mixed",
    """SELECT first_known, count(*) AS n FROM (
         SELECT coalesce(nullif(l_returnflag, 'N'), CAST(l_linenumber AS VARCHAR)) AS first_known
         FROM lineitem) GROUP BY first_known""",
)
def coalesce_mixed(t):
    first_known = P.coalesce_text(
        F.nullif(F.col("l_returnflag"), F.lit("N")), F.col("l_linenumber")
    )
    return t.lineitem.groupBy(first_known.alias("first_known")).agg(F.count("*").alias("n"))


@query(
    "PRJ-14",
    "or_of_ands",
    """SELECT p_brand, count(*) AS n,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))) AS DOUBLE) AS revenue
       FROM lineitem, part
       WHERE (p_partkey = l_partkey AND p_brand = 'Brand#12' AND l_quantity BETWEEN 1 AND 11)
          OR (p_partkey = l_partkey AND p_brand = 'Brand#23' AND l_quantity BETWEEN 10 AND 20)
          OR (p_partkey = l_partkey AND p_brand = 'Brand#3' AND l_quantity BETWEEN 20 AND 30)
       GROUP BY p_brand""",
)
def or_of_ands(t):
    key = F.col("p_partkey") == F.col("l_partkey")
    branches = [("Brand#12", 1, 11), ("Brand#23", 10, 20), ("Brand#3", 20, 30)]
    condition = F.lit(False)
    for brand, low, high in branches:
        condition |= key & (F.col("p_brand") == brand) & F.col("l_quantity").between(low, high)
    return (
        t.lineitem.join(t.part, condition)
        .groupBy("p_brand")
        .agg(F.count("*").alias("n"), unit_sum(discounted(), 4).alias("revenue"))
    )


@query(
    "PRJ-15",
    "nested_access",
    """SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              substr(event_type, 1, 1) AS initial FROM events""",
)
def nested_access(t):
    events = t.events.select(
        "event_id",
        F.struct(
            F.col("event_type").alias("type"),
            F.from_json("props", "MAP<STRING, INT>").alias("props"),
            F.split("event_type", "").alias("letters"),
        ).alias("event"),
    )
    return events.select(
        "event_id",
        F.col("event.type").alias("kind"),
        F.col("event.props").getItem("k").alias("k"),
        F.col("event.letters").getItem(0).alias("initial"),
    )


@query(
    "PRJ-16",
    "chained_ctes",
    """WITH per_customer AS (
         SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
       busy AS (SELECT o_custkey, n FROM per_customer WHERE n >= 10)
       SELECT c_mktsegment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders_placed
       FROM busy JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""",
)
def chained_ctes(t):
    return t.spark.sql(
        """
        WITH per_customer AS (
          SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey
        ), busy AS (
          SELECT * FROM per_customer WHERE n >= 10
        )
        SELECT c_mktsegment, count(*) AS customers, sum(n) AS orders_placed
        FROM busy JOIN {customer} ON c_custkey = o_custkey
        GROUP BY c_mktsegment
        """,
        orders=t.orders,
        customer=t.customer,
    )


@query(
    "PRJ-17",
    "map_rows",
    """SELECT event_id, upper(event_type) || '/' || CAST(user_id AS VARCHAR) AS label,
              event_id % 7 AS slot FROM events""",
)
def map_rows(t):
    return t.events.select(
        "event_id",
        F.concat(F.upper("event_type"), F.lit("/"), F.col("user_id").cast("string")).alias("label"),
        (F.col("event_id") % 7).alias("slot"),
    )


@query(
    "PRJ-18",
    "flat_map_tokens",
    r"""SELECT doc_id, count(*) AS tokens, max(length(w)) AS longest
        FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM documents)
        WHERE w <> '' GROUP BY doc_id""",
)
def flat_map_tokens(t):
    tokens = P.word_rows(t.documents, "text", "w", "doc_id")
    return tokens.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.max(F.length("w")).cast("bigint").alias("longest")
    )


@query(
    "PRJ-19",
    "word_count",
    r"""SELECT w AS word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM documents)
        WHERE w <> '' GROUP BY w""",
)
def word_count(t):
    return P.word_rows(t.documents, "text", "word").groupBy("word").agg(F.count("*").alias("n"))


@query(
    "PRJ-20",
    "side_outputs",
    """SELECT CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_orderstatus = 'P' THEN 'pending'
                   ELSE 'main' END AS output,
              count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
       FROM orders GROUP BY 1""",
)
def side_outputs(t):
    large, pending = P.SideOutput("large"), P.SideOutput("pending")
    split = P.split_rows(
        t.orders,
        {large: F.col("o_totalprice") > 400000, pending: F.col("o_orderstatus") == "P"},
    )
    # The split is one pass; ``split.main`` and ``split.side(large)`` are filters
    # of the same tagged frame for callers that need whole rows.
    return split.tagged.groupBy(F.col("__tag").alias("output")).agg(
        F.count("*").alias("n"), money_sum("o_totalprice").alias("total")
    )
