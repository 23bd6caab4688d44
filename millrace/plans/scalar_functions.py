"""Scalar functions: text, numbers, dates, intervals, arrays, maps, JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.plans.registry import query


@query(
    "FUN-01",
    "text",
    """SELECT c_custkey, substr(c_name, 1, 8) AS head, upper(c_mktsegment) AS up,
              lower(c_mktsegment) AS low, split_part(c_name, '#', 2) AS digits,
              c_name || nullif(c_mktsegment, 'BUILDING') AS null_concat,
              c_name || coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS safe_concat
       FROM customer""",
)
def text(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 1, 8).alias("head"),
        F.upper("c_mktsegment").alias("up"),
        F.lower("c_mktsegment").alias("low"),
        F.split("c_name", "#")[1].alias("digits"),
        F.concat("c_name", segment).alias("null_concat"),
        F.concat("c_name", F.coalesce(segment, F.lit(""))).alias("safe_concat"),
    )


@query(
    "FUN-02",
    "charset_literal",
    """SELECT doc_id, 'né' AS marker, contains(text, 'é') AS has_accent FROM documents""",
)
def charset_literal(t):
    return t.documents.select(
        "doc_id",
        S.charset_literal("6EC3A9").alias("marker"),
        F.contains("text", S.charset_literal("C3A9")).alias("has_accent"),
    )


@query(
    "FUN-03",
    "sha2",
    "SELECT doc_id, sha256(text) AS digest, CAST(NULL AS VARCHAR) AS no_bits FROM documents",
)
def sha2(t):
    return t.documents.select(
        "doc_id",
        F.sha2("text", 256).alias("digest"),
        F.expr("sha2(text, cast(null as int))").alias("no_bits"),
    )


@query(
    "FUN-04",
    "rounding",
    """SELECT l_quantity, round(l_quantity, -1) AS half_up, round_even(l_quantity, -1) AS half_even,
              round(l_quantity / 8, 2) AS two_places, count(*) AS n
       FROM lineitem GROUP BY l_quantity""",
)
def rounding(t):
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_quantity").agg(
        F.round(F.first(q), -1).alias("half_up"),
        F.bround(F.first(q), -1).alias("half_even"),
        F.round(F.first(q) / 8, 2).alias("two_places"),
        F.count("*").alias("n"),
    )


@query(
    "FUN-05",
    "arithmetic",
    """SELECT o_orderkey, o_orderkey + o_custkey AS a, o_custkey - o_orderkey AS s,
              abs(o_custkey - o_orderkey) AS d, o_custkey * 3 AS m, o_orderkey % 7 AS r,
              -o_custkey AS neg, CAST(power(o_custkey % 10, 2) AS DOUBLE) AS p,
              CASE WHEN o_custkey % 4 = 0 THEN NULL
                   ELSE CAST(o_orderkey AS DOUBLE) / CAST(o_custkey % 4 AS DOUBLE) END AS q
       FROM orders""",
)
def arithmetic(t):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select(
        o,
        (o + c).alias("a"),
        (c - o).alias("s"),
        F.abs(c - o).alias("d"),
        (c * 3).alias("m"),
        (o % 7).alias("r"),
        F.negate(c).alias("neg"),
        F.pow(c % 10, F.lit(2)).alias("p"),
        S.ratio(o, c % 4).alias("q"),
    )


@query(
    "FUN-06",
    "casts",
    """SELECT o_orderkey, CAST(o_totalprice AS INTEGER) AS rounded_or_cut,
              CAST(CAST(o_totalprice AS DECIMAL(15,1)) AS DOUBLE) AS one_place,
              CAST(o_orderdate AS DATE) AS order_day,
              CAST(o_orderkey AS VARCHAR) AS key_text,
              CAST(o_orderkey AS DOUBLE) AS key_double
       FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice, o_orderdate FROM orders)""",
)
def casts(t):
    # The day goes through unpadded text (1998-2-1), which must be accepted.
    # No date gives no text, where joining with a separator would give an empty one.
    parts = [f("o_orderdate").cast("string") for f in (F.year, F.month, F.day)]
    day = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])
    whole = F.floor("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        whole.cast("int").alias("rounded_or_cut"),
        whole.cast("decimal(15,1)").cast("double").alias("one_place"),
        day.cast("date").alias("order_day"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderkey").cast("double").alias("key_double"),
    )


@query(
    "FUN-07",
    "date_intervals",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 90 AS plus_days,
              CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_months,
              CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS minus_year,
              o_orderdate + INTERVAL 36 HOUR AS plus_hours
       FROM orders""",
)
def date_intervals(t):
    return t.orders.withColumn("d", F.to_date("o_orderdate")).select(
        "o_orderkey",
        F.date_add("d", 90).alias("plus_days"),
        F.expr("d + interval 3 months").alias("plus_months"),
        F.expr("d - interval 1 year").alias("minus_year"),
        F.expr("o_orderdate + interval 36 hours").alias("plus_hours"),
    )


@query(
    "FUN-08",
    "interval_values",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(date_diff('second', o_orderdate, l_shipdate) AS BIGINT) AS gap_seconds,
         CAST(-date_diff('second', o_orderdate, l_shipdate) + 7200 AS BIGINT) AS negated_plus,
         l_shipdate - o_orderdate > INTERVAL 100 DAY AS over_100_days,
         CAST(12 * (l_linenumber % 5) + l_linenumber + 39 AS INTEGER) AS months,
         CAST(12 * (l_linenumber % 5) + l_linenumber < 30 AS BOOLEAN) AS under_30_months
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def interval_values(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    spans = joined.withColumns(
        {
            "gap": F.expr("l_shipdate - o_orderdate"),
            "back": F.expr("-(l_shipdate - o_orderdate) + interval '2' hour"),
            "ym": F.expr(
                "cast(concat(l_linenumber % 5, '-', l_linenumber) as interval year to month)"
            ),
        }
    )

    def seconds(name: str):
        return F.expr(
            f"extract(DAY FROM {name}) * 86400L + extract(HOUR FROM {name}) * 3600L"
            f" + extract(MINUTE FROM {name}) * 60L + cast(extract(SECOND FROM {name}) as bigint)"
        )

    def months(name: str):
        return f"(extract(YEAR FROM {name}) * 12 + extract(MONTH FROM {name}))"

    return spans.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        seconds("gap").alias("gap_seconds"),
        seconds("back").alias("negated_plus"),
        F.expr("gap > interval '100' day").alias("over_100_days"),
        F.expr(months("(ym + interval '3-3' year to month)")).alias("months"),
        F.expr("ym < interval '2-6' year to month").alias("under_30_months"),
    )


@query("FUN-09", "clock", "SELECT o_orderkey, o_custkey FROM orders WHERE epoch(now()) > 0")
def clock(t):
    return t.orders.where(
        (F.unix_timestamp().cast("bigint") > 0) & F.current_timestamp().isNotNull()
    ).select("o_orderkey", "o_custkey")


@query(
    "FUN-10",
    "iso_timestamps",
    """SELECT event_id, date_trunc('second', ts) - INTERVAL 2 HOUR AS instant FROM events""",
)
def iso_timestamps(t):
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    return t.events.select("event_id", F.to_timestamp(written).cast("timestamp_ntz").alias("instant"))


@query(
    "FUN-11",
    "null_handling",
    """SELECT o_orderstatus, CAST(sum(coalesce(nullif(o_custkey % 3, 0), -1)) AS BIGINT) AS filled,
              count(CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 1 END) AS kept,
              count(CASE WHEN o_custkey % 2 = 0 THEN 1 END) AS even
       FROM orders GROUP BY o_orderstatus""",
)
def null_handling(t):
    third = F.col("o_custkey") % 3
    return t.orders.groupBy("o_orderstatus").agg(
        F.sum(F.coalesce(F.nullif(third, F.lit(0)), F.lit(-1))).alias("filled"),
        F.count(F.when(third == 0, None).otherwise(1)).alias("kept"),
        F.count(F.expr("if(o_custkey % 2 = 0, 1, null)")).alias("even"),
    )


@query(
    "FUN-12",
    "arrays",
    """SELECT item, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM (
         SELECT unnest([p_brand, p_type, split_part(p_name, ' ', 1)]) AS item,
                unnest([0, 1, 2]) AS pos FROM part) GROUP BY item""",
)
def arrays(t):
    items = F.array("p_brand", "p_type", F.split("p_name", " ")[0])
    return (
        t.part.select(F.posexplode(items).alias("pos", "item"))
        .groupBy("item")
        .agg(F.count("*").alias("n"), F.sum("pos").alias("pos_sum"))
    )


@query(
    "FUN-13",
    "maps",
    """SELECT key, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM (
         SELECT unnest(['size', 'part', 'fixed']) AS key,
                unnest([CAST(p_size AS BIGINT), p_partkey, 200]) AS value FROM part) GROUP BY key""",
)
def maps(t):
    entries = F.create_map(
        F.lit("size"), F.col("p_size").cast("bigint"),
        F.lit("part"), F.col("p_partkey"),
        F.lit("fixed"), F.lit(200).cast("bigint"),
    )
    return (
        t.part.select(F.explode(entries).alias("key", "value"))
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    )


@query(
    "FUN-14",
    "stack",
    """SELECT p_partkey, 'brand' AS c1, p_brand AS c2 FROM part
       UNION ALL SELECT p_partkey, 'type', p_type FROM part""",
)
def stack(t):
    return t.part.select(
        "p_partkey",
        F.stack(F.lit(2), F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")).alias("c1", "c2"),
    )


@query(
    "FUN-15",
    "json_value",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              json_extract_string(props, '$.addr.country') AS country FROM events""",
)
def json_value(t):
    return t.events.select(
        "event_id",
        S.json_value(F.col("props"), "$.k", "int").alias("k"),
        S.json_value(F.col("props"), "$.addr.country").alias("country"),
    )


@query(
    "FUN-16",
    "json_update",
    """SELECT event_id, '{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR) || '}' AS props
       FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50""",
)
def json_update(t):
    schema = "k INT"
    return t.events.where(F.from_json("props", schema)["k"] >= 50).select(
        "event_id",
        S.json_update(F.col("props"), schema, "k", lambda row: row["k"] + 1).alias("props"),
    )


@query(
    "FUN-17",
    "logic",
    """SELECT (a AND b) AS both, (a OR b) AS either, (NOT a) AS negated, count(*) AS n FROM (
         SELECT nullif(o_orderstatus, 'P') = 'F' AS a, o_totalprice >= 250000 AS b FROM orders)
       GROUP BY 1, 2, 3""",
)
def logic(t):
    a = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    b = F.col("o_totalprice") >= 250000
    return t.orders.groupBy(
        (a & b).alias("both"), (a | b).alias("either"), (~a).alias("negated")
    ).agg(F.count("*").alias("n"))
