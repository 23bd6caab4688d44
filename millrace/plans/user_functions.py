"""Scalar, vectorised, table and aggregate user functions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import metrics as M
from millrace.functions.exact import units
from millrace.operators import aggregates as A
from millrace.operators.distribution import explained
from millrace.operators.ordered import By, top_n
from millrace.plans.registry import REGISTRY, query
from millrace.sources.sinks import discard


@F.udf(returnType=T.LongType(), useArrow=True)
def add_one(x):
    return None if x is None else x + 1


@F.pandas_udf(T.StringType())
def initials(names: pd.Series) -> pd.Series:
    return names.str.split(" ").map(lambda ws: "".join(w[:1] for w in ws))


@F.pandas_udf(T.BooleanType())
def is_round(price: pd.Series) -> pd.Series:
    return (price * 100).round().astype("int64") % 10 == 0


@query("UDF-01", "scalar", "SELECT c_custkey + 1 AS next_key, c_name FROM customer")
def scalar(t):
    return t.customer.select(add_one("c_custkey").alias("next_key"), "c_name")


@query(
    "UDF-02",
    "vectorised",
    """SELECT p_partkey, substr(split_part(p_name, ' ', 1), 1, 1) || substr(split_part(p_name, ' ', 2), 1, 1) AS letters
       FROM part""",
)
def vectorised(t):
    return t.part.select("p_partkey", initials("p_name").alias("letters"))


@query(
    "UDF-03",
    "in_where_and_key",
    """SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey + 1 = c_custkey
       WHERE CAST(round(o_totalprice * 100) AS BIGINT) % 10 = 0 GROUP BY c_mktsegment""",
)
def in_where_and_key(t):
    kept = t.orders.where(is_round("o_totalprice")).select(add_one("o_custkey").alias("k"))
    return (
        kept.join(t.customer, F.col("k") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("n"))
    )


class _NameWords:
    """One row per word of a name with its position."""

    def eval(self, name: str):
        for i, word in enumerate((name or "").split(" ")):
            yield word, i


@query(
    "UDF-04",
    "table_function",
    """SELECT word, pos, count(*) AS n FROM (
         SELECT split_part(p_name, ' ', 1) AS word, 0 AS pos FROM part
         UNION ALL SELECT split_part(p_name, ' ', 2), 1 FROM part) GROUP BY word, pos""",
)
def table_function(t):
    # A call per row: without Arrow its rows do not go out as a batch each.  Only the names
    # move, and over all cores, because a small file is one or two tasks.
    words = F.udtf(_NameWords, returnType="word STRING, pos INT", useArrow=False)
    names = t.part.select("p_name").repartition(t.spark.sparkContext.defaultParallelism)
    return (
        names.lateralJoin(words(F.col("p_name").outer()))
        .groupBy("word", "pos")
        .agg(F.count("*").alias("n"))
    )


class _BatchWords:
    """One row per word of a name with its position, a batch of names per call.

    A missing name has the one empty word of an empty name.
    """

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        names = pc.fill_null(batch.column(0), "")
        split = pc.split_pattern(names, " ")
        counts = pc.list_value_length(split).to_numpy()
        first = np.repeat(np.cumsum(counts) - counts, counts)
        at = pa.array(np.arange(len(first)) - first, pa.int32())
        yield pa.table({"word": pc.list_flatten(split), "pos": at})


@query("UDF-04", "table_function_batches", REGISTRY["udf_04_table_function"].sql)
def table_function_batches(t):
    words = F.arrow_udtf(_BatchWords, returnType="word STRING, pos INT")
    found = words(t.part.select("p_name").asTable())
    return found.groupBy("word", "pos").agg(F.count("*").alias("n"))


def _weighted_fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Accumulator of a weighted mean; retractions carry negative weights."""
    return rows.groupby("user_id", as_index=False, dropna=False)[["weighted", "weight"]].sum()


@query(
    "UDF-05",
    "aggregate_function",
    """WITH w AS (SELECT user_id, CASE WHEN event_type = 'error' THEN -1 ELSE 2 END AS weight,
                         CAST(round(value * 100) AS BIGINT) AS cents FROM events)
       SELECT user_id, CAST(sum(weight) AS BIGINT) AS weight,
              CASE WHEN sum(weight) <> 0 THEN CAST(sum(cents * weight) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) END AS mean
       FROM w GROUP BY user_id""",
)
def aggregate_function(t):
    # accumulate = a row's contribution, retract = the same with a negative
    # weight, merge = the fold itself; partial folds run before the shuffle.
    weight = F.when(F.col("event_type") == "error", -1).otherwise(2).cast("bigint")
    rows = t.events.select(
        "user_id", (units("value") * weight).alias("weighted"), weight.alias("weight")
    )
    sums = A.combine_then_reduce(
        rows, ["user_id"], "user_id BIGINT, weighted BIGINT, weight BIGINT", _weighted_fold
    )
    return sums.select("user_id", "weight", F.try_divide("weighted", "weight").alias("mean"))


@F.pandas_udf(T.DoubleType())
def series_mean(values: pd.Series) -> float:
    return float(values.sum()) / len(values)


@query(
    "UDF-06",
    "pandas_aggregate_over",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day,
                         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS cents FROM events GROUP BY 1, 2)
       SELECT event_type, day, sum(cents) OVER w / count(*) OVER w AS mean_of_7 FROM d
       WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def pandas_aggregate_over(t):
    # The window runs over daily totals, so a partition has one row per day.
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(units("value")).cast("double").alias("cents")
    )
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(-6, 0)
    return daily.select("event_type", "day", series_mean("cents").over(w).alias("mean_of_7"))


@query(
    "UDF-07",
    "table_aggregate_top2",
    """SELECT p_brand, p_retailprice, CAST(rn AS INTEGER) AS rn FROM (
         SELECT p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn
         FROM part) WHERE rn <= 2""",
)
def table_aggregate_top2(t):
    best = top_n(t.part, ["p_brand"], [By("p_retailprice", False), By("p_partkey")], 2)
    return best.select("p_brand", "p_retailprice", "rn")


@query(
    "UDF-08",
    "map_view_counts",
    """SELECT user_id, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts
       FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY user_id""",
)
def map_view_counts(t):
    counted = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("event_type", "n")))
    pairs = F.transform(entries, lambda e: F.concat(e["event_type"], F.lit("="), e["n"].cast("string")))
    return counted.groupBy("user_id").agg(F.array_join(pairs, ",").alias("counts"))


@query(
    "UDF-09",
    "registered_function",
    "SELECT s_suppkey + 1 AS k, s_name FROM supplier",
)
def registered_function(t):
    t.spark.udf.register("millrace_add_one", add_one)
    return t.spark.sql("SELECT millrace_add_one(s_suppkey) AS k, s_name FROM {s}", s=t.supplier)


@query(
    "UDF-09",
    "lookup_order",
    """SELECT stage, s_suppkey, s_suppkey + added AS k FROM supplier, (VALUES
         ('catalog alone', 100), ('temporary beside it', 1), ('catalog by its full name', 100),
         ('temporary dropped', 100)) AS x(stage, added)""",
)
def lookup_order(t):
    # A temporary function hides the catalog's one of the same name; the full name still
    # finds the catalog's.  Names are resolved when a plan is built.
    spark, name = t.spark, f"millrace_k_{uuid.uuid4().hex[:12]}"
    catalog = f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"

    def answered(stage: str, call: str):
        return spark.sql(f"SELECT '{stage}' AS stage, s_suppkey, {call} AS k FROM {{s}}", s=t.supplier)

    spark.sql(f"CREATE FUNCTION {name}(x BIGINT) RETURNS BIGINT RETURN x + 100")
    try:
        found = [answered("catalog alone", f"{name}(s_suppkey)")]
        spark.udf.register(name, add_one)
        found.append(answered("temporary beside it", f"{name}(s_suppkey)"))
        found.append(answered("catalog by its full name", f"{catalog}.{name}(s_suppkey)"))
        spark.sql(f"DROP TEMPORARY FUNCTION {name}")
        found.append(answered("temporary dropped", f"{name}(s_suppkey)"))
    finally:
        spark.sql(f"DROP FUNCTION {name}")
    return reduce(lambda a, b: a.union(b), found)


@query(
    "UDF-10",
    "user_metrics",
    """SELECT count(*) AS handled, count(*) FILTER (WHERE event_type = 'error') AS errors,
              min(value) AS low, max(value) AS high FROM events""",
)
def user_metrics(t):
    rows, seen = A.observed(
        t.events,
        "event_metrics",
        {
            "handled": F.count("*"),
            "errors": F.count_if(F.col("event_type") == "error"),
            "low": F.min("value"),
            "high": F.max("value"),
        },
    )
    discard(rows.select("event_id"))
    got = seen.get
    return t.spark.createDataFrame(
        [(got["handled"], got["errors"], got["low"], got["high"])],
        "handled BIGINT, errors BIGINT, low DOUBLE, high DOUBLE",
    )


@query(
    "UDF-10",
    "distribution_and_meter",
    """WITH c AS (SELECT CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE value IS NOT NULL),
            r AS (SELECT cents, row_number() OVER (ORDER BY cents) AS rn, count(*) OVER () AS n,
                         greatest(length(bin(abs(cents))) - 7, 0)::INTEGER AS s FROM c),
            b AS (SELECT sign(cents) * ((abs(cents) >> s) << s) AS low_end, rn, n FROM r),
            m AS (SELECT epoch_us(ts) // 1000000 AS sec FROM events WHERE ts IS NOT NULL)
       SELECT (SELECT count(*) FROM events WHERE event_type = 'error') AS errors,
              (SELECT count(*) FROM c) AS n, (SELECT CAST(sum(cents) AS BIGINT) FROM c) AS total,
              (SELECT min(cents) FROM c) AS low, (SELECT max(cents) FROM c) AS high,
              (SELECT CAST(low_end AS BIGINT) FROM b WHERE rn = (n * 50 + 99) // 100) AS median,
              (SELECT CAST(low_end AS BIGINT) FROM b WHERE rn = (n * 95 + 99) // 100) AS p95,
              (SELECT count(*) FROM m WHERE sec > (SELECT max(sec) FROM m) - 60) AS last_minute""",
)
def distribution_and_meter(t):
    seen = M.UserMetrics(t.spark, errors=M.Counter, cents=M.Distribution, rate=M.Meter)

    def handle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen.add("errors", M.Counter(int((pdf["event_type"] == "error").sum())))
            seen.add("cents", M.Distribution.of(pdf["cents"]))
            seen.add("rate", M.Meter.of(pdf["second"]))
            yield pdf[["event_id"]]

    rows = t.events.select(
        "event_id",
        "event_type",
        units("value").alias("cents"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000)).alias("second"),
    )
    discard(rows.mapInPandas(handle, "event_id BIGINT"))
    values = seen["cents"]
    return t.spark.createDataFrame(
        [(seen["errors"].n, values.n, values.total, values.low, values.high, values.quantile(50), values.quantile(95), seen["rate"].per_minute)],
        "errors BIGINT, n BIGINT, total BIGINT, low BIGINT, high BIGINT, median BIGINT, p95 BIGINT, last_minute BIGINT",
    )


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"slot": pdf["user_id"] % 5, "label": pdf["event_type"].str.upper()})


@query(
    "UDF-11",
    "rows_and_back",
    "SELECT user_id % 5 AS slot, upper(event_type) AS label, count(*) AS n FROM events GROUP BY 1, 2",
)
def rows_and_back(t):
    mapped = t.events.select("user_id", "event_type").mapInPandas(_label, "slot BIGINT, label STRING")
    return mapped.groupBy("slot", "label").agg(F.count("*").alias("n"))


@query(
    "UDF-12",
    "explain_details",
    """SELECT 'exchanges' AS detail, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'partial_sums', 1
       UNION ALL SELECT 'size_estimates', 1 UNION ALL SELECT 'output_rows', count(DISTINCT l_returnflag) FROM lineitem""",
)
def explain_details(t):
    # Facts of the plan by explain mode, next to what the query returns.
    totals = t.lineitem.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("q"))
    plan, costs = explained(totals, "simple"), explained(totals, "cost")
    facts = [
        ("exchanges", plan.count("Exchange hashpartitioning")),
        ("partial_sums", plan.count("partial_sum")),
        ("size_estimates", int("sizeInBytes=" in costs)),
    ]
    rows = t.spark.createDataFrame(facts, "detail STRING, n BIGINT")
    return rows.union(totals.agg(F.lit("output_rows"), F.count("*")))


def _with_dictionary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    codes = {kind: i for i, kind in enumerate(["click", "error", "purchase", "signup", "view"])}
    for pdf in batches:
        yield pd.DataFrame({"event_id": pdf["event_id"], "code": pdf["event_type"].map(codes).astype("Int32")})


@query(
    "UDF-13",
    "open_process_close",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
              WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS code FROM events""",
)
def open_process_close(t):
    # The dictionary is built once per task, before the first batch.
    return t.events.select("event_id", "event_type").mapInPandas(_with_dictionary, "event_id BIGINT, code INT")
