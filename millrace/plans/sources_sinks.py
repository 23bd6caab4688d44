"""Sources, table definitions, sinks and row changes, checked by read-back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar as S
from millrace.functions.exact import money_sum
from millrace.operators import changelog as C
from millrace.operators import dml
from millrace.plans.registry import query
from millrace.scratch import new_folder
from millrace.sizing import small_side
from millrace.sources import files, generated, sinks, text_ingest
from millrace.sources.schema_spec import TableSpec
from millrace.tables import SCHEMAS

_WEIGHTS = [("click", 1), ("view", 2), ("purchase", 10), ("signup", 5), ("error", None)]
_VALUES = ", ".join(f"('{k}', {'NULL' if w is None else w})" for k, w in _WEIGHTS)


@query(
    "SRC-01",
    "in_memory_rows",
    f"""SELECT user_id, CAST(sum(weight) AS BIGINT) AS score FROM events
        JOIN (VALUES {_VALUES}) AS w(kind, weight) ON event_type = kind GROUP BY user_id""",
)
def in_memory_rows(t):
    weights = generated.rows(t.spark, _WEIGHTS, "kind STRING, weight INT")
    return (
        t.events.join(F.broadcast(weights), F.col("event_type") == F.col("kind"))
        .groupBy("user_id")
        .agg(F.sum("weight").alias("score"))
    )


@query(
    "SRC-02",
    "inline_values",
    """SELECT label, count(*) AS n FROM orders
       JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS v(code, label) ON o_orderstatus = code GROUP BY label""",
)
def inline_values(t):
    return t.spark.sql(
        """SELECT label, count(*) AS n FROM {orders} AS o
           JOIN (SELECT * FROM VALUES ('F', 'finished'), ('O', 'open') AS v(code, label))
             ON o.o_orderstatus = code
           GROUP BY label""",
        orders=t.orders,
    )


@query(
    "SRC-03",
    "number_sequence",
    """SELECT k AS orderkey FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS k)
       WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def number_sequence(t):
    # The bounds of the sequence come from the data; keys without lines remain.
    last = t.orders.agg(F.max("o_orderkey").alias("k")).first()["k"]
    keys = generated.number_sequence(t.spark, 0, last)
    return keys.join(t.lineitem, F.col("id") == F.col("l_orderkey"), "left_anti").select(
        F.col("id").alias("orderkey")
    )


@query(
    "SRC-04",
    "random_rows",
    "SELECT count(*) AS n, TRUE AS in_range FROM customer",
)
def random_rows(t):
    n = t.customer.count()
    rows = generated.random_rows(t.spark, "id BIGINT, name STRING, score DOUBLE, ok BOOLEAN", n)
    fine = (F.col("score") >= 0) & (F.col("score") < 1) & (F.length("name") == 32)
    return rows.agg(F.count("*").alias("n"), F.bool_and(fine).alias("in_range"))


@query("SRC-05", "delimited_files", "SELECT * FROM customer")
def delimited_files(t):
    path = new_folder(t.spark, "delimited")
    data = t.customer.select(F.to_csv(F.struct("*"), {"sep": "|"}).alias("value"))
    comments = t.nation.select(F.concat(F.lit("# nation "), "n_name").alias("value"))
    data.union(comments).write.text(path)
    return files.delimited(t.spark, path, SCHEMAS["customer"], sep="|", comments=True)


@query(
    "SRC-06",
    "text_lines",
    r"""SELECT length(line) AS chars, count(*) AS n FROM (
          SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
)
def text_lines(t):
    path = new_folder(t.spark, "lines")
    t.documents.select("text").write.option("lineSep", "\n").text(path)
    return (
        files.lines(t.spark, path)
        .groupBy(F.length("value").cast("bigint").alias("chars"))
        .agg(F.count("*").alias("n"))
    )


@query("SRC-07", "path_filter", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def path_filter(t):
    return files.only_visible(t.orders).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "SRC-08",
    "json_rows",
    """SELECT o_orderkey AS id, nullif(o_orderstatus, 'P') AS status, o_custkey AS customer,
              CAST(NULL AS VARCHAR) AS absent, CAST(o_orderkey % 3 AS INTEGER) AS second_item
       FROM orders""",
)
def json_rows(t):
    written = t.orders.select(
        S.json_row(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
                F.struct(F.col("o_custkey").alias("customer")).alias("ops"),
                F.array(F.lit(0), (F.col("o_orderkey") % 3).cast("int")).alias("ids"),
            )
        ).alias("json")
    )
    schema = "id BIGINT, status STRING, ops STRUCT<customer: BIGINT>, ids ARRAY<INT>, absent STRING"
    row = written.select(F.from_json("json", schema).alias("r"))
    return row.select(
        "r.id", "r.status", "r.ops.customer", "r.absent", F.col("r.ids")[1].alias("second_item")
    )


def _texts(key: str, date: str) -> dict[str, str]:
    """Text columns with every kind of fault, in SQL both engines read alike."""
    k = f"CAST({key} AS STRING)"
    return {
        "whole": f"""CASE {key} % 8 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN concat({k}, 'x')
            WHEN 3 THEN concat('99999999999', {k}) WHEN 4 THEN concat(' ', {k})
            WHEN 5 THEN concat('-', {k}) WHEN 6 THEN concat('+', {k}) ELSE {k} END""",
        "amount": f"""CASE {key} % 5 WHEN 0 THEN '' WHEN 1 THEN concat({k}, '.5 ') WHEN 2 THEN concat({k}, '.5.5')
            ELSE concat({k}, '.25') END""",
        "flag": f"""CASE {key} % 6 WHEN 0 THEN 'true' WHEN 1 THEN '0' WHEN 2 THEN 'yes' WHEN 3 THEN ''
            WHEN 4 THEN 'FALSE' ELSE '1' END""",
        "day": f"""CASE {key} % 4 WHEN 0 THEN '2000-02-35' WHEN 1 THEN concat(' ', {date}) WHEN 2 THEN '13-08-12'
            ELSE {date} END""",
    }


_TYPES = {"whole": "int", "amount": "double", "flag": "boolean", "day": "date"}
_SQL_TEXTS = _texts("o_orderkey", "CAST(CAST(o_orderdate AS DATE) AS STRING)")


@query(
    "SRC-09",
    "typed_text_ingest",
    f"""SELECT whole_error, amount_error, flag_error, day_error, count(*) AS n, CAST(sum(w) AS BIGINT) AS whole_sum,
               CAST(sum(a) AS DOUBLE) AS amount_sum, count(*) FILTER (WHERE f) AS trues, max(d) AS last_day
        FROM (SELECT
          CASE WHEN whole = '' THEN 'EMPTY_COLUMN' WHEN whole = '-' THEN 'NUMERIC_VALUE_ORPHAN_SIGN'
               WHEN regexp_matches(whole, '^-?[0-9]') AND TRY_CAST(regexp_extract(whole, '^-?[0-9]+') AS INTEGER) IS NULL
                 THEN 'NUMERIC_VALUE_OVERFLOW_UNDERFLOW'
               WHEN NOT regexp_full_match(whole, '-?[0-9]+') THEN 'NUMERIC_VALUE_ILLEGAL_CHARACTER' END AS whole_error,
          CASE WHEN amount = '' THEN 'EMPTY_COLUMN' WHEN trim(amount) <> amount THEN 'NUMERIC_VALUE_ILLEGAL_CHARACTER'
               WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'NUMERIC_VALUE_FORMAT_ERROR' END AS amount_error,
          CASE WHEN flag = '' THEN 'EMPTY_COLUMN'
               WHEN lower(flag) NOT IN ('true', 'false', '0', '1') THEN 'BOOLEAN_INVALID' END AS flag_error,
          CASE WHEN trim(day) <> day THEN 'NUMERIC_VALUE_ILLEGAL_CHARACTER'
               WHEN NOT regexp_full_match(day, '[0-9]{{4}}-[0-9]+-[0-9]+') OR TRY_CAST(day AS DATE) IS NULL
                 THEN 'NUMERIC_VALUE_FORMAT_ERROR' END AS day_error,
          CASE WHEN whole_error IS NULL THEN CAST(whole AS INTEGER) END AS w,
          CASE WHEN amount_error IS NULL THEN CAST(amount AS DOUBLE) END AS a,
          CASE WHEN flag_error IS NULL THEN lower(flag) IN ('true', '1') END AS f,
          CASE WHEN day_error IS NULL THEN CAST(day AS DATE) END AS d
        FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in _SQL_TEXTS.items())} FROM orders))
        GROUP BY 1, 2, 3, 4""",
)
def typed_text_ingest(t):
    raw = t.orders.select(*[F.expr(e).alias(n) for n, e in _SQL_TEXTS.items()])
    typed = text_ingest.ingest(raw, _TYPES)
    return typed.groupBy(*[f"{n}_error" for n in _TYPES]).agg(
        F.count("*").alias("n"),
        F.sum("whole").alias("whole_sum"),
        F.sum("amount").alias("amount_sum"),
        F.count_if("flag").alias("trues"),
        F.max("day").alias("last_day"),
    )


@query("SRC-10", "orc_table", "SELECT * FROM events")
def orc_table(t):
    path = new_folder(t.spark, "orc")
    t.events.write.orc(path)
    return t.spark.read.schema(t.events.schema).orc(path)


@query(
    "SRC-11",
    "parquet_nested",
    """SELECT c_custkey, c_name, c_acctbal, CAST(2 AS INTEGER) AS n_tags, c_mktsegment AS first_tag FROM customer""",
)
def parquet_nested(t):
    path = new_folder(t.spark, "nested")
    t.customer.select(
        "c_custkey",
        F.struct("c_name", "c_acctbal").alias("account"),
        F.array("c_mktsegment", F.lit("x")).alias("tags"),
    ).write.parquet(path)
    schema = "c_custkey BIGINT, account STRUCT<c_name: STRING, c_acctbal: DOUBLE>, tags ARRAY<STRING>"
    back = t.spark.read.schema(schema).parquet(path)
    return back.select(
        "c_custkey", "account.c_name", "account.c_acctbal",
        F.size("tags").alias("n_tags"), F.col("tags")[0].alias("first_tag"),
    )


@query(
    "SRC-13",
    "message_rows",
    """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' ELSE 'UNKNOWN' END AS state,
              CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS by_number,
              CASE WHEN o_custkey % 2 = 1 THEN CAST(o_custkey AS VARCHAR) END AS by_name,
              o_totalprice AS price, o_orderpriority AS priority FROM orders""",
)
def message_rows(t):
    # The row shape a protobuf message maps to: enum as text, oneof members as
    # nullable siblings, a nested message, a map and a bytes field.
    member = F.col("o_custkey") % 2
    message = t.orders.select(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderstatus") == "F", "FINISHED")
            .when(F.col("o_orderstatus") == "O", "OPEN")
            .otherwise("UNKNOWN")
            .alias("state"),
            F.when(member == 0, F.col("o_custkey")).alias("by_number"),
            F.when(member == 1, F.col("o_custkey").cast("string")).alias("by_name"),
            F.struct(F.col("o_totalprice").alias("price")).alias("terms"),
            F.create_map(F.lit("priority"), F.encode("o_orderpriority", "UTF-8")).alias("extra"),
        ).alias("m")
    )
    return message.select(
        "m.id", "m.state", "m.by_number", "m.by_name", "m.terms.price",
        F.decode(F.col("m.extra")["priority"], "UTF-8").alias("priority"),
    )


@query(
    "SRC-14",
    "hadoop_input_format",
    "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang",
)
def hadoop_input_format(t):
    path = new_folder(t.spark, "pairs")
    t.documents.select(F.to_csv(F.struct("lang", "n_chars"), {"sep": "\t"}).alias("value")).write.text(path)
    pairs = files.hadoop_pairs(
        t.spark,
        path,
        "org.apache.hadoop.mapreduce.lib.input.TextInputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
    )
    rows = pairs.select(F.from_csv("v", "lang STRING, n_chars BIGINT", {"sep": "\t"}).alias("r"))
    return rows.groupBy("r.lang").agg(F.count("*").alias("n"), F.sum("r.n_chars").alias("chars"))


@query(
    "SRC-17",
    "declared_schema",
    """SELECT event_id, ts, ts - INTERVAL 60 MINUTE AS shifted, TRUE AS from_file FROM events""",
)
def declared_schema(t):
    spec = (
        TableSpec()
        .column("shifted", "ts - INTERVAL '60' MINUTE")
        .from_metadata("source_file", "file_name")
        .with_watermark("ts", "5 seconds")
        .key("event_id")
    )
    return spec.apply(t.events).select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("shifted").cast("timestamp_ntz").alias("shifted"),
        F.endswith("source_file", F.lit(".parquet")).alias("from_file"),
    )


@query(
    "SRC-18",
    "time_travel",
    """SELECT user_id, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')
       WHERE rn = 1 AND event_type <> 'error'""",
)
def time_travel(t):
    versions = t.events.select(
        "user_id", "ts", "event_id", "value",
        F.when(F.col("event_type") == "error", C.DELETE).otherwise(C.AFTER).alias("op"),
    )
    at = C.snapshot_at(versions, ["user_id"], "ts", "2024-01-15 12:00:00", "op", ["event_id"])
    return at.select("user_id", "event_id", "value")


@query(
    "SRC-19",
    "pandas_interchange",
    """SELECT upper(n_name) || '!' AS shout, count(*) AS n FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def pandas_interchange(t):
    pdf = generated.to_pandas(t.nation, 1000)
    pdf["shout"] = pdf["n_name"].str.upper() + "!"
    back = generated.from_pandas(t.spark, pdf[["n_nationkey", "shout"]], "n_nationkey INT, shout STRING")
    return (
        t.customer.join(small_side(back), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("shout")
        .agg(F.count("*").alias("n"))
    )


@query("SRC-20", "like_table", "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def like_table(t):
    db = dml.work_database(t.spark)
    t.supplier.limit(0).write.saveAsTable(f"{db}.src")
    t.spark.sql(f"CREATE TABLE {db}.twin LIKE {db}.src USING parquet")
    t.supplier.write.insertInto(f"{db}.twin")
    return t.spark.table(f"{db}.twin").groupBy("s_nationkey").agg(F.count("*").alias("n"))


@query(
    "SRC-21",
    "catalog_listing",
    """SELECT kind, name, (SELECT count(*) FROM nation) AS n FROM (VALUES ('FUNCTION', 'listed_double'),
         ('TABLE', 'listed_nation'), ('TABLE', 'listed_view'), ('VIEW', 'listed_view')) AS v(kind, name)""",
)
def catalog_listing(t):
    db, sql = dml.work_database(t.spark), t.spark.sql
    t.nation.write.mode("overwrite").saveAsTable(f"{db}.listed_nation")
    sql(f"CREATE OR REPLACE VIEW {db}.listed_view AS SELECT * FROM {db}.listed_nation")
    sql("CREATE OR REPLACE TEMPORARY FUNCTION listed_double(x INT) RETURNS INT RETURN 2 * x")
    shown = {
        "TABLE": sql(f"SHOW TABLES IN {db} LIKE 'listed_*'").select("tableName"),
        "VIEW": sql(f"SHOW VIEWS IN {db} LIKE 'listed_*'").select("viewName"),
        "FUNCTION": sql("SHOW USER FUNCTIONS LIKE 'listed_*'").select(F.substring_index("function", ".", -1)),
    }
    named = [rows.toDF("name").select(F.lit(kind).alias("kind"), "name") for kind, rows in shown.items()]
    size = t.spark.table(f"{db}.listed_view").agg(F.count("*").alias("n"))
    return named[0].union(named[1]).union(named[2]).crossJoin(F.broadcast(size))


@query(
    "SRC-21",
    "show_partitions",
    """SELECT DISTINCT 'o_orderstatus=F/y=' || CAST(year(o_orderdate) AS VARCHAR) AS partition
       FROM orders WHERE o_orderstatus = 'F'""",
)
def show_partitions(t):
    db = dml.work_database(t.spark)
    (
        t.orders.withColumn("y", F.year("o_orderdate"))
        .select("o_orderkey", "o_orderstatus", "y")
        .repartition("o_orderstatus", "y", F.pmod(F.col("o_orderkey"), F.lit(16)))
        .write.partitionBy("o_orderstatus", "y")
        .saveAsTable(f"{db}.o")
    )
    return t.spark.sql(f"SHOW PARTITIONS {db}.o PARTITION (o_orderstatus = 'F')")


@query("SNK-01", "csv_sink", "SELECT p_partkey, p_name, p_size + 1 AS next_size FROM part")
def csv_sink(t):
    path = new_folder(t.spark, "csv")
    rows = t.part.select("p_partkey", "p_name", (F.col("p_size") + 1).alias("next_size"))
    files.write_delimited(rows, path, sep=";")
    return files.delimited(t.spark, path, "p_partkey BIGINT, p_name STRING, next_size INT", sep=";")


@query("SNK-04", "discarding_sink", "SELECT count(*) AS seen FROM lineitem")
def discarding_sink(t):
    from millrace.operators.aggregates import observed

    rows, seen = observed(t.lineitem, "discarded", {"seen": F.count("*")})
    sinks.discard(rows)
    return t.spark.createDataFrame([(seen.get["seen"],)], "seen BIGINT")


@query(
    "SNK-05",
    "statement_set",
    """SELECT 'status' AS sink, o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders WHERE o_totalprice > 200000 GROUP BY 2""",
)
def statement_set(t):
    base = new_folder(t.spark, "statements")
    sinks.statement_set(
        t.orders,
        {
            f"{base}/status": lambda o: o.groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("n")),
            f"{base}/priority": lambda o: o.where("o_totalprice > 200000")
            .groupBy(F.col("o_orderpriority").alias("k"))
            .agg(F.count("*").alias("n")),
        },
    )
    read = t.spark.read.schema("k STRING, n BIGINT")
    return (
        read.parquet(f"{base}/status")
        .select(F.lit("status").alias("sink"), "k", "n")
        .union(read.parquet(f"{base}/priority").select(F.lit("priority"), "k", "n"))
    )


@query(
    "SNK-06",
    "insert_columns",
    """SELECT c_custkey AS x, c_name AS y, CAST(NULL AS DOUBLE) AS z FROM customer
       UNION ALL SELECT s_suppkey, CAST(NULL AS VARCHAR), s_acctbal FROM supplier""",
)
def insert_columns(t):
    db = dml.work_database(t.spark)
    t.spark.sql(f"CREATE TABLE {db}.dest (x BIGINT, y STRING, z DOUBLE) USING parquet")
    t.spark.sql(f"INSERT INTO {db}.dest (y, x) SELECT c_name, c_custkey FROM {{c}}", c=t.customer)
    t.spark.sql(f"INSERT INTO {db}.dest (z, x) SELECT s_acctbal, s_suppkey FROM {{s}}", s=t.supplier)
    return t.spark.table(f"{db}.dest")


@query(
    "SNK-07",
    "overwrite_partitions",
    """SELECT status, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(12,2))) AS DOUBLE) AS total FROM (
         SELECT o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'F'
         UNION ALL SELECT 'F', o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)
       GROUP BY status""",
)
def overwrite_partitions(t):
    db = dml.work_database(t.spark)
    rows = t.orders.select(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    rows.write.partitionBy("status").saveAsTable(f"{db}.dest")
    dml.overwrite_partitions(rows.where("status = 'F' AND price > 300000"), f"{db}.dest")
    # An existing partition is left alone by IF NOT EXISTS.
    t.spark.sql(
        f"INSERT OVERWRITE TABLE {db}.dest PARTITION (status = 'O') IF NOT EXISTS SELECT price FROM {{r}}",
        r=rows.select("price"),
    )
    return (
        t.spark.table(f"{db}.dest")
        .groupBy("status")
        .agg(F.count("*").alias("n"), money_sum("price").alias("total"))
    )


@query(
    "SNK-08",
    "ctas_multi_insert",
    """SELECT 'big' AS tab, count(*) AS n FROM part WHERE p_size > 25
       UNION ALL SELECT 'small', count(*) FROM part WHERE p_size <= 25""",
)
def ctas_multi_insert(t):
    db = dml.work_database(t.spark)
    t.part.createOrReplaceTempView("millrace_part")
    t.spark.sql(
        f"CREATE TABLE {db}.big USING parquet AS WITH q AS (SELECT * FROM millrace_part WHERE p_size > 40) SELECT * FROM q"
    )
    t.spark.sql(f"CREATE TABLE {db}.small LIKE {db}.big USING parquet")
    t.spark.sql(
        f"""FROM (SELECT * FROM millrace_part) q
            INSERT INTO {db}.big SELECT * WHERE p_size > 25 AND p_size <= 40
            INSERT INTO {db}.small SELECT * WHERE p_size <= 25"""
    )
    t.spark.catalog.dropTempView("millrace_part")

    def counted(name: str):
        return t.spark.table(f"{db}.{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("tab"), "n")

    return counted("big").union(counted("small"))


@query(
    "SNK-09",
    "load_data",
    """SELECT day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (
         SELECT event_id, 'later' AS day FROM events WHERE ts >= TIMESTAMP '2024-01-16'
         UNION ALL SELECT event_id, 'first' FROM events WHERE ts < TIMESTAMP '2024-01-16') GROUP BY day""",
)
def load_data(t):
    db = dml.work_database(t.spark)
    split = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    rows = t.events.select("event_id", "ts")
    rows.withColumn("day", F.when(split, "wrong").otherwise("later")).where("day = 'later'").write.partitionBy(
        "day"
    ).saveAsTable(f"{db}.e")
    path = new_folder(t.spark, "load")
    rows.where(split).write.parquet(path)
    for _ in range(2):  # the second load replaces the first
        dml.load_into_partition(t.spark, f"{db}.e", path, "parquet", {"day": "first"}, overwrite=True)
    return t.spark.table(f"{db}.e").groupBy("day").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    "SNK-10",
    "delete_where",
    """WITH m AS (SELECT max(o_totalprice) * 0.5 AS bound FROM orders)
       SELECT count(*) AS kept, (SELECT count(*) FROM orders, m WHERE nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > bound) AS deleted,
              max(o_totalprice) AS top FROM orders, m
       WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > bound, FALSE)""",
)
def delete_where(t):
    # The NULL status of P rows makes the predicate NULL: those rows stay.
    bound = t.orders.agg((F.max("o_totalprice") * 0.5).alias("bound"))
    rows = t.orders.crossJoin(F.broadcast(bound))
    doomed = (F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F") & (F.col("o_totalprice") > F.col("bound"))
    kept, deleted = dml.delete_where(rows, doomed, new_folder(t.spark, "delete"))
    return kept.agg(F.count("*").alias("kept"), F.max("o_totalprice").alias("top")).select(
        "kept", F.lit(deleted).cast("bigint").alias("deleted"), "top"
    )


@query("SNK-11", "truncate", "SELECT count(*) AS before, 0 AS after, 4 AS columns FROM supplier")
def truncate(t):
    db = dml.work_database(t.spark)
    t.supplier.write.saveAsTable(f"{db}.s")
    before = t.spark.table(f"{db}.s").count()
    t.spark.sql(f"TRUNCATE TABLE {db}.s")
    table = t.spark.table(f"{db}.s")
    return table.agg(F.count("*").cast("int").alias("after")).select(
        F.lit(before).cast("bigint").alias("before"), "after", F.lit(len(table.columns)).alias("columns")
    )


@query(
    "SNK-13",
    "materialised_changelog",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
       WHERE rn = 1 AND event_type <> 'signup'""",
)
def materialised_changelog(t):
    changes = t.events.select(
        "user_id", "event_id", "event_type", "value",
        F.when(F.col("event_type") == "signup", C.DELETE).otherwise(C.AFTER).alias("op"),
    )
    return C.materialise(changes, ["user_id"], ["event_id"])


@query(
    "SNK-13",
    "full_changelog",
    """WITH v AS (SELECT user_id, event_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS old FROM events)
       SELECT user_id, event_id, '+I' AS op, event_type FROM v WHERE old IS NULL
       UNION ALL SELECT user_id, event_id, '-U', old FROM v WHERE old <> event_type
       UNION ALL SELECT user_id, event_id, '+U', event_type FROM v WHERE old <> event_type""",
)
def full_changelog(t):
    versions = t.events.select("user_id", "event_id", "event_type")
    return C.to_changelog(versions, ["user_id"], ["event_id"], ["event_type"])


@query(
    "SNK-14",
    "call_procedure",
    """SELECT i AS k, count(*) AS n FROM (SELECT unnest(range(0, l_linenumber)) AS i FROM lineitem) GROUP BY i""",
)
def call_procedure(t):
    # A procedure is a SQL table function: called with an argument, it returns a table.
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION millrace_generate_n(n INT) RETURNS TABLE (k BIGINT)
           RETURN SELECT explode(CASE WHEN n > 0 THEN sequence(0L, n - 1L) END) AS k"""
    )
    return t.spark.sql(
        """SELECT g.k, count(*) AS n FROM {lines} AS l, LATERAL millrace_generate_n(l.l_linenumber) AS g
           GROUP BY g.k""",
        lines=t.lineitem.select("l_linenumber"),
    )
