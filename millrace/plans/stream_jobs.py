"""Streaming jobs: the replayed event table run to completion.

A job that has a bounded twin is checked against the twin's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.functions.exact import units
from millrace.operators import changelog as C
from millrace.operators import joins as J
from millrace.operators import projection as P
from millrace.operators.ordered import keep_one
from millrace.plans import event_time, joins
from millrace.plans.registry import REGISTRY, query
from millrace.scratch import new_folder
from millrace.sizing import small_side
from millrace.sources import files
from millrace.streaming import processors as K
from millrace.streaming import transforms as W
from millrace.streaming.late import split_late
from millrace.streaming.replay import (
    event_stream,
    real_rows,
    replay,
    slice_stream,
    stage,
    write_end,
    write_slices,
)
from millrace.streaming.runner import (
    batch_writer,
    read_batches,
    run_append,
    run_batches,
    run_upserts,
    watch_watermarks,
)

def sql_of(name: str) -> str:
    return REGISTRY[name].sql


@query(
    "STR-01",
    "watermark",
    """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2""",
)
def watermark(t):
    daily = (
        event_stream(t, delay="2 seconds")
        .groupBy("event_type", F.window("ts", "1 day").alias("w"))
        .agg(F.count("*").alias("n"))
        .select("event_type", F.to_date("w.start").alias("day"), "n")
    )
    return run_append(daily, "watermark")


@query("STR-02", "tumbling_window_stream", event_time.TUMBLE_SQL)
def tumbling_window_stream(t):
    return run_append(W.tumbling(event_stream(t)), "tumbling")


@query("STR-03", "cascaded_windows_stream", event_time.CASCADE_SQL)
def cascaded_windows_stream(t):
    return run_append(W.cascaded(event_stream(t)), "cascaded")


@query("STR-04", "sliding_window_stream", event_time.HOP_SQL)
def sliding_window_stream(t):
    return run_append(W.hopping(event_stream(t)), "hopping")


@query("STR-05", "session_window_stream", event_time.SESSION_SQL)
def session_window_stream(t):
    return run_append(W.session_totals(event_stream(t), "1 hour"), "session")


@query("STR-06", "dynamic_session_window_stream", event_time.DYNAMIC_SQL)
def dynamic_session_window_stream(t):
    gap = F.when(F.col("event_type") == "error", "10 minutes").otherwise("2 hours")
    return run_append(W.session_totals(event_stream(t), gap), "dynamic-session")


@query(
    "STR-07",
    "processing_time_window",
    f"SELECT user_id, count(*) AS n, {event_time.CENTS} AS cents FROM events GROUP BY user_id",
)
def processing_time_window(t):
    # Windows of the machine's clock; what is stable is their total per key.
    stamped = event_stream(t, delay=None).withColumn("seen", F.current_timestamp())
    per_window = stamped.groupBy("user_id", F.window("seen", "10 seconds").alias("w")).agg(
        F.count("*").alias("n"), F.sum(units("value")).alias("cents")
    )
    windows = run_upserts(per_window, "processing-time", ["user_id", "w"])
    return windows.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))


@query(
    "STR-08",
    "count_trigger",
    """SELECT user_id, CAST(floor((rn - 1) / 5) AS BIGINT) AS window_no, CAST(c AS BIGINT) AS cents FROM (
         SELECT user_id, row_number() OVER w AS rn, sum(CAST(round(value * 100) AS BIGINT)) OVER w AS c
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
       WHERE rn % 5 = 0""",
)
def count_trigger(t):
    fired = K.apply(event_stream(t), "user_id", K.CountTrigger(5, purge=False), K.CountTrigger.schema)
    return run_append(fired, "count-trigger").select("user_id", "window_no", "cents")


@query("WIN-10", "count_window_tumbling_stream", sql_of("win_10_count_window_tumbling"))
def count_window_tumbling_stream(t):
    fired = K.apply(event_stream(t), "user_id", K.CountTrigger(5, purge=True), K.CountTrigger.schema)
    return run_append(fired, "count-window")


@query("STR-09", "early_results", event_time.TUMBLE_SQL)
def early_results(t):
    # Open windows report after every micro-batch; the newest report wins.
    return run_upserts(W.tumbling(event_stream(t)), "early", ["user_id", "window_start"])


_LATE = """event_id % 50 = 0 AND CAST(floor((epoch_us(ts) - lo) * 4 / (hi - lo + 1)) AS INTEGER) = 1"""


@query(
    "STR-10",
    "late_side_output",
    f"""SELECT event_id, CASE WHEN {_LATE} THEN 'late' ELSE 'main' END AS output
        FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)""",
)
def late_side_output(t):
    main, late = split_late(event_stream(t, "disordered", None), "ts", 3600, "late")
    return main.select("event_id", F.lit("main").alias("output")).union(
        late.select("event_id", F.lit("late"))
    )


@query(
    "STR-10",
    "late_rows_dropped",
    f"""SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
        FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events) WHERE NOT ({_LATE})""",
)
def late_rows_dropped(t):
    hourly = (
        event_stream(t, "disordered", "1 hour")
        .groupBy(F.window("ts", "1 second").alias("w"))
        .agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    )
    return run_append(hourly, "dropped").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))


@query(
    "STR-11",
    "keyed_state_kinds",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS back FROM events),
         c AS (SELECT user_id, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts
               FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1)
       SELECT r.user_id, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY back DESC) FILTER (WHERE back <= 3) AS last_ids,
              any_value(counts) AS counts, max(value) AS top, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
       FROM r JOIN c ON r.user_id IS NOT DISTINCT FROM c.user_id GROUP BY r.user_id""",
)
def keyed_state_kinds(t):
    stream = K.apply(event_stream(t), "user_id", K.StateKinds(), K.StateKinds.schema)
    reports = run_append(stream, "state-kinds")
    return keep_one(reports, ["user_id"], ["n"], latest=True)


@query(
    "STR-12",
    "state_ttl",
    """WITH g AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 12 HOUR AS expired FROM events),
         e AS (SELECT *, sum(CASE WHEN expired THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM g)
       SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT))
              OVER (PARTITION BY user_id, epoch ORDER BY ts, event_id) AS BIGINT) AS running_cents FROM e""",
)
def state_ttl(t):
    ttl = K.EventTimeTtlSum(12 * 3600 * 1_000_000)
    return run_append(K.apply(event_stream(t), "user_id", ttl, ttl.schema), "ttl")


@query(
    "STR-13",
    "timers",
    """SELECT user_id, event_id FROM (
         SELECT *, lead(epoch_ms(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) - epoch_ms(ts) AS wait FROM events)
       WHERE wait IS NULL OR wait > 43200000""",
)
def timers(t):
    stream = K.apply(event_stream(t), "user_id", K.Silence(43_200_000), K.Silence.schema, "EventTime")
    return run_append(stream, "timers")


@query(
    "STR-14",
    "process_function",
    """SELECT event_id, user_id, event_type, lag(event_type) OVER w AS previous_state, lag(event_id) OVER w AS previous_id,
              epoch_us(ts) - lag(epoch_us(ts)) OVER w AS waited_us
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def process_function(t):
    stream = K.apply(event_stream(t), "user_id", K.Previous(), K.Previous.schema)
    return run_append(stream, "process")


@query(
    "STR-15",
    "two_inputs",
    """WITH x AS (SELECT *, count(*) FILTER (WHERE event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS block
               FROM events WHERE event_type IN ('purchase', 'error'))
       SELECT event_id, user_id, errors AS errors_before FROM (
         SELECT *, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id, block) AS errors FROM x)
       WHERE event_type = 'purchase'""",
)
def two_inputs(t):
    stream = event_stream(t)
    errors = stream.where("event_type = 'error'").select("user_id", "ts", "event_id", F.lit(0).alias("side"))
    buys = stream.where("event_type = 'purchase'").select(
        "user_id", "ts", "event_id", F.lit(1).alias("side"), "value"
    )
    connected = errors.unionByName(buys, allowMissingColumns=True)
    return run_append(K.apply(connected, "user_id", K.ErrorsBetween(), K.ErrorsBetween.schema), "connect")


@query(
    "STR-16",
    "broadcast_rules",
    """WITH rules AS (SELECT event_type AS kind, CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / count(*)) AS BIGINT) AS floor_cents
                      FROM events GROUP BY 1)
       SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) - floor_cents AS above
       FROM events JOIN rules ON kind = event_type WHERE CAST(round(value * 100) AS BIGINT) > floor_cents""",
)
def broadcast_rules(t):
    rules_at = new_folder(t.spark, "rules")
    t.events.groupBy(F.col("event_type").alias("kind")).agg(
        F.floor(F.sum(units("value")) / F.count("*")).alias("floor_cents")
    ).write.parquet(rules_at)
    out = new_folder(t.spark, "rules-out")

    def handle(rows: DataFrame, batch_id: int) -> None:
        # The rules are read again for every micro-batch, so edits take effect.
        rules = rows.sparkSession.read.schema("kind STRING, floor_cents BIGINT").parquet(rules_at)
        hit = rows.join(small_side(rules), F.col("event_type") == F.col("kind")).where(
            units("value") > F.col("floor_cents")
        )
        batch_writer(out)(
            hit.select("event_id", "event_type", (units("value") - F.col("floor_cents")).alias("above")), batch_id
        )

    run_batches(event_stream(t, delay=None), "rules-run", handle)
    return t.spark.read.schema("event_id BIGINT, event_type STRING, above BIGINT").parquet(out).drop("batch_id")


@query("STR-17", "running_sum_with_ttl", sql_of("agg_28_running_keyed_sum"))
def running_sum_with_ttl(t):
    # The TTL of the state (a day of machine time) is longer than the run.  A
    # machine-time clock always asks for one more batch, so empty batches are
    # off: a bounded run would not end otherwise.
    summed = K.RunningSum(ttl_ms=86_400_000)
    stream = K.apply(event_stream(t), "user_id", summed, summed.schema, "ProcessingTime")
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    return run_append(stream, "sum-ttl", settings=settings)


@query("AGG-28", "running_keyed_sum_stream", sql_of("agg_28_running_keyed_sum"))
def running_keyed_sum_stream(t):
    summed = K.RunningSum()
    return run_append(K.apply(event_stream(t), "user_id", summed, summed.schema), "running-sum")


@query(
    "STR-18",
    "runtime_modes",
    f"""WITH w AS ({event_time.TUMBLE_SQL})
        SELECT mode, count(*) AS windows, CAST(sum(n) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM w, (VALUES ('BATCH'), ('STREAMING')) AS m(mode) GROUP BY mode""",
)
def runtime_modes(t):
    results = {"BATCH": W.tumbling(t.events), "STREAMING": run_append(W.tumbling(event_stream(t)), "modes")}
    totals = [
        rows.agg(F.count("*").alias("windows"), F.sum("n").alias("n"), F.sum("cents").alias("cents")).select(
            F.lit(mode).alias("mode"), "*"
        )
        for mode, rows in results.items()
    ]
    return totals[0].union(totals[1])


@query("STR-19", "restart_from_checkpoint", event_time.TUMBLE_SQL)
def restart_from_checkpoint(t):
    # The first run ends after half the input; the second resumes its
    # checkpoint.  Together they must equal one uninterrupted run.
    source, work = new_folder(t.spark, "restart-in"), new_folder(t.spark, "restart")
    slices = stage(t)
    half = slices.count // 2

    def run():
        rows = real_rows(slice_stream(t.spark, source), "10 minutes")
        return run_append(W.tumbling(rows), "restart", folder=work)

    write_slices(t.spark, slices, range(half), source)
    run()
    write_slices(t.spark, slices, range(half, slices.count), source)
    run()
    write_end(t.spark, slices, source)
    return run()


@query("STR-20", "state_schema_evolution", sql_of("agg_28_running_keyed_sum"))
def state_schema_evolution(t):
    # Half the input runs with the first program, the rest with an upgraded one
    # whose state has one more field, on the same checkpoint.
    source, work = new_folder(t.spark, "upgrade-in"), new_folder(t.spark, "upgrade")
    slices = stage(t)
    half = slices.count // 2
    settings = {"spark.sql.streaming.stateStore.encodingFormat": "avro"}
    for numbers, program in ((range(half), K.RunningSum()), (range(half, slices.count), K.CountedSum())):
        write_slices(t.spark, slices, numbers, source)
        rows = real_rows(slice_stream(t.spark, source), None)
        summed = run_append(
            K.apply(rows, "user_id", program, program.schema), "upgrade", folder=work, settings=settings
        )
    return summed


@query("STR-21", "cdc_merge_stream", event_time.CDC_SQL)
def cdc_merge_stream(t):
    # Changes are appended as they come and merged with the snapshot on read.
    snapshot, _ = W.cdc_inputs(t.events)
    late_half = F.col("ts") >= F.lit(W.CDC_CUT).cast("timestamp")
    changes = W.cdc_rows(event_stream(t, delay=None).where(late_half)).drop("ts")
    out = new_folder(t.spark, "cdc")
    run_batches(changes, "cdc-run", batch_writer(out))
    logged = read_batches(t.spark, out, changes).drop("batch_id")
    return C.apply_changes(snapshot, logged, ["user_id"], "version")


@query("STR-22", "strict_pattern_stream", sql_of("str_22_strict_pattern"))
def strict_pattern_stream(t):
    pattern = K.StrictSequence(["view", "click", "purchase"], 86_400_000_000)
    return run_append(K.apply(event_stream(t), "user_id", pattern, pattern.schema), "pattern")


@query("STR-23", "state_machine_stream", event_time.MACHINE_SQL)
def state_machine_stream(t):
    seen = K.apply(event_stream(t), "user_id", K.Previous(), K.Previous.schema)
    legal = F.lit(False)
    for before, following in event_time.ALLOWED.items():
        legal |= (F.col("previous_state") == before) & F.col("event_type").isin(*following)
    illegal = seen.where(F.col("previous_state").isNotNull() & ~legal)
    return run_append(illegal.select("event_id", "user_id", "previous_state", "event_type"), "machine")


@query(
    "STR-25",
    "watermark_progress",
    """SELECT TRUE AS never_fell,
              (3 * epoch_us(max(ts)) - 2 * epoch_us(min(ts))) // 1000 + 34560000000 - 600000 AS last_ms
       FROM events""",
)
def watermark_progress(t):
    # Every progress report of the run, however many there are, goes to a table;
    # the clock never falls and ends ten minutes behind the end of the input.
    reports = watch_watermarks(W.tumbling(event_stream(t)), "progress-run")
    at = F.unix_millis(F.to_timestamp("watermark"))
    earlier = F.max("ms").over(Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1))
    steps = reports.select("batch_id", at.alias("ms")).withColumn("earlier", earlier)
    return steps.agg(
        F.bool_and(F.coalesce(F.col("ms") >= F.col("earlier"), F.lit(True))).alias("never_fell"),
        F.max("ms").alias("last_ms"),
    )


@query(
    "STR-27",
    "idle_input",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n,
              count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY 1""",
)
def idle_input(t):
    # The purchase input falls silent at the end (it has no end marker); with
    # the "max" policy it does not hold the clock back.
    purchase = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    source = slice_stream(t.spark, replay(t).folder)
    others = real_rows(source.where(~purchase | F.col("is_end")), "10 minutes")
    buys = real_rows(source.where(purchase & ~F.col("is_end")), "10 minutes")
    hourly = (
        others.union(buys)
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
        .select(W.plain(F.col("w.start")).alias("window_start"), "n", "purchases")
    )
    return run_append(hourly, "idle", settings={"spark.sql.streaming.multipleWatermarkPolicy": "max"})


@query(
    "STR-28",
    "buffering_sink",
    """SELECT event_id, CASE WHEN rn <= c // 50 * 50 THEN 'size' ELSE 'timer' END AS flushed_by
       FROM (SELECT event_id, row_number() OVER (PARTITION BY event_id % 8 ORDER BY ts, event_id) AS rn,
                    count(*) OVER (PARTITION BY event_id % 8) AS c FROM events)""",
)
def buffering_sink(t):
    bucketed = event_stream(t).withColumn("bucket", F.pmod(F.col("event_id"), F.lit(8)))
    # A buffer may wait as long as the whole input lasts; the end of it lets all go.
    sink = K.BufferingSink(50, replay(t).span_millis + 86_400_000)
    return run_append(K.apply(bucketed, "bucket", sink, sink.schema, "EventTime"), "buffering")


@query("UDF-08", "map_view_counts_stream", sql_of("udf_08_map_view_counts"))
def map_view_counts_stream(t):
    stream = K.apply(event_stream(t), "user_id", K.StateKinds(), K.StateKinds.schema)
    reports = run_append(stream, "map-view")
    return keep_one(reports, ["user_id"], ["n"], latest=True).select("user_id", "counts")


@query("AGG-17", "select_distinct_stream", "SELECT DISTINCT user_id, event_type FROM events")
def select_distinct_stream(t):
    # No expiry: a pair seen once is known for good, so the state grows with the pairs.
    pairs = event_stream(t, delay=None).select("user_id", "event_type")
    return run_append(pairs.dropDuplicates(["user_id", "event_type"]), "distinct")


@query(
    "WIN-01",
    "dedup_keep_first_stream",
    """SELECT event_id, user_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def dedup_keep_first_stream(t):
    firsts = K.apply(event_stream(t), "user_id", K.KeepFirst(), K.KeepFirst.schema)
    return run_append(firsts, "keep-first")


@query("WIN-01", "dedup_keep_last_stream", sql_of("win_01_dedup_keep_last"))
def dedup_keep_last_stream(t):
    stream = event_stream(t, delay=None)
    rest = F.struct("event_id", "ts", "value", "props")
    newest = stream.groupBy("user_id", "event_type").agg(F.max_by(rest, F.struct("ts", "event_id")).alias("row"))
    rows = run_upserts(newest, "keep-last", ["user_id", "event_type"])
    return rows.select("user_id", "event_type", "row.*").withColumn("ts", W.plain(F.col("ts")))


def _side(t, kind: str, prefix: str) -> DataFrame:
    return event_stream(t, only=F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_ts"),
        F.col("user_id").alias(f"{prefix}_user"),
        F.col("value").alias(f"{prefix}_value"),
    )


@query("JON-22", "interval_join_stream", sql_of("jon_22_interval_join"))
def interval_join_stream(t):
    clicks, buys = _side(t, "click", "click"), _side(t, "purchase", "buy")
    joined = clicks.join(
        buys,
        (F.col("click_user") == F.col("buy_user"))
        & (F.col("buy_ts") >= F.col("click_ts"))
        & (F.col("buy_ts") <= F.col("click_ts") + F.expr("interval 1 hour")),
    )
    return run_append(joined.select(F.col("buy_user").alias("user_id"), "click_id", "buy_id"), "interval-join")


@query("JON-23", "window_join_stream", sql_of("jon_23_window_join"))
def window_join_stream(t):
    def side(kind: str, *aggs):
        rows = event_stream(t, only=F.col("event_type") == kind)
        return rows.groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(*aggs)

    views = side("view", F.count("*").alias("views"))
    buys = side("purchase", F.count("*").alias("buys"), F.sum(units("value")).alias("spent"))
    pairs = views.join(buys, ["user_id", "w"]).select(
        "user_id",
        W.plain(F.col("w.start")).alias("window_start"),
        (F.col("views") * F.col("buys")).alias("pairs"),
        ((F.col("spent") * F.col("views")).cast("double") / 100).alias("pair_value"),
    )
    return run_append(pairs, "window-join")


@query("JON-25", "lookup_enrichment_stream", sql_of("jon_25_lookup_enrichment"))
def lookup_enrichment_stream(t):
    # The dimension is read again for every micro-batch.
    return run_append(joins.with_customer(event_stream(t, delay=None), t.customer), "lookup")


@query(
    "JON-27",
    "broadcast_side_stream",
    "SELECT n_name, count(*) AS n FROM events JOIN nation ON user_id % 25 = n_nationkey GROUP BY n_name",
)
def broadcast_side_stream(t):
    stream = event_stream(t, delay=None).select((F.col("user_id") % 25).alias("k"))
    joined = stream.join(small_side(t.nation), F.col("k") == F.col("n_nationkey")).select("n_name")
    return run_append(joined, "broadcast").groupBy("n_name").agg(F.count("*").alias("n"))


@query(
    "JON-28",
    "regular_stream_join",
    "SELECT event_id, event_type, value FROM events",
)
def regular_stream_join(t):
    # No watermark: every past row may still match and the state only grows.
    left = event_stream(t, delay=None).select("event_id", "event_type")
    right = event_stream(t, "disordered", None).select(F.col("event_id").alias("rid"), "value")
    joined = left.join(right, F.col("event_id") == F.col("rid")).drop("rid")
    return run_append(joined, "regular-join")


@query("SRC-06", "text_lines_stream", sql_of("src_06_text_lines"))
def text_lines_stream(t):
    path = new_folder(t.spark, "lines-in")
    t.documents.select("text").write.option("lineSep", "\n").text(path)
    rows = run_append(files.monitored_lines(t.spark, path), "lines-out")
    return rows.groupBy(F.length("value").cast("bigint").alias("chars")).agg(F.count("*").alias("n"))


@query(
    "SRC-15",
    "log_payload_decode",
    """SELECT CASE WHEN bad THEN NULL ELSE event_id END AS id, CASE WHEN bad OR user_id % 10 = 0 THEN NULL ELSE user_id END AS usr,
              CASE WHEN bad THEN NULL ELSE event_type END AS kind, count(*) AS n
       FROM (SELECT *, event_id % 97 = 0 AS bad FROM events) GROUP BY 1, 2, 3""",
)
def log_payload_decode(t):
    # Payloads are text as a log would carry them: some without a user, some
    # broken.  Every payload still gives a row.
    row = F.struct(
        F.col("event_id").alias("id"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("usr"),
        F.struct(F.col("event_type").alias("type")).alias("event"),
    )
    payload = F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(F.to_json(row))
    log = event_stream(t, delay=None).select(F.encode(payload, "UTF-8").alias("value"))
    schema = "id BIGINT, usr BIGINT, event STRUCT<type: STRING>"
    decoded = log.select(F.from_json(F.decode("value", "UTF-8"), schema).alias("r"))
    rows = run_append(decoded.select("r.id", "r.usr", F.col("r.event.type").alias("kind")), "log-json")
    return rows.groupBy("id", "usr", "kind").agg(F.count("*").alias("n"))


@query(
    "SRC-15",
    "log_csv_decode",
    "SELECT event_id AS id, user_id AS usr, event_type AS kind FROM events",
)
def log_csv_decode(t):
    text = F.to_csv(F.struct("event_id", "user_id", "event_type"))
    log = event_stream(t, delay=None).select(F.encode(text, "UTF-8").alias("value"))
    decoded = log.select(F.from_csv(F.decode("value", "UTF-8"), "id BIGINT, usr BIGINT, kind STRING").alias("r"))
    return run_append(decoded.select("r.*"), "log-csv")


@query("SRC-16", "hybrid_source", "SELECT event_id, user_id FROM events")
def hybrid_source(t):
    # History up to the switch comes from the table, the rest from the stream;
    # both go to one table and the switch keeps them from overlapping.
    switch = "2024-01-12 00:00:00"
    out = new_folder(t.spark, "hybrid")
    history = t.events.where(F.col("ts") < F.lit(switch).cast("timestamp_ntz")).select("event_id", "user_id")
    batch_writer(out)(history, -1)
    before = F.coalesce(F.col("ts") < F.lit(switch).cast("timestamp"), F.lit(False))
    live = event_stream(t, delay=None).where(~before).select("event_id", "user_id")
    run_batches(live, "hybrid-run", batch_writer(out))
    return read_batches(t.spark, out, live).drop("batch_id")


@query(
    "SNK-02",
    "rolling_files",
    "SELECT event_id, event_type, value FROM events",
)
def rolling_files(t):
    rows = event_stream(t, delay=None).select("event_id", "event_type", "value")
    return run_append(rows, "rolling", fmt="csv", options={"maxRecordsPerFile": "1000000"})


@query("SNK-12", "exactly_once", "SELECT event_id, user_id, value FROM events")
def exactly_once(t):
    # Every batch is delivered twice and the query is started again on its
    # finished checkpoint: the table still holds each row once.
    out, work = new_folder(t.spark, "once"), new_folder(t.spark, "once-run")
    write = batch_writer(out)

    def twice(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        write(rows, batch_id)

    stream = event_stream(t, delay=None).select("event_id", "user_id", "value")
    run_batches(stream, "once", twice, folder=work)
    run_batches(stream, "once", twice, folder=work)
    return read_batches(t.spark, out, stream).drop("batch_id")


@query(
    "SNK-13",
    "upsert_stream",
    f"SELECT user_id, count(*) AS n, {event_time.CENTS} AS cents FROM events GROUP BY user_id",
)
def upsert_stream(t):
    totals = (
        event_stream(t, delay=None)
        .groupBy("user_id")
        .agg(F.count("*").alias("n"), F.sum(units("value")).alias("cents"))
    )
    return run_upserts(totals, "upsert", ["user_id"])


@query(
    "PRJ-20",
    "side_outputs_stream",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'errors' WHEN value > 100 THEN 'large' ELSE 'main' END AS output
       FROM events""",
)
def side_outputs_stream(t):
    errors, large = P.SideOutput("errors"), P.SideOutput("large")
    base = new_folder(t.spark, "sides")

    def route(rows: DataFrame, batch_id: int) -> None:
        split = P.split_rows(
            rows, {errors: F.col("event_type") == "error", large: F.col("value") > 100}
        )
        # One write per batch; the tag is the output's folder.
        split.tagged.write.mode("overwrite").partitionBy("__tag").parquet(f"{base}/batch_id={batch_id}")

    stream = event_stream(t, delay=None).select("event_id", "event_type", "value")
    run_batches(stream, "sides-run", route)
    rows = t.spark.read.schema("event_id BIGINT, __tag STRING, batch_id BIGINT").parquet(base)
    return rows.select("event_id", F.col("__tag").alias("output"))


@query(
    "FUN-15",
    "json_value_stream",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_value_stream(t):
    rows = event_stream(t, delay=None)
    return run_append(rows.select("event_id", S.json_value(F.col("props"), "$.k", "int").alias("k")), "json")
