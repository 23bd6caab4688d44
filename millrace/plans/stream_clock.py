"""Streams under changing rules and on the machine's clock; run modes and savepoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exact import units
from millrace.plans import event_time
from millrace.plans.registry import query
from millrace.scratch import new_folder, written
from millrace.streaming import machine_time as M
from millrace.streaming import processors as K
from millrace.streaming import rules as R
from millrace.streaming import transforms as W
from millrace.streaming.replay import (
    Slices,
    end_micros,
    event_stream,
    real_rows,
    slice_stream,
    stage,
    write_end,
    write_slices,
)
from millrace.streaming.runner import batch_writer, read_batches, run_append, run_batches, run_in_mode
from millrace.streaming.savepoints import drop_folder, exists, kept_copy

SIZE_MS, SLIDE_MS, GAP_MS = 4000, 2000, 1500


def rule_versions(events: DataFrame, lo: int, hi: int) -> DataFrame:
    """(slice, kind, ts, floor_cents): per kind three versions, each from a third of the time on.

    The first floor is the kind's mean, the second its mean over the first third; from the
    last third on errors have no rule and all others half the first floor.
    """
    third = (hi - lo) // 3
    cents, early = units("value"), F.unix_micros(F.col("ts").cast("timestamp")) < lo + third
    means = events.groupBy(F.col("event_type").alias("kind")).agg(
        F.floor(F.sum(cents) / F.count("*")).alias("all_time"),
        F.floor(F.try_divide(F.sum(F.when(early, cents)), F.count_if(early))).alias("early"),
    )
    floors = (
        F.col("all_time"),
        F.col("early"),
        F.when(F.col("kind") != "error", F.floor(F.col("all_time") / 2)),
    )
    versions = F.array(*(F.struct(F.lit(lo + i * third).alias("at"), f.alias("floor_cents")) for i, f in enumerate(floors)))
    each = means.select("kind", F.posexplode(versions).alias("slice", "v"))
    return each.select("slice", "kind", F.timestamp_micros("v.at").alias("ts"), F.col("v.floor_cents").alias("floor_cents"))


@query(
    "STR-16",
    "changing_rules",
    """WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS cents FROM events
                  WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL),
            s AS (SELECT min(us) AS lo, (max(us) - min(us)) // 3 AS third FROM e),
            m AS (SELECT event_type AS kind, CAST(floor(sum(cents) / count(*)) AS BIGINT) AS all_time,
                         CAST(floor(sum(cents) FILTER (WHERE us < lo + third) / count(*) FILTER (WHERE us < lo + third)) AS BIGINT) AS early
                  FROM e, s GROUP BY 1),
            r AS (SELECT kind, lo AS us, all_time AS floor_cents FROM m, s
                  UNION ALL SELECT kind, lo + third, early FROM m, s
                  UNION ALL SELECT kind, lo + 2 * third, CASE WHEN kind <> 'error' THEN CAST(floor(all_time / 2) AS BIGINT) END FROM m, s)
       SELECT event_id, event_type, floor_cents, cents - floor_cents AS above
       FROM (SELECT e.*, r.floor_cents, row_number() OVER (PARTITION BY event_id ORDER BY r.us DESC) AS newest
             FROM e JOIN r ON kind = event_type AND r.us <= e.us)
       WHERE newest = 1 AND cents > floor_cents""",
)
def changing_rules(t):
    events = t.events.where("event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(micros), F.max(micros)).first()
    versions = rule_versions(events, lo or 0, hi or 0).withColumn("is_end", F.lit(False))
    written_at, folder = new_folder(t.spark, "rule-versions"), new_folder(t.spark, "rule-changes")
    versions.repartition("slice").write.partitionBy("slice").parquet(written_at)
    # One change per micro-batch, the earliest first: the rules change while events flow.
    changes = Slices(written_at, 3, 0, end_micros(lo, hi))
    write_slices(t.spark, changes, range(3), folder)
    write_end(t.spark, changes, folder)
    rules = R.rule_stream(t.spark, folder, "10 minutes")
    return run_append(R.ruled(event_stream(t), rules), "changing-rules")


@query(
    "STR-13",
    "processing_time_timers",
    "SELECT user_id, count(*) AS n, true AS in_time FROM events GROUP BY user_id",
)
def processing_time_timers(t):
    # How often a key fell silent depends on the machine; that its last report has all its
    # rows, and that no report came before the limit, does not.
    limit = 1500
    silence = M.MachineSilence(limit)
    stream = K.apply(M.summed_arrivals(event_stream(t, delay=None)), "user_id", silence, silence.schema, "ProcessingTime")
    reports = M.run_machine_time(stream, "machine-silence", limit)
    return reports.groupBy("user_id").agg(
        F.max("n").alias("n"), F.bool_and(F.col("fired_ms") - F.col("seen_ms") >= limit).alias("in_time")
    )


@query(
    "STR-07",
    "machine_time_windows",
    """WITH u AS (SELECT user_id, count(*) AS n, CAST(sum(CAST(round(coalesce(value, 0) * 100) AS BIGINT)) AS BIGINT) AS cents
                  FROM events GROUP BY user_id)
       SELECT user_id, kind, CAST(n * times AS BIGINT) AS n, CAST(cents * times AS BIGINT) AS cents, true AS agreed
       FROM u, (VALUES ('tumbling', 1), ('sliding', 2), ('session', 1)) AS k(kind, times)""",
)
def machine_time_windows(t):
    # Each reported window is compared with the one its arrivals imply: bounds, rows and cents.
    windows = M.MachineWindows(SIZE_MS, SLIDE_MS, GAP_MS)
    stream = K.apply(M.summed_arrivals(event_stream(t, delay=None)), "user_id", windows, windows.schema, "ProcessingTime")
    reports = M.run_machine_time(stream, "machine-windows", max(SIZE_MS, GAP_MS))
    got = reports.where("kind != 'arrival'").select("*", F.lit(1).alias("got"))
    want = M.recounted(reports, SIZE_MS, SLIDE_MS, GAP_MS).select("*", F.lit(-1).alias("got"))
    # Equal windows cancel out; anything left over is a difference.
    each = got.unionByName(want).groupBy("user_id", "kind", "start_ms", "end_ms", "n", "cents").agg(
        F.sum("got").alias("left"), F.count_if(F.col("got") == 1).alias("times")
    )
    return each.groupBy("user_id", "kind").agg(
        F.sum(F.col("n") * F.col("times")).alias("n"),
        F.sum(F.col("cents") * F.col("times")).alias("cents"),
        F.bool_and(F.col("left") == 0).alias("agreed"),
    )


@query(
    "STR-18",
    "automatic_mode",
    f"""WITH w AS ({event_time.TUMBLE_SQL})
        SELECT input, ran_as, count(*) AS windows, CAST(sum(n) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM w, (VALUES ('bounded', 'BATCH'), ('stream', 'STREAMING')) AS m(input, ran_as) GROUP BY 1, 2""",
)
def automatic_mode(t):
    totals = []
    for name, events in (("bounded", t.events), ("stream", event_stream(t))):
        rows, ran_as = run_in_mode(W.tumbling(events), "AUTOMATIC", f"automatic-{name}")
        totals.append(
            rows.agg(F.count("*").alias("windows"), F.sum("n").alias("n"), F.sum("cents").alias("cents")).select(
                F.lit(name).alias("input"), F.lit(ran_as).alias("ran_as"), "*"
            )
        )
    return totals[0].union(totals[1])


@query(
    "STR-19",
    "savepoint",
    f"""SELECT run, w.*, false AS checkpoint_left, true AS savepoint_left
        FROM ({event_time.TUMBLE_SQL}) AS w, (VALUES ('original'), ('from savepoint')) AS r(run)""",
)
def savepoint(t):
    # A run stops half-way and its checkpoint is copied; it then goes on to the end and its
    # own checkpoint is deleted.  A second run starts from the copy of the copy.
    spark = t.spark
    source, work, second = (new_folder(spark, f"savepoint-{x}") for x in ("in", "first", "second"))
    kept = new_folder(spark, "savepoint-kept")
    slices = stage(t)
    half = max(slices.count // 2, 1)

    def run(base: str) -> DataFrame:
        rows = W.tumbling(real_rows(slice_stream(spark, source), "10 minutes"))
        run_batches(rows, "savepoint", batch_writer(f"{base}/data"), folder=base)
        return read_batches(spark, f"{base}/data", rows)

    write_slices(spark, slices, range(half), source)
    before = written(run(work), "savepoint-before")
    kept_copy(spark, f"{work}/checkpoint", kept)
    write_slices(spark, slices, range(half, slices.count), source)
    write_end(spark, slices, source)
    original = run(work)
    drop_folder(spark, f"{work}/checkpoint")
    kept_copy(spark, kept, f"{second}/checkpoint")
    resumed = before.unionByName(run(second))
    left = [F.lit(exists(spark, f"{work}/checkpoint")).alias("checkpoint_left"), F.lit(exists(spark, kept)).alias("savepoint_left")]
    labelled = [rows.drop("batch_id").select(F.lit(run_).alias("run"), "*", *left) for run_, rows in (("original", original), ("from savepoint", resumed))]
    return labelled[0].union(labelled[1])
