"""Streaming jobs on windows: triggers, process functions, patterns with a match buffer."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.exact import units
from millrace.operators import delta_windows as D
from millrace.plans import event_time
from millrace.plans.registry import query
from millrace.scratch import new_folder
from millrace.streaming import delta as SD
from millrace.streaming import matching as M
from millrace.streaming import triggers as G
from millrace.streaming import transforms as W
from millrace.streaming import window_process as P
from millrace.streaming.replay import event_stream
from millrace.streaming.runner import run_append

HOUR_MS = 3_600_000
CENTS = f"coalesce({event_time.CENTS}, 0)"  # an accumulator starts at nothing


@query(
    "STR-08",
    "event_time_trigger",
    f"""SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, {CENTS} AS cents
        FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def event_time_trigger(t):
    fired = run_append(G.triggered(event_stream(t), "event_time", HOUR_MS, HOUR_MS), "event-time-trigger")
    return fired.select("user_id", W.plain(F.col("window_start")).alias("window_start"), "n", "cents")


_PANES = f"""SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS w, time_bucket(INTERVAL 1 HOUR, ts) AS p,
                    count(*) AS n, {CENTS} AS cents FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""


@query(
    "STR-08",
    "continuous_trigger",
    f"""WITH panes AS ({_PANES}),
          borders AS (SELECT user_id, w, unnest(generate_series(min(p) + INTERVAL 1 HOUR, w + INTERVAL 6 HOUR, INTERVAL 1 HOUR)) AS fired_at
                      FROM panes GROUP BY user_id, w)
        SELECT b.user_id, b.w AS window_start, b.fired_at, CAST(sum(n) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM borders b JOIN panes x ON x.user_id IS NOT DISTINCT FROM b.user_id AND x.w = b.w AND x.p < b.fired_at
        GROUP BY 1, 2, 3""",
)
def continuous_trigger(t):
    # Six-hour windows that report at every full hour once they hold a row.
    return _borders(run_append(G.triggered(event_stream(t), "continuous", 6 * HOUR_MS, HOUR_MS), "continuous-trigger"))


def _borders(fired):
    times = [W.plain(F.col(c)).alias(c) for c in ("window_start", "fired_at")]
    return fired.select("user_id", *times, "n", "cents")


@query(
    "STR-08",
    "purging_trigger",
    f"SELECT user_id, w AS window_start, p + INTERVAL 1 HOUR AS fired_at, n, cents FROM ({_PANES})",
)
def purging_trigger(t):
    # The same borders, but each report drops what it has reported.
    fired = G.triggered(event_stream(t), "continuous", 6 * HOUR_MS, HOUR_MS, purge=True)
    return _borders(run_append(fired, "purging-trigger"))


@query(
    "STR-08",
    "never_trigger",
    f"SELECT user_id, count(*) AS n, {CENTS} AS cents, CAST(0 AS BIGINT) AS fired FROM events GROUP BY user_id",
)
def never_trigger(t):
    # The global window never reports; what it has gathered is read from the state store.
    work = new_folder(t.spark, "never-trigger")
    trigger = G.PaneTrigger("never", HOUR_MS, HOUR_MS)
    panes = G.summed_panes(event_stream(t), None)
    fired = run_append(G.K.apply(panes, "user_id", trigger, trigger.schema, "EventTime"), "never", folder=work)
    held = G.held_accumulators(t.spark, f"{work}/checkpoint")
    return held.select("user_id", "n", "cents", F.lit(fired.count()).cast("bigint").alias("fired"))


_TOP = f"""count(*) AS n, {CENTS} AS cents,
    arg_min(event_id, {{'v': -value, 'e': event_id}}) FILTER (WHERE value IS NOT NULL) AS top_event,
    arg_min(event_id, {{'t': ts, 'e': event_id}}) AS first_event"""


def _closes(rows):
    return rows.withColumn("window_end", W.plain(F.timestamp_millis("closes_ms"))).drop("closes_ms")


@query(
    "STR-14",
    "window_process_function",
    f"""SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, {_TOP}
        FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def window_process_function(t):
    windows = P.process_windows(event_stream(t), "user_id", P.TopAndTotal(), 24 * HOUR_MS)
    rows = _closes(run_append(windows, "window-process"))
    return rows.withColumn("user_id", F.when(~F.col("no_key"), F.col("key"))).drop("key", "no_key")


@query(
    "STR-14",
    "all_window_process_function",
    f"""SELECT time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, {_TOP}
        FROM events WHERE ts IS NOT NULL GROUP BY 1""",
)
def all_window_process_function(t):
    return _closes(run_append(P.process_all_windows(event_stream(t), P.TopAndTotal(), 24 * HOUR_MS), "all-window"))


def _alerts(rows: pd.DataFrame) -> pd.DataFrame:
    errors = rows[rows["event_type"] == "error"][["event_id"]].assign(output="alert")
    large = rows[rows["value"] > 100][["event_id"]]
    return pd.concat([errors, large.assign(output="large"), large.assign(output="audit")])


@query(
    "STR-14",
    "unkeyed_process_function",
    """SELECT event_id, 'alert' AS output FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, unnest(['large', 'audit']) FROM events WHERE value > 100""",
)
def unkeyed_process_function(t):
    # No row, one or several for each: errors, and large values twice.
    return run_append(P.process_rows(event_stream(t, delay=None), _alerts, "event_id BIGINT, output STRING"), "unkeyed")


SEQUENCE = ["signup", "click", "purchase"]


@query("STR-22", "followed_by_stream", event_time.FOLLOWED_SQL.replace("FROM events WINDOW", "FROM events WHERE ts IS NOT NULL WINDOW"))
def followed_by_stream(t):
    conditions = [F.col("event_type") == k for k in SEQUENCE]
    return run_append(M.followed_by(event_stream(t), conditions, 2 * 86400), "followed-by")


_ROUGH = "(SELECT event_id, user_id, event_type, value, date_trunc('hour', ts) AS ts FROM events WHERE ts IS NOT NULL)"


@query(
    "STR-22",
    "followed_by_comparator",
    event_time.FOLLOWED_SQL.replace("FROM events WINDOW", f"FROM {_ROUGH} WINDOW")
    .replace("ORDER BY ts, event_id", "ORDER BY ts, value DESC NULLS LAST, event_id")
    .replace("SELECT user_id, ts, event_id,", "SELECT user_id, ts, value, event_id,"),
)
def followed_by_comparator(t):
    # Times in full hours: within an hour the larger value comes first, then the smaller id.
    rough = event_stream(t).withColumn("hour", F.date_trunc("hour", "ts"))
    conditions = [F.col("event_type") == k for k in SEQUENCE]
    found = M.followed_by(rough, conditions, 2 * 86400, -units("value"), F.col("hour"), 3600)
    return run_append(found, "comparator")


DELTA_CENTS = 50_000  # a window ends once a user's values have added up to more than 500 since the last cut
_WALK = f"""WITH RECURSIVE r AS (
      SELECT user_id, event_id, ts, cents, row_number() OVER w AS pos, sum(abs(coalesce(cents, 0))) OVER w AS dist
      FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE ts IS NOT NULL)
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    walk AS (
      SELECT user_id, pos, dist AS base, false AS closes, CAST(0 AS BIGINT) AS window_no FROM r WHERE pos = 1
      UNION ALL
      SELECT r.user_id, r.pos, CASE WHEN r.dist - k.base > {DELTA_CENTS} THEN r.dist ELSE k.base END,
             r.dist - k.base > {DELTA_CENTS}, k.window_no + CAST(k.closes AS BIGINT)
      FROM walk k JOIN r ON r.user_id IS NOT DISTINCT FROM k.user_id AND r.pos = k.pos + 1)"""
_MAX_PER_DELTA = f"""{_WALK}
    SELECT user_id, window_no, count(*) AS n, max(cents) AS top_cents,
           arg_min(event_id, {{'v': -cents, 'e': event_id}}) FILTER (WHERE cents IS NOT NULL) AS top_event
    FROM walk JOIN r USING (pos) WHERE walk.user_id IS NOT DISTINCT FROM r.user_id
    GROUP BY ALL HAVING bool_or(closes)""".replace("SELECT user_id, window_no", "SELECT r.user_id, window_no")


def _delta_rows(t):
    timed = t.events.where("ts IS NOT NULL").select("user_id", "ts", "event_id", units("value").alias("cents"))
    return D.delta_windows(timed, ["user_id"], ["ts", "event_id"], F.col("cents"), DELTA_CENTS)


@query("STR-23", "max_per_delta_window", _MAX_PER_DELTA)
def max_per_delta_window(t):
    best = F.struct(-F.col("cents"), "event_id")
    return D.closed_windows(
        _delta_rows(t),
        ["user_id"],
        [
            F.count("*").alias("n"),
            F.max("cents").alias("top_cents"),
            F.min_by("event_id", F.when(F.col("cents").isNotNull(), best)).alias("top_event"),
        ],
    )


@query("STR-23", "max_per_delta_window_stream", _MAX_PER_DELTA)
def max_per_delta_window_stream(t):
    return run_append(SD.max_per_delta_window(event_stream(t), "user_id", DELTA_CENTS), "delta-windows")


@query(
    "STR-26",
    "delta_evictor",
    f"""{_WALK},
      placed AS (SELECT r.*, window_no, closes FROM walk JOIN r USING (pos) WHERE walk.user_id IS NOT DISTINCT FROM r.user_id),
      last AS (SELECT user_id AS u, window_no AS w, cents AS last_cents FROM placed WHERE closes)
    SELECT user_id, window_no, count(*) AS kept, CAST(sum(cents) AS BIGINT) AS cents
    FROM placed JOIN last ON u IS NOT DISTINCT FROM user_id AND w = window_no
    WHERE abs(cents - last_cents) < 2000 GROUP BY 1, 2""",
)
def delta_evictor(t):
    # When a delta window ends, only rows within 20 of its last value are summed.
    windows = ["user_id", "window_no"]
    kept = D.evict_by_delta(_delta_rows(t), windows, ["ts", "event_id"], F.col("cents"), 2000)
    # The closing row is the last one, so it is kept and tells that the window is over.
    return D.closed_windows(kept, ["user_id"], [F.count("*").alias("kept"), F.sum("cents").alias("cents")])
