"""Event-time operators on bounded tables; streaming twins are in stream_jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.exact import units
from millrace.operators import changelog as C
from millrace.operators import iteration, patterns
from millrace.operators.ordered import By, sessions, top_n
from millrace.plans.registry import query
from millrace.streaming import transforms as W

CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)"

TUMBLE_SQL = f"""SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS rowtime,
    count(*) AS n, {CENTS} AS cents FROM events GROUP BY user_id, time_bucket(INTERVAL 1 HOUR, ts)"""

CASCADE_SQL = f"""WITH inner_w AS (SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS n, {CENTS} AS c
    FROM events GROUP BY 1, 2)
  SELECT time_bucket(INTERVAL 6 HOUR, w) AS window_start, count(*) AS inner_windows,
         CAST(sum(n) AS BIGINT) AS n, CAST(sum(c) AS BIGINT) AS cents
  FROM inner_w GROUP BY 1"""

HOP_SQL = f"""SELECT event_type, w AS window_start, count(*) AS n, {CENTS} AS cents
  FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 90 MINUTE,
                          time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 60 MINUTE,
                          time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE,
                          time_bucket(INTERVAL 30 MINUTE, ts)]) AS w FROM events)
  GROUP BY 1, 2"""


def session_sql(gap: str) -> str:
    return f"""WITH g AS (SELECT *, ts + ({gap}) AS closes FROM events),
      m AS (SELECT *, max(closes) OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
      s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM m)
      SELECT user_id, min(ts) AS session_start, max(closes) AS session_end, count(*) AS n, {CENTS} AS cents
      FROM s GROUP BY user_id, no"""


SESSION_SQL = session_sql("INTERVAL 1 HOUR")
DYNAMIC_SQL = session_sql("CASE WHEN event_type = 'error' THEN INTERVAL 10 MINUTE ELSE INTERVAL 2 HOUR END")


@query("STR-02", "tumbling_window", TUMBLE_SQL)
def tumbling_window(t):
    return W.tumbling(t.events)


@query("STR-03", "cascaded_windows", CASCADE_SQL)
def cascaded_windows(t):
    return W.cascaded(t.events)


@query("STR-04", "sliding_window", HOP_SQL)
def sliding_window(t):
    return W.hopping(t.events)


def _session_totals(rows):
    return rows.groupBy("user_id", "session_start").agg(
        F.max("closes").alias("session_end"), F.count("*").alias("n"), F.sum(units("value")).alias("cents")
    )


@query("STR-05", "session_window", SESSION_SQL)
def session_window(t):
    rows = sessions(t.events.drop("props"), ["user_id"], "ts", "event_id", F.lit(3600))
    return _session_totals(rows.withColumn("closes", F.col("ts") + F.expr("interval 1 hour")))


@query("STR-06", "dynamic_session_window", DYNAMIC_SQL)
def dynamic_session_window(t):
    error = F.col("event_type") == "error"
    rows = sessions(t.events.drop("props"), ["user_id"], "ts", "event_id", F.when(error, 600).otherwise(7200))
    closes = F.when(error, F.col("ts") + F.expr("interval 10 minutes")).otherwise(
        F.col("ts") + F.expr("interval 2 hours")
    )
    return _session_totals(rows.withColumn("closes", closes))


CDC_SQL = """SELECT user_id, max_by(event_id, event_id) AS version, max_by(value, event_id) AS value,
    max_by(note, event_id) AS note
  FROM (SELECT user_id, event_id, value, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN event_type END AS note FROM events)
  GROUP BY user_id HAVING max_by(event_type, event_id) <> 'signup' OR max(CASE WHEN note IS NOT NULL THEN 1 END) IS NULL"""


@query("STR-21", "cdc_merge", CDC_SQL)
def cdc_merge(t):
    snapshot, changes = W.cdc_inputs(t.events)
    return C.apply_changes(snapshot, changes, ["user_id"], "version")


@query(
    "STR-22",
    "strict_pattern",
    """SELECT user_id, e1 AS event_id_1, e2 AS event_id_2, event_id AS event_id_3 FROM (
         SELECT *, lag(event_id, 2) OVER w AS e1, lag(event_id) OVER w AS e2, lag(ts, 2) OVER w AS t1,
                lag(event_type, 2) OVER w AS k1, lag(event_type) OVER w AS k2
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       WHERE k1 = 'view' AND k2 = 'click' AND event_type = 'purchase' AND ts - t1 <= INTERVAL 1 DAY""",
)
def strict_pattern(t):
    kinds = ["view", "click", "purchase"]
    return patterns.strict_sequence(
        t.events,
        ["user_id"],
        ["ts", "event_id"],
        [F.col("event_type") == k for k in kinds],
        86400,
        ["event_id"],
    )


FOLLOWED_SQL = """WITH p AS (SELECT user_id, ts, event_id,
      first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER f AS e3,
      first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER f AS t3, event_type
    FROM events WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
  q AS (SELECT *, first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER f AS e2,
      first_value(CASE WHEN event_type = 'click' THEN coalesce(e3, -1) END IGNORE NULLS) OVER f AS c3,
      first_value(CASE WHEN event_type = 'click' THEN coalesce(t3, TIMESTAMP '9999-01-01') END IGNORE NULLS) OVER f AS ct3
    FROM p WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
  SELECT user_id, event_id AS event_id_1, CASE WHEN ok THEN e2 END AS event_id_2, CASE WHEN ok THEN c3 END AS event_id_3, ok AS matched
  FROM (SELECT *, coalesce(ct3 - ts <= INTERVAL 2 DAY, FALSE) AS ok FROM q WHERE event_type = 'signup')"""


@query("STR-22", "followed_by_pattern", FOLLOWED_SQL)
def followed_by_pattern(t):
    kinds = ["signup", "click", "purchase"]
    return patterns.followed_by(
        t.events,
        ["user_id"],
        ["ts", "event_id"],
        [F.col("event_type") == k for k in kinds],
        2 * 86400,
        ["event_id"],
    )


# Which event may follow which, for the state-machine check.
ALLOWED = {
    "signup": ["view", "click", "error"],
    "view": ["view", "click", "error"],
    "click": ["view", "click", "purchase", "error"],
    "purchase": ["view", "signup", "error"],
    "error": ["view", "error", "signup"],
}
MACHINE_SQL = (
    """SELECT event_id, user_id, previous_state, event_type FROM (
         SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_state FROM events)
       WHERE previous_state IS NOT NULL AND NOT ("""
    + " OR ".join(
        f"(previous_state = '{a}' AND event_type IN ({', '.join(repr(b) for b in bs)}))" for a, bs in ALLOWED.items()
    )
    + ")"
)


@query("STR-23", "state_machine", MACHINE_SQL)
def state_machine(t):
    return patterns.illegal_transitions(
        t.events, ["user_id"], ["ts", "event_id"], "event_type", ALLOWED
    ).select("event_id", "user_id", "previous_state", "event_type")


@query(
    "STR-24",
    "connected_components",
    """WITH RECURSIVE near AS (
         SELECT user_id AS a, lag(user_id) OVER (ORDER BY ts, event_id) AS b,
                ts - lag(ts) OVER (ORDER BY ts, event_id) AS gap FROM events),
       e AS (SELECT DISTINCT a, b FROM near WHERE gap < INTERVAL 3 SECOND AND a <> b
             UNION SELECT DISTINCT b, a FROM near WHERE gap < INTERVAL 3 SECOND AND a <> b),
       reach(v, r) AS (SELECT a, a FROM e UNION SELECT reach.v, e.b FROM reach JOIN e ON e.a = reach.r)
       SELECT v AS vertex, min(r) AS component FROM reach GROUP BY v""",
)
def connected_components(t):
    # Users whose events follow each other within 3 seconds are linked.
    from millrace.operators.ordered import Running, running

    seen = running(
        t.events.select("user_id", "ts", "event_id"),
        [],
        ["ts", "event_id"],
        [Running("before", "lag", F.struct("user_id", "ts"))],
    )
    gap = patterns.micros(F.col("ts")) - patterns.micros(F.col("before.ts"))
    edges = seen.where((gap < 3_000_000) & (F.col("user_id") != F.col("before.user_id"))).select(
        F.col("user_id").alias("src"), F.col("before.user_id").alias("dst")
    )
    return iteration.connected_components(edges)


@query(
    "STR-26",
    "evictor",
    f"""SELECT user_id, day, count(*) AS kept, {CENTS} AS cents FROM (
         SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                   ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 3 GROUP BY 1, 2""",
)
def evictor(t):
    rows = t.events.withColumn("day", F.to_date("ts"))
    kept = top_n(rows, ["user_id", "day"], [By("ts", False), By("event_id", False)], 3)
    return kept.groupBy("user_id", "day").agg(F.count("*").alias("kept"), F.sum(units("value")).alias("cents"))
