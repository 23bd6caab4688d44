"""Transforms that run unchanged on bounded tables and on streams.

The caller decides: ``spark.read`` gives final results at once, ``readStream``
with a watermark gives the same rows as windows close.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exact import units
from millrace.operators.changelog import AFTER, DELETE
from millrace.operators.ordered import keep_one


def plain(ts) -> F.Column:
    """A zone-less time column, whichever kind came in (session zone UTC)."""
    return ts.cast("timestamp_ntz")


def rowtime(window) -> F.Column:
    """Last instant of a window in milliseconds, the unit of time attributes."""
    return plain(F.date_trunc("millisecond", F.window_time(window)))


def tumbling(events: DataFrame) -> DataFrame:
    """Per user and hour: start, rowtime, count and sum."""
    return (
        events.groupBy("user_id", F.window("ts", "1 hour").alias("w"))
        .agg(F.count("*").alias("n"), F.sum(units("value")).alias("cents"))
        .select(
            "user_id", plain(F.col("w.start")).alias("window_start"), rowtime("w").alias("rowtime"), "n", "cents"
        )
    )


def cascaded(events: DataFrame) -> DataFrame:
    """Hourly per-user windows, re-windowed to six hours by the inner row time."""
    inner = events.groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(
        F.count("*").alias("n"), F.sum(units("value")).alias("cents")
    )
    return (
        inner.groupBy(F.window(F.window_time("w"), "6 hours").alias("outer_w"))
        .agg(
            F.count("*").alias("inner_windows"), F.sum("n").alias("n"), F.sum("cents").alias("cents")
        )
        .select(plain(F.col("outer_w.start")).alias("window_start"), "inner_windows", "n", "cents")
    )


def hopping(events: DataFrame) -> DataFrame:
    """Two-hour windows every 30 minutes, per event type."""
    return (
        events.groupBy("event_type", F.window("ts", "2 hours", "30 minutes").alias("w"))
        .agg(F.count("*").alias("n"), F.sum(units("value")).alias("cents"))
        .select("event_type", plain(F.col("w.start")).alias("window_start"), "n", "cents")
    )


def session_totals(events: DataFrame, gap) -> DataFrame:
    """Sessions per user by the built-in session window (fixed or per-row gap)."""
    return (
        events.groupBy("user_id", F.session_window("ts", gap).alias("w"))
        .agg(F.count("*").alias("n"), F.sum(units("value")).alias("cents"))
        .select(
            "user_id",
            plain(F.col("w.start")).alias("session_start"),
            plain(F.col("w.end")).alias("session_end"),
            "n",
            "cents",
        )
    )


CDC_CUT = "2024-01-10"


def cdc_rows(events: DataFrame) -> DataFrame:
    """Events read as row versions of a per-user table; a signup is a delete."""
    return events.select(
        "user_id",
        F.col("event_id").alias("version"),
        "value",
        F.col("event_type").alias("note"),
        F.when(F.col("event_type") == "signup", DELETE).otherwise(AFTER).alias("op"),
        plain(F.col("ts")).alias("ts"),
    )


def cdc_inputs(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Initial snapshot (no ``note`` column yet) and the changes after it."""
    cut = F.lit(CDC_CUT).cast("timestamp_ntz")
    snapshot = keep_one(
        events.where(F.col("ts") < cut).select("user_id", F.col("event_id").alias("version"), "value"),
        ["user_id"],
        ["version"],
        latest=True,
    )
    changes = cdc_rows(events).where(F.col("ts") >= cut).drop("ts")
    return snapshot, changes
