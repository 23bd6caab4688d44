"""Streaming jobs on the part-file sink: delivery guarantees, rolling and naming."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.scratch import new_folder
from millrace.sources.staged_sink import run_part_files
from millrace.streaming.replay import event_stream

DELIVERED = "event_id BIGINT, user_id BIGINT, value DOUBLE"


def _after_a_loss(t, guarantee: str, when: str) -> DataFrame:
    """Rows readers see after a run that lost one commit and was started again on its checkpoint."""
    stream = event_stream(t, delay=None).select("event_id", "user_id", "value")
    work = new_folder(t.spark, f"delivery-{guarantee}")
    options = {"guarantee": guarantee, "failOnce": when}
    try:
        run_part_files(stream, "delivery", work, **options)
    except StreamingQueryException:
        run_part_files(stream, "delivery", work, **options)
    return t.spark.read.schema(DELIVERED).csv(f"{work}/out/data")


@query("SNK-12", "commit_log_before_loss", "SELECT event_id, user_id, value FROM events")
def commit_log_before_loss(t):
    # The files of a batch were written, but the driver was lost before it committed them.
    return _after_a_loss(t, "exactly_once", "before")


@query("SNK-12", "commit_log_after_loss", "SELECT event_id, user_id, value FROM events")
def commit_log_after_loss(t):
    # The batch was published, but the engine never heard of it and delivers it again.
    return _after_a_loss(t, "exactly_once", "after")


_ALL_WITH_REPEATS = """SELECT event_id, user_id, value, TRUE AS repeated FROM (SELECT count(*) AS n FROM events), events WHERE n > 0"""


def _repeats(rows: DataFrame) -> DataFrame:
    """Every delivered row once, and whether any row was delivered more than once."""
    counted = rows.groupBy("event_id", "user_id", "value").agg(F.count(F.lit(1)).alias("times"))
    again = counted.agg(F.coalesce(F.max("times") > 1, F.lit(False)).alias("repeated"))
    return counted.drop("times").crossJoin(F.broadcast(again))


@query("SNK-12", "at_least_once", _ALL_WITH_REPEATS)
def at_least_once(t):
    return _repeats(_after_a_loss(t, "at_least_once", "after"))


@query("SNK-12", "no_guarantee", _ALL_WITH_REPEATS)
def no_guarantee(t):
    # Nothing is staged: the rows of the lost attempt are seen as well.
    return _repeats(_after_a_loss(t, "none", "before"))


ROLL_ROWS = 300


@query(
    "SNK-02",
    "named_rolling_parts",
    "SELECT count(*) AS n, TRUE AS well_named, TRUE AS within_bound, TRUE AS full_but_last FROM events",
)
def named_rolling_parts(t):
    rows = event_stream(t, delay=None).select("event_id", "user_id", "value")
    options = {"prefix": "events", "suffix": ".part.csv", "rollRows": str(ROLL_ROWS)}
    folder = run_part_files(rows, "rolling-parts", **options)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^events-(\d+)-\d+\.part\.csv$", 1)
    seen = t.spark.read.schema(DELIVERED).csv(folder).select(name.alias("batch"), F.col("_metadata.file_name").alias("file"))
    files = seen.groupBy("batch", "file").agg(F.count(F.lit(1)).alias("rows"))
    # A slice is one file, hence one task: all its parts but the last are full.
    batches = files.groupBy("batch").agg(
        F.sum("rows").alias("n"), F.max("rows").alias("most"), F.count_if(F.col("rows") < ROLL_ROWS).alias("short")
    )
    return batches.agg(
        F.sum("n").alias("n"),
        F.bool_and(F.col("batch") != "").alias("well_named"),
        F.bool_and(F.col("most") <= ROLL_ROWS).alias("within_bound"),
        F.bool_and(F.col("short") <= 1).alias("full_but_last"),
    )
