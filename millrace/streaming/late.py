"""Late rows as a second output instead of a silent drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import new_folder
from millrace.streaming.runner import batch_writer, read_batches, run_batches


def split_late(stream: DataFrame, time: str, delay_seconds: int, label: str) -> tuple[DataFrame, DataFrame]:
    """Route rows behind ``max(time of earlier batches) - delay`` to a late table.

    The stream has no watermark, so nothing is dropped before the routing.  The
    clock is one row per batch in a small table; a replayed batch reads only
    the clocks of batches before it and overwrites its own output.
    """
    spark: SparkSession = stream.sparkSession
    base = new_folder(spark, label)
    clock_schema = "top TIMESTAMP, batch_id BIGINT"

    def handle(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        bound = None
        if batch_id > 0:
            clock = session.read.schema(clock_schema).parquet(f"{base}/clock")
            bound = clock.where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        late = (
            F.lit(False)
            if bound is None
            else F.coalesce(  # a row without a time is never late
                F.col(time) < F.lit(bound) - F.expr(f"interval {delay_seconds} seconds"), F.lit(False)
            )
        )
        batch_writer(f"{base}/rows")(rows.withColumn("late", late), batch_id)
        rows.agg(F.max(time).alias("top")).write.mode("overwrite").parquet(f"{base}/clock/batch_id={batch_id}")

    run_batches(stream, label, handle)
    routed = read_batches(spark, f"{base}/rows", stream.withColumn("late", F.lit(True)))
    routed = routed.drop("batch_id")
    return routed.where("NOT late").drop("late"), routed.where("late").drop("late")
