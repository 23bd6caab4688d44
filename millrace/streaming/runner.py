"""Run a streaming query over a bounded source to completion.

State lives in RocksDB with changelog checkpoints; files, checkpoints and
results are under the shared folder, so a restart on another executor resumes.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from millrace.scratch import new_folder
from millrace.session import ROCKSDB_PROVIDER
@contextmanager
def stream_settings(spark: SparkSession, **extra: str) -> Iterator[None]:
    """Settings a query picks up when it starts, put back afterwards.

    The number of state partitions is fixed for the life of a checkpoint, so it
    follows the cluster's parallelism rather than one query's shuffle setting.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        **extra,
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_append(
    stream: DataFrame,
    label: str,
    folder: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    settings: dict[str, str] | None = None,
) -> DataFrame:
    """Append-mode query into a file table with exactly-once commits; read it back.

    Passing the ``folder`` of an earlier run resumes that run's checkpoint.
    """
    spark = stream.sparkSession
    base = folder or new_folder(spark, label)
    with stream_settings(spark, **(settings or {})):
        query = (
            stream.writeStream.format(fmt)
            .options(**(options or {}))
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start(f"{base}/data")
        )
        query.awaitTermination()
    reader = spark.read.schema(stream.schema)
    return reader.format(fmt).options(**(options or {})).load(f"{base}/data")


def run_batches(
    stream: DataFrame,
    label: str,
    handle: Callable[[DataFrame, int], None],
    mode: str = "append",
    folder: str | None = None,
    settings: dict[str, str] | None = None,
):
    """Run with a function per micro-batch; returns the finished query."""
    spark = stream.sparkSession
    base = folder or new_folder(spark, label)
    with stream_settings(spark, **(settings or {})):
        query = (
            stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Idempotent sink: a replayed batch overwrites its own folder, so nothing doubles."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, out: str, stream: DataFrame) -> DataFrame:
    """All rows a ``batch_writer`` stored, with their ``batch_id``."""
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(out)


def run_upserts(
    stream: DataFrame, label: str, keys: Sequence[str], mode: str = "update", settings: dict | None = None
) -> DataFrame:
    """Update-mode query as keyed upserts: the newest row of each key.

    Batches are stored as they come and merged when read, so a batch costs its
    own rows and not the size of the table.
    """
    spark = stream.sparkSession
    out = new_folder(spark, f"{label}-upserts")
    run_batches(stream, label, batch_writer(out), mode, settings=settings)
    from millrace.operators.ordered import keep_one

    return keep_one(read_batches(spark, out, stream), keys, ["batch_id"], latest=True).drop("batch_id")


class _WatermarkReports(StreamingQueryListener):
    """Keeps batch id and watermark of every progress report of one query by name."""

    def __init__(self, name: str):
        self.name, self.rows, self.run_id, self.over = name, [], None, threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event):
        p = event.progress
        if p.name == self.name:
            self.rows.append((p.batchId, (p.eventTime or {}).get("watermark")))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run_id:
            self.over.set()


def watch_watermarks(stream: DataFrame, label: str) -> DataFrame:
    """Run to completion; (batch_id, watermark) of every progress report, in a table.

    A query's own list of reports keeps the last hundred only.
    """
    spark, base = stream.sparkSession, new_folder(stream.sparkSession, label)
    listener = _WatermarkReports(base.rsplit("/", 1)[-1])
    spark.streams.addListener(listener)
    try:
        with stream_settings(spark):
            query = (
                stream.writeStream.foreachBatch(batch_writer(f"{base}/data"))
                .queryName(listener.name)
                .option("checkpointLocation", f"{base}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        if not listener.over.wait(300):
            raise RuntimeError("the end of the query was never reported")
    finally:
        spark.streams.removeListener(listener)
    reports = f"{base}/reports"
    spark.createDataFrame(listener.rows, "batch_id BIGINT, watermark STRING").write.parquet(reports)
    return spark.read.schema("batch_id BIGINT, watermark STRING").parquet(reports)


def run_in_mode(rows: DataFrame, mode: str, label: str) -> tuple[DataFrame, str]:
    """Final rows of a program, and the mode it ran in.

    AUTOMATIC takes BATCH if every input is bounded.  STREAMING asks for a stream, and
    BATCH for bounded input.
    """
    fitting = "STREAMING" if rows.isStreaming else "BATCH"
    if mode not in ("AUTOMATIC", fitting):
        raise ValueError(f"{mode} does not fit this input")
    return (run_append(rows, label) if rows.isStreaming else rows), fitting
