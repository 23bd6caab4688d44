"""Streaming behaviour that a final result does not show."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.scratch import new_folder
from millrace.streaming import processors as K
from millrace.streaming.runner import batch_writer, read_batches, run_append, run_batches

SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"


def _add(spark, folder, rows):
    df = spark.createDataFrame(
        [(i, pd.Timestamp(ts).to_pydatetime(), u, k, v) for i, ts, u, k, v in rows], SCHEMA
    )
    df.coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_native_ttl_expires_between_runs(spark):
    source, work = new_folder(spark, "in"), new_folder(spark, "ttl")
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}

    def run():
        p = K.RunningSum(ttl_ms=1500)
        stream = K.apply(_stream(spark, source), "user_id", p, p.schema, "ProcessingTime")
        return {r.event_id: r.running_cents for r in run_append(stream, "t", folder=work, settings=settings).collect()}

    _add(spark, source, [(1, "2024-01-01 00:00:00", 7, "a", 1.0), (2, "2024-01-01 00:00:01", 7, "a", 2.0)])
    assert run() == {1: 100, 2: 300}
    time.sleep(3)
    _add(spark, source, [(3, "2024-01-01 00:00:02", 7, "a", 5.0)])
    assert run()[3] == 500


def test_event_time_ttl_is_inclusive(spark):
    source = new_folder(spark, "in")
    _add(
        spark,
        source,
        [
            (1, "2024-01-01 00:00:00", 1, "a", 1.0),
            (2, "2024-01-01 00:00:09.999999", 1, "a", 1.0),
            (3, "2024-01-01 00:00:19.999999", 1, "a", 1.0),
        ],
    )
    p = K.EventTimeTtlSum(10_000_000)
    got = run_append(K.apply(_stream(spark, source), "user_id", p, p.schema), "ttl")
    # Expired once last access + ttl <= now.
    assert {r.event_id: r.running_cents for r in got.collect()} == {1: 100, 2: 200, 3: 100}


def test_replayed_batch_does_not_double(spark):
    out = new_folder(spark, "out")
    df = spark.createDataFrame([(1,), (2,)], "a INT")
    write = batch_writer(out)
    write(df, 3)
    write(df, 3)
    write(df.limit(1), 4)
    rows = read_batches(spark, out, df)
    assert rows.count() == 3


def test_failed_batch_is_retried_once(spark):
    source, out, work = new_folder(spark, "in"), new_folder(spark, "out"), new_folder(spark, "w")
    _add(spark, source, [(i, "2024-01-01 00:00:00", i, "a", 1.0) for i in range(4)])
    write, failed = batch_writer(out), []

    def flaky(rows, batch_id):
        write(rows, batch_id)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run_batches(_stream(spark, source), "x", flaky, folder=work)
    run_batches(_stream(spark, source), "x", flaky, folder=work)
    assert read_batches(spark, out, spark.read.schema(SCHEMA).parquet(source)).count() == 4


def test_text_folder_is_monitored(spark, tmp_path):
    from millrace.sources.files import monitored_lines

    work = new_folder(spark, "lines")
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert run_append(monitored_lines(spark, str(tmp_path)), "l", folder=work).count() == 2
    (tmp_path / "b.txt").write_text("three\n")
    got = run_append(monitored_lines(spark, str(tmp_path)), "l", folder=work)
    assert sorted(r.value for r in got.collect()) == ["one", "three", "two"]


def test_state_is_spread_over_keys(spark):
    source = new_folder(spark, "in")
    _add(spark, source, [(i, "2024-01-01 00:00:00", i % 3, "a", 1.0) for i in range(9)])
    p = K.CountTrigger(3, purge=True)
    got = run_append(K.apply(_stream(spark, source), "user_id", p, p.schema), "c").groupBy("user_id").agg(F.sum("cents"))
    assert {r[0]: r[1] for r in got.collect()} == {0: 300, 1: 300, 2: 300}
