"""Replay slices, triggers, the match buffer and the part-file sink beyond their final results."""

import glob
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.scratch import new_folder
from millrace.sources import staged_sink as S
from millrace.streaming import matching as M
from millrace.streaming import replay as R
from millrace.streaming import triggers as G
from millrace.streaming.runner import run_append
from millrace.tables import SCHEMAS, Tables

START = datetime(2024, 1, 1)


def _table(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMAS["events"]).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    return Tables(spark, str(tmp_path))


def _event(i, at, user=1, kind="click", value=1.0):
    return (i, None if at is None else START + timedelta(seconds=at), user, kind, value, "{}")


def test_slices_are_equal_whatever_the_times(spark, tmp_path, monkeypatch):
    rows = [_event(i, None if i % 3 == 0 else i) for i in range(2997)]
    rows += [_event(3000 + i, 5000) for i in range(3000)] + [(9999, datetime(1970, 1, 1), 1, "click", 1.0, "{}")]
    t = _table(spark, tmp_path, rows)
    size = R.estimated_bytes(t.events)
    monkeypatch.setattr(R, "SLICE_BYTES", size // 12)
    slices = R.stage(t)
    counts = [r[1] for r in spark.read.parquet(slices.folder).groupBy("slice").count().collect()]
    assert slices.count >= 12 and sum(counts) == len(rows)
    assert max(counts) <= 2 * len(rows) / slices.count
    folder = new_folder(spark, "placed")
    R.write_slices(spark, slices, range(slices.count), folder)
    files = sorted(glob.glob(f"{folder}/*.parquet"), key=os.path.getmtime)
    assert len({os.path.getmtime(f) for f in files}) == len(files) == slices.count
    seen = [pd.read_parquet(f).sort_values(["ts", "event_id"]) for f in files]
    order = pd.concat(seen)["event_id"].tolist()
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[0]))
    assert order == [r[0] for r in want]


def _stream(spark, folder, batches):
    """One file per batch, then the end of the input."""
    for rows in batches:
        df = spark.createDataFrame(rows, SCHEMAS["events"]).withColumn("ts", F.col("ts").cast("timestamp"))
        df.withColumn("is_end", F.lit(False)).coalesce(1).write.mode("append").parquet(folder)
    R.write_end(spark, R.Slices(folder, 1, 0, R.end_micros(0, 1_800_000_000_000_000)), folder)
    return R.real_rows(R.slice_stream(spark, folder), "10 minutes")


def test_pane_sums_leave_the_reader_combined(spark):
    rows = [_event(i, i % 7200, user=None if i % 10 == 0 else 1) for i in range(20000)]
    events = spark.createDataFrame(rows, SCHEMAS["events"]).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1)
    panes = G.summed_panes(events, 3_600_000)
    held = panes.groupBy("user_id", "pane").agg(F.sum("n").alias("n"), F.sum("cents").alias("c")).collect()
    assert sum(r.n for r in held) == 20000 and len(held) == 4 and sum(r.c for r in held) == 2_000_000
    assert panes.count() <= 4 * 2  # 10,000 rows of an Arrow batch come as one row per key and pane


def test_continuous_trigger_starts_again_for_an_earlier_pane(spark):
    # The second batch brings an earlier pane of the same window, still ahead of the watermark.
    batches = [[_event(1, 3 * 3600 - 10)], [_event(2, 2 * 3600 + 3000)], [_event(3, 5 * 3600)]]
    stream = _stream(spark, new_folder(spark, "panes"), batches)
    got = run_append(G.triggered(stream, "continuous", 6 * 3_600_000, 3_600_000), "panes-run").collect()
    hours = sorted((int((r.fired_at - START).total_seconds()) // 3600, r.n) for r in got)
    assert hours == [(3, 2), (4, 2), (5, 2), (6, 3)]
    with pytest.raises(ValueError):
        G.PaneTrigger("sometimes", 10, 5)


def test_matches_survive_disorder_ties_and_shared_events(spark):
    kinds = ["a", "b", "c"]
    one = [_event(3, 20, kind="b"), _event(1, 0, kind="a"), _event(2, 10, kind="a"), _event(9, 0, user=2, kind="a")]
    two = [_event(4, 30, kind="a"), _event(6, 40, kind="c"), _event(5, 35, kind="b"), _event(7, 40, kind="b")]
    three = [_event(8, 900, kind="c"), _event(10, 901, kind="a"), _event(11, None, kind="c")]
    stream = _stream(spark, new_folder(spark, "disorder"), [one, two, three])
    found = M.followed_by(stream, [F.col("event_type") == k for k in kinds], 600)
    got = {tuple(r)[1:] for r in run_append(found, "disorder-run").collect()}
    assert got == {
        (1, 3, 6, True), (2, 3, 6, True), (4, 5, 6, True), (9, None, None, False), (10, None, None, False)
    }


def test_reverse_comparator_changes_a_tie(spark):
    rows = [_event(1, 5, kind="a", value=1.0), _event(2, 5, kind="b", value=2.0)]
    results = []
    for sign in (1, -1):
        stream = _stream(spark, new_folder(spark, "tie"), [rows])
        tie = (F.lit(sign) * F.col("value")).cast("bigint")
        found = M.followed_by(stream, [F.col("event_type") == k for k in "ab"], 60, tie)
        results += [tuple(r)[1:] for r in run_append(found, "tie-run").collect()]
    assert results == [(1, 2, True), (1, None, False)]


def _plain_stream(spark, folder, n):
    for i in range(n):
        spark.range(i * 100, i * 100 + 100).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("guarantee,when,times", [
    ("exactly_once", "before", 1), ("exactly_once", "after", 1), ("at_least_once", "after", 2),
    ("at_least_once", "before", 1), ("none", "before", 2),
])
def test_a_lost_commit(spark, guarantee, when, times):
    stream, work = _plain_stream(spark, new_folder(spark, "in"), 2), new_folder(spark, "work")
    options = {"guarantee": guarantee, "failOnce": when, "rollRows": "40"}
    with pytest.raises(StreamingQueryException, match="lost at commit"):
        S.run_part_files(stream, "x", work, **options)
    seen = spark.read.schema("id BIGINT").csv(f"{work}/out/data") if os.path.isdir(f"{work}/out/data") else None
    assert (0 if seen is None else seen.count()) == (100 if when == "after" or guarantee == "none" else 0)
    folder = S.run_part_files(stream, "x", work, **options)
    counts = spark.read.schema("id BIGINT").csv(folder).groupBy("id").count().collect()
    assert {r[0] for r in counts} == set(range(200))
    assert {r[1] for r in counts if r[0] < 100} == {times} and {r[1] for r in counts if r[0] >= 100} == {1}


def test_part_files_roll_and_carry_their_names(spark):
    stream = _plain_stream(spark, new_folder(spark, "in"), 2)
    names = {}
    for key, options in {
        "rows": {"rollRows": "30"}, "bytes": {"rollBytes": "1"}, "seconds": {"rollSeconds": "0"}, "whole": {}
    }.items():
        folder = S.run_part_files(stream, "roll", prefix="out", suffix=".txt", **options)
        names[key] = sorted(os.path.basename(p) for p in glob.glob(f"{folder}/*.txt"))
    assert names["rows"] == [f"out-{b}-{i}.txt" for b in range(2) for i in range(4)]
    assert names["whole"] == ["out-0-0.txt", "out-1-0.txt"]
    assert len(names["bytes"]) >= 2 and len(names["seconds"]) >= 2
    assert S.Roll(rows=3).room(1) == 2 and S.Roll(seconds=5).due(0, 0, 5.0) and not S.Roll().due(9, 9, 9.0)
    with pytest.raises(ValueError):
        S.PartWriter({"path": "x", "guarantee": "maybe"})
