"""Changing rules, machine-time streams, savepoints and user metrics beyond their final results."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import metrics as M
from millrace.scratch import new_folder
from millrace.streaming import machine_time as T
from millrace.streaming import processors as K
from millrace.streaming import replay as R
from millrace.streaming import rules as U
from millrace.streaming.runner import run_append, run_in_mode
from millrace.tables import SCHEMAS

START = datetime(2024, 1, 1)


def _event(i, at, kind="click", value=1.0, user=1):
    return (i, None if at is None else START + timedelta(seconds=at), user, kind, value, "{}")


def _files(spark, folder, batches, schema):
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        df = df.withColumns({"ts": F.col("ts").cast("timestamp"), "is_end": F.lit(False)})
        df.coalesce(1).write.mode("append").parquet(folder)
    R.write_end(spark, R.Slices(folder, 1, 0, R.end_micros(0, 1_800_000_000_000_000)), folder)
    return folder


def test_rules_by_time_whatever_arrives_first(spark):
    rng = random.Random(3)
    # 90% of the rows are of one kind; rows without kind, time or value meet no rule.
    rows = [_event(i, rng.randrange(3600), "click" if i % 10 else "view", rng.randrange(2000) / 100) for i in range(600)]
    rows += [_event(1000, None), _event(1001, 5, None), _event(1002, 5, "click", None), _event(None, 100, "click", 50.0)]
    rules = [("click", 0, 500), ("click", 1000, 1500), ("click", 2000, None), ("click", 3000, 100), ("view", 1800, 0)]
    at = lambda s: START + timedelta(seconds=s)
    want = []
    for i, ts, _, kind, value, _ in rows:
        if None in (ts, kind, value):
            continue
        floors = [f for k, s, f in sorted(rules, key=lambda r: r[1]) if k == kind and at(s) <= ts]
        cents = round(value * 100)
        if floors and floors[-1] is not None and cents > floors[-1]:
            want.append((i, kind, floors[-1], cents - floors[-1]))
    changes = [(k, at(s), f) for k, s, f in rules] + [(None, at(0), 1), ("view", None, 0)]
    order = lambda r: (r[1] is not None, r[1] or START)
    rows.sort(key=order)
    plans = {
        "rules first": ([rows], [changes]),
        "rules last": ([rows[:300], rows[300:]], [[c] for c in sorted(changes, key=order)]),
    }
    for name, (events, versions) in plans.items():
        e = _files(spark, new_folder(spark, "rule-events"), events, SCHEMAS["events"])
        v = _files(spark, new_folder(spark, "rules"), versions, "kind STRING, ts TIMESTAMP_NTZ, floor_cents BIGINT")
        stream = R.real_rows(R.slice_stream(spark, e), "2 hours")
        got = run_append(U.ruled(stream, U.rule_stream(spark, v, "2 hours")), "rules-test")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr), name


def test_machine_windows_by_their_arrivals(spark):
    batches = [[_event(i, i, user=i % 3 or None, value=None if i % 5 == 0 else 1.0) for i in range(b, b + 30)] for b in (0, 30, 60)]
    stream = R.real_rows(R.slice_stream(spark, _files(spark, new_folder(spark, "machine"), batches, SCHEMAS["events"])), None)
    windows = T.MachineWindows(2000, 1000, 700)
    reports = T.run_machine_time(
        K.apply(T.summed_arrivals(stream), "user_id", windows, windows.schema, "ProcessingTime"), "machine-test", 2000
    )
    seen = [tuple(r) for r in reports.collect()]
    arrivals = [r for r in seen if r[1] == "arrival"]
    assert sum(r[4] for r in arrivals) == 90
    for user, kind, start, end, n, cents in (r for r in seen if r[1] != "arrival"):
        mine = [a for a in arrivals if a[0] == user and start <= a[2] < end]
        assert (n, cents) == (sum(a[4] for a in mine), sum(a[5] for a in mine)), kind
        assert kind != "session" or end == max(a[2] for a in mine) + 700
    assert sum(r[4] for r in seen if r[1] == "sliding") == 180
    counted = T.recounted(reports, 2000, 1000, 700)
    got = reports.where("kind != 'arrival'")
    assert got.exceptAll(counted).count() == counted.exceptAll(got).count() == 0


def test_modes(spark):
    rows = spark.range(3)
    assert run_in_mode(rows, "AUTOMATIC", "m")[1] == run_in_mode(rows, "BATCH", "m")[1] == "BATCH"
    with pytest.raises(ValueError):
        run_in_mode(rows, "STREAMING", "m")


def test_distribution_and_meter_merge_in_any_order():
    rng = np.random.default_rng(5)
    values = pd.Series(np.concatenate([rng.integers(-10**6, 10**9, 3000), [0, 1, -1, 127, 128, 2**62]])).astype("Int64")
    values.iloc[7] = None
    parts = np.array_split(np.arange(len(values)), 7)
    merged = M.Distribution()
    for p in rng.permutation(len(parts)):
        merged = merged.merge(M.Distribution.of(values.iloc[parts[p]]))
    known = sorted(int(v) for v in values.dropna())
    assert (merged.n, merged.total, merged.low, merged.high) == (len(known), sum(known), known[0], known[-1])
    assert merged.buckets == M.Distribution.of(values).buckets
    for percent in (1, 50, 95, 100):
        exact = known[-(-len(known) * percent // 100) - 1]
        found = merged.quantile(percent)
        assert found == M.bucket(np.array([exact]))[0] and abs(exact - found) <= abs(exact) / 64
    assert M.Distribution().quantile(50) is None and M.Distribution.of(pd.Series([None], dtype="Int64")).n == 0
    seconds = pd.Series([5, 5, 100, 130, 159, 160])
    assert M.Meter.of(seconds).per_minute == 3
    assert M.Meter.of(seconds[:3]).merge(M.Meter.of(seconds[3:])).per_minute == 3
    assert M.Meter().per_minute == 0
