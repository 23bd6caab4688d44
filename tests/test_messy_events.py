"""Events without a time, user, type or value, and with negative users, against the same SQL."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from millrace.operators import joins as J
from millrace.plans import REGISTRY
from millrace.sizing import ONE_TASK_BYTES
from millrace.streaming.runner import watch_watermarks
from millrace.tables import SCHEMAS
from tests.compare import differences
from tests.conftest import SMALL

# Streams and batch queries that keep every row, whatever it lacks.
KEEP_ALL = [
    "snk_12_exactly_once",
    "snk_13_upsert_stream",
    "snk_02_rolling_files",
    "src_15_log_csv_decode",
    "src_15_log_payload_decode",
    "src_16_hybrid_source",
    "jon_25_lookup_enrichment",
    "jon_25_lookup_enrichment_stream",
    "jon_28_regular_stream_join",
    "prj_20_side_outputs_stream",
    "fun_15_json_value_stream",
    "agg_17_select_distinct_stream",
    "win_01_dedup_keep_first_stream",
    "agg_28_running_keyed_sum_stream",
    "str_07_processing_time_window",
    "str_11_keyed_state_kinds",
    "str_12_state_ttl",
    "str_13_timers",
    "str_14_process_function",
    "str_28_buffering_sink",
    "udf_13_open_process_close",
    "str_08_event_time_trigger",
    "str_08_continuous_trigger",
    "str_08_purging_trigger",
    "str_08_never_trigger",
    "str_14_window_process_function",
    "str_14_all_window_process_function",
    "str_14_unkeyed_process_function",
    "str_22_followed_by_stream",
    "str_22_followed_by_comparator",
    "str_23_max_per_delta_window",
    "str_23_max_per_delta_window_stream",
    "str_26_delta_evictor",
    "snk_12_commit_log_before_loss",
    "snk_12_commit_log_after_loss",
    "snk_12_at_least_once",
    "snk_12_no_guarantee",
    "snk_02_named_rolling_parts",
]


# Streams that take rows without an id too; times settle their order.
NO_IDS = [
    "str_11_keyed_state_kinds",
    "str_13_timers",
    "str_14_process_function",
    "str_22_strict_pattern_stream",
    "str_28_buffering_sink",
]
# Their SQL takes a window's first or best row among those with an id; the stream reports it without one.
NO_ID_COUNTS = ["win_10_count_window_tumbling_stream", "str_23_max_per_delta_window_stream"]


def _messy(spark, folder, without_ids):
    rng, start, rows = random.Random(11), datetime(2024, 1, 1), []
    for i in range(400):
        rows.append(
            (
                None if without_ids and i % 7 == 2 and i % 40 != 7 else i,
                None if i % 40 == 7 else start + timedelta(minutes=37 * i + rng.randrange(30)),
                None if i % 31 == 3 else rng.choice([-5, -1, 1, 2, 3]),
                None if i % 29 == 5 else rng.choice(["click", "view", "purchase", "error"]),
                None if i % 23 == 11 else round(rng.uniform(0, 200), 2),
                '{"k": %d}' % i,
            )
        )
    spark.createDataFrame(rows, SCHEMAS["events"]).coalesce(1).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    spark.read.parquet(f"{SMALL}/customer.parquet").write.parquet(f"{folder}/customer.parquet")
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{SMALL}/customer.parquet'")
    return str(folder), con


@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    return _messy(spark, tmp_path_factory.mktemp("messy"), False)


@pytest.fixture(scope="module")
def messy_without_ids(spark, tmp_path_factory):
    return _messy(spark, tmp_path_factory.mktemp("no-ids"), True)


@pytest.mark.parametrize("name", NO_IDS)
def test_missing_ids_stop_no_stream(spark, messy_without_ids, name):
    folder, con = messy_without_ids
    assert differences(REGISTRY[name](spark, folder), con, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", KEEP_ALL)
def test_every_row_arrives(spark, messy, name):
    folder, con = messy
    assert differences(REGISTRY[name](spark, folder), con, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", NO_ID_COUNTS)
def test_windows_of_rows_without_ids(spark, messy_without_ids, name):
    folder, con = messy_without_ids
    sums = "user_id, window_no, " + ("cents" if name.startswith("win") else "n, top_cents")
    sql = f"SELECT {sums} FROM ({REGISTRY[name].sql})"
    assert differences(REGISTRY[name](spark, folder).selectExpr(sums.split(", ")), con, sql) is None


def test_tied_as_of_rows_have_one_answer(spark):
    left = spark.createDataFrame([(1, 10, 5)], "k INT, t INT, id INT")
    right = [(1, 10, "a", i) for i in range(20)] + [(1, 9, "b", 99)]
    answers = set()
    before = spark.conf.get(ONE_TASK_BYTES, None)
    for limit in ("1", str((1 << 63) - 1)):
        spark.conf.set(ONE_TASK_BYTES, limit)
        for n in (1, 3, 7):
            table = spark.createDataFrame(right, "k INT, rt INT, what STRING, rid INT").repartition(n)
            rows = J.latest_before(left, table, ["k"], "t", "rt", ["rid", "what"], "id").collect()
            answers.add(tuple(map(tuple, rows)))
    spark.conf.unset(ONE_TASK_BYTES) if before is None else spark.conf.set(ONE_TASK_BYTES, before)
    assert answers == {((1, 10, 5, 19, "a"),)}


def test_all_progress_reports_are_kept(spark, tmp_path):
    kept = "spark.sql.streaming.numRecentProgressUpdates"  # what a query itself keeps
    for i in range(8):
        spark.range(i, i + 1).selectExpr("id", "timestamp_seconds(id * 60) AS ts").coalesce(1).write.mode(
            "append"
        ).parquet(f"{tmp_path}/in")
    stream = (
        spark.readStream.schema("id BIGINT, ts TIMESTAMP").option("maxFilesPerTrigger", 1)
        .parquet(f"{tmp_path}/in").withWatermark("ts", "1 minute")
    )
    spark.conf.set(kept, "3")
    try:
        reports = watch_watermarks(stream, "many-batches")
    finally:
        spark.conf.unset(kept)
    assert reports.select("batch_id").distinct().count() >= 8


def test_delimited_files_keep_missing_values(spark, tmp_path):
    from pyspark.sql import functions as F

    from millrace.sources import files

    rows = [(1, None, 2), (2, "a|b", None), (3, 'q"x', 4)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c INT")
    df.select(F.to_csv(F.struct("*"), {"sep": "|"}).alias("value")).write.text(f"{tmp_path}/t")
    back = files.delimited(spark, f"{tmp_path}/t", "a INT, b STRING, c INT", sep="|")
    assert sorted(map(tuple, back.collect())) == rows
