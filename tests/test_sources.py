"""Text ingest tables, file filters, schema declarations, row changes."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.operators import changelog as C
from millrace.operators import dml
from millrace.operators import projection as P
from millrace.scratch import cut_lineage, new_folder, shared_base
from millrace.sources import capabilities, files, generated, text_ingest as I
from millrace.sources.schema_spec import TableSpec

CASES = [
    ("tinyint", "", I.EMPTY_COLUMN),
    ("tinyint", "-", I.ORPHAN_SIGN),
    ("tinyint", "128", I.OVERFLOW_UNDERFLOW),
    ("tinyint", "-128", None),
    ("tinyint", "1x", I.ILLEGAL_CHARACTER),
    ("tinyint", "999x", I.OVERFLOW_UNDERFLOW),
    ("int", "2147483647", None),
    ("int", "2147483648", I.OVERFLOW_UNDERFLOW),
    ("int", "-2147483649", I.OVERFLOW_UNDERFLOW),
    ("int", "21474836470", I.OVERFLOW_UNDERFLOW),
    ("int", "0001", None),
    ("int", " 1", I.ILLEGAL_CHARACTER),
    ("int", "2 ", I.ILLEGAL_CHARACTER),
    ("int", "+5", I.ILLEGAL_CHARACTER),
    ("int", "1569a86", I.ILLEGAL_CHARACTER),
    ("int", "-57-6", I.ILLEGAL_CHARACTER),
    ("double", "1.5e3", None),
    ("double", " 1.5", I.ILLEGAL_CHARACTER),
    ("double", "1.5.5", I.FORMAT_ERROR),
    ("double", "", I.EMPTY_COLUMN),
    ("boolean", "TRUE", None),
    ("boolean", "0", None),
    ("boolean", "yes", I.BOOLEAN_INVALID),
    ("boolean", "", I.EMPTY_COLUMN),
    ("date", "2040-5-12", None),
    ("date", "1970-1-1", None),
    ("date", "13-08-12", I.FORMAT_ERROR),
    ("date", "2013--08-12", I.FORMAT_ERROR),
    ("date", "2013/08/12", I.FORMAT_ERROR),
    ("date", "2000-02-35", I.FORMAT_ERROR),
    ("date", " 2013-08-12", I.ILLEGAL_CHARACTER),
    ("date", "\t", I.ILLEGAL_CHARACTER),
]


def test_error_classes(spark):
    df = spark.createDataFrame([(i, text) for i, (_, text, _) in enumerate(CASES)], "i INT, x STRING")
    for dtype in {c[0] for c in CASES}:
        got = {r.i: r.e for r in df.select("i", I.error_class(F.col("x"), dtype).alias("e")).collect()}
        for i, (kind, text, error) in enumerate(CASES):
            if kind == dtype:
                assert got[i] == error, (kind, text)


def test_good_and_bad_rows(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "y"), (None, "z")], "n STRING, s STRING")
    good, bad = I.good_and_bad(I.ingest(df, {"n": "int"}), {"n": "int"})
    assert sorted((str(r.n), r.s) for r in good.collect()) == [("1", "x"), ("None", "z")]
    assert [(r.s, r.n_error) for r in bad.collect()] == [("y", I.ILLEGAL_CHARACTER)]


def test_path_filter(spark, tmp_path):
    for name in ["a.txt", ".b", "_c", "d._COPYING_", "e_COPYING_f.txt"]:
        (tmp_path / name).write_text(name)
    got = files.only_visible(spark.read.text(str(tmp_path))).collect()
    assert [r.value for r in got] == ["a.txt"]
    names = spark.createDataFrame([(n,) for n in ["a", ".a", "_a", "x_COPYING_y"]], "n STRING")
    assert [r.n for r in names.where(files.visible_file(F.col("n"))).collect()] == ["a"]


def test_csv_sink_refuses_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "hi"), (2, "hi")], "a INT, b STRING")
    files.write_delimited(df, str(tmp_path / "o"), sep="\t", files=1)
    with pytest.raises(Exception, match="already exists"):
        files.write_delimited(df, str(tmp_path / "o"))
    files.write_delimited(df.limit(1), str(tmp_path / "o"), overwrite=True)
    assert files.delimited(spark, str(tmp_path / "o"), "a INT, b STRING").count() == 1


def test_schema_spec_key_is_not_enforced(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id INT, s STRING")
    spec = TableSpec().column("twice", "id * 2").key("id")
    assert spec.apply(df).count() == 2 and spec.primary_key == ("id",)


def test_missing_connectors_say_so(spark):
    if not capabilities.available(spark, "avro"):
        with pytest.raises(capabilities.MissingConnector):
            capabilities.avro_files(spark, "/nowhere", "a INT")
    if not capabilities.available(spark, "kafka"):
        with pytest.raises(capabilities.MissingConnector):
            capabilities.log_topic(spark, "localhost:1", "t")


def test_print_sink(spark, capsys):
    spark.createDataFrame([(1, "hi")], "a INT, b STRING").show()
    assert "| hi|" in capsys.readouterr().out


def test_number_sequence_splits_evenly(spark):
    df = generated.number_sequence(spark, 5, 17, 4)
    sizes = df.groupBy(F.spark_partition_id()).count().select("count").collect()
    counts = [r[0] for r in sizes]
    assert sum(counts) == 13 and max(counts) - min(counts) <= 1


def test_to_pandas_is_bounded(spark):
    assert len(generated.to_pandas(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        generated.to_pandas(spark.range(6), 5)


def test_column_operations_are_strict(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    with pytest.raises(ValueError):
        P.add_columns(df, {"a": F.lit(1)})
    with pytest.raises(ValueError):
        P.rename_columns(df, {"z": "y"})
    got = P.add_or_replace_columns(df, {"a": F.col("b"), "d": F.col("a") + 10}).first()
    assert tuple(got) == (2, 2, 3, 11)
    with pytest.raises(ValueError):
        P.SideOutput("")
    with pytest.raises(KeyError):
        P.split_rows(df, {P.SideOutput("x"): F.lit(True)}).side(P.SideOutput("unknown"))


def test_snapshot_time_must_be_constant(spark):
    df = spark.createDataFrame([(1, 5)], "k INT, t INT")
    with pytest.raises(TypeError):
        C.snapshot_at(df, ["k"], "t", F.col("t"))
    assert C.snapshot_at(df, ["k"], "t", 4).count() == 0


def test_delete_keeps_null_predicates(spark):
    rows = [(k, f"b_{k}", 2.0 * k) for k in range(5)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE")
    kept, n = dml.delete_where(df, F.col("c") > 4.0, new_folder(spark, "t"))
    assert n == 2 and sorted(r.a for r in kept.collect()) == [0, 1, 2, 9]


def test_insert_if_not_exists_and_partial_columns(spark):
    db = dml.work_database(spark)
    spark.sql(f"CREATE TABLE {db}.d (x INT, p STRING, q STRING) USING parquet PARTITIONED BY (p, q)")
    spark.sql(f"INSERT INTO {db}.d PARTITION (p = '1', q = 'a') VALUES (1)")
    spark.sql(f"INSERT OVERWRITE TABLE {db}.d PARTITION (p = '1', q = 'a') IF NOT EXISTS VALUES (7)")
    assert [r.x for r in spark.table(f"{db}.d").collect()] == [1]
    spark.sql(f"INSERT INTO {db}.d (q, p) VALUES ('z', '2')")
    assert spark.table(f"{db}.d").where("p = '2'").first().x is None


class _Session:
    """Just the two settings the scratch folder is chosen by."""

    def __init__(self, master, base):
        self.conf = {"spark.checkpoint.dir": base} if base else {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_folder_comes_from_the_session():
    assert shared_base(_Session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_base(_Session("yarn", None))


def test_cut_lineage_is_a_checkpoint(spark):
    df = cut_lineage(spark.range(10).where("id > 3"))
    assert df.count() == 6
    assert "Filter" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_json_null_fields_are_written(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert df.select(S.json_row(F.struct("a", "b"))).first()[0] == '{"a":1,"b":null}'
    got = df.select(S.multiset(F.array(F.lit("x"), F.lit("y"), F.lit("x"))).alias("m")).first().m
    assert got == {"x": 2, "y": 1}


def test_function_lookup_prefers_session_functions(spark):
    spark.udf.register("millrace_probe", lambda x: "session", "string")
    assert spark.sql("SELECT millrace_probe(1)").first()[0] == "session"
    assert spark.sql("SHOW USER FUNCTIONS LIKE 'millrace_probe'").count() == 1
