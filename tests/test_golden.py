"""Small statement tests: inputs and the rows they must give."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import projection as P
from millrace.operators.iteration import connected_components


@pytest.fixture(scope="module")
def tables(spark):
    views = {
        "foo": ([(i, i) for i in range(1, 6)], "x INT, y INT"),
        "bar": ([(1, "a"), (1, "aa"), (2, "b")], "i INT, s STRING"),
        "src": ([("1", "val1"), ("2", "val2"), ("3", "val3")], "key STRING, value STRING"),
        "t_sub_query": ([(2,), (3,)], "x INT"),
    }
    for name, (rows, schema) in views.items():
        spark.createDataFrame(rows, schema).createOrReplaceTempView(name)
    yield
    for name in views:
        spark.catalog.dropTempView(name)


STATEMENTS = [
    ("SELECT s FROM foo JOIN bar ON foo.x = bar.i AND foo.y = bar.i GROUP BY s", ["a", "aa", "b"]),
    ("SELECT x, y, m FROM foo JOIN (SELECT max(i) AS m FROM bar) a ON foo.y = a.m", [(2, 2, 2)]),
    (
        "SELECT x, s FROM foo LEFT JOIN bar ON foo.y = bar.i",
        [(1, "a"), (1, "aa"), (2, "b"), (3, None), (4, None), (5, None)],
    ),
    ("SELECT x FROM foo LEFT SEMI JOIN bar ON foo.y = bar.i", [1, 2]),
    ("SELECT count(y) FROM foo GROUP BY x", [1, 1, 1, 1, 1]),
    ("SELECT max(c) FROM (SELECT x, count(y) AS c FROM foo GROUP BY x)", [1]),
    ("SELECT x, sum(y) AS s FROM foo GROUP BY x HAVING min(y) > 1", [(2, 2), (3, 3), (4, 4), (5, 5)]),
    ("SELECT sum(x) AS s1 FROM foo GROUP BY y HAVING s1 > 2 AND avg(x) < 4", [3]),
    ("SELECT x, null AS n FROM foo GROUP BY x, 'a', null", [(i, None) for i in range(1, 6)]),
    ("SELECT sum(x) FROM foo", [15]),
    ("SELECT i, to_json(array_sort(collect_list(array(s)))) FROM bar GROUP BY i", [(1, '[["a"],["aa"]]'), (2, '[["b"]]')]),
    ("SELECT i FROM bar WHERE i IN (SELECT x FROM t_sub_query)", [2]),
    ("SELECT i, count(s) FROM bar GROUP BY i HAVING i NOT IN (SELECT x FROM t_sub_query)", [(1, 2)]),
    ("SELECT x FROM foo WHERE x IN (SELECT count(*) FROM foo pp WHERE pp.x = foo.x)", [1]),
    ("SELECT (SELECT count(x) FROM foo WHERE foo.y = bar.i) FROM bar", [1, 1, 1]),
    ("SELECT count(x) FROM foo UNION ALL SELECT i FROM bar", [1, 1, 2, 5]),
    ("SELECT x FROM foo UNION SELECT i FROM bar", [1, 2, 3, 4, 5]),
    ("SELECT i FROM bar EXCEPT SELECT x FROM foo", []),
    ("SELECT x FROM foo INTERSECT SELECT i FROM bar", [1, 2]),
    ("SELECT bround(55.0, -1)", [Decimal("60")]),
    ("SELECT round(123.45, -2)", [Decimal("100")]),
    ("SELECT sha2('ABC', CAST(NULL AS INT))", [None]),
    ("SELECT if(i > 1, s, null) FROM bar", ["b", None, None]),
    ("SELECT CASE WHEN i > 1 THEN '100' ELSE split(s, ',')[0] END FROM bar", ["100", "a", "aa"]),
    ("SELECT x FROM foo ORDER BY x DESC LIMIT 1", [5]),
    ("SELECT x FROM foo ORDER BY x LIMIT 2 OFFSET 1", [2, 3]),
    ("SELECT 12 * 10 + 11 = extract(YEAR FROM CAST('10-11' AS INTERVAL YEAR TO MONTH)) * 12 + 11", [True]),
    ("SELECT CAST('2 1:2:3' AS INTERVAL DAY TO SECOND) > INTERVAL '1 1:2:3' DAY TO SECOND", [True]),
]


@pytest.mark.parametrize("sql,rows", STATEMENTS, ids=[s[0][:60] for s in STATEMENTS])
def test_statement(spark, tables, sql, rows):
    got = [tuple(r) if len(r) > 1 else r[0] for r in spark.sql(sql).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)


def test_median_is_exact(spark, tables):
    # An exact, interpolated median; an approximate histogram would say 2.5.
    assert spark.sql("SELECT percentile(x, 0.5) FROM foo").first()[0] == 3.0
    got = A.exact_percentiles(spark.table("foo"), [], "x", {"m": 0.5, "q": 0.1}).first()
    assert got.m == 3.0 and abs(got.q - 1.4) < 1e-12


def test_coalesce_of_mixed_types_is_text(spark):
    row = spark.range(1).select(P.coalesce_text(F.lit("abc"), F.lit(1)), P.coalesce_text(F.lit(None), F.lit(1)))
    assert tuple(row.first()) == ("abc", "1")


def test_word_count(spark):
    df = spark.createDataFrame([("Hello World how are you, my dear dear world",)], "line STRING")
    counts = P.word_rows(df, "line", "w").groupBy("w").count().collect()
    assert {r.w: r["count"] for r in counts} == {
        "hello": 1, "world": 2, "how": 1, "are": 1, "you": 1, "my": 1, "dear": 2,
    }


def test_extreme_row_keeps_the_first_of_ties(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, 5, 1), (2, 4, 2), (2, 9, 3)], "a INT, b INT, i INT")
    assert A.extreme_row(df, [], ["a", "b"], ["i"]).first().i == 0
    assert A.extreme_row(df, [], ["a"], ["i"], largest=True).first().i == 2


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101)]
    got = connected_components(spark.createDataFrame(edges, "src BIGINT, dst BIGINT"))
    assert {r.vertex: r.component for r in got.collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_reduce_folds_before_and_after_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 50 = 0, null, id % 3) AS k", "id AS v").repartition(7)
    fold = lambda pdf: pdf.groupby("k", as_index=False, dropna=False)["v"].sum()
    got = A.combine_then_reduce(df, ["k"], "k BIGINT, v BIGINT", fold)
    want = df.groupBy("k").agg(F.sum("v").alias("v"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_chained_self_joins_finish(spark):
    # Two chained self joins of one input: a diamond whose branches wait for each other.
    ids = spark.range(100_001)
    once = ids.alias("a").join(ids.alias("b"), F.col("a.id") == F.col("b.id")).select(F.col("a.id").alias("id"))
    twice = once.alias("a").join(once.alias("b"), F.col("a.id") == F.col("b.id"))
    assert twice.count() == 100_001
