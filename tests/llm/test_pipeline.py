"""The pipeline against the operators' brute force, and the registered queries' contract."""

import re

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline as P
from tests.compare import connect, differences
from tests.conftest import SMALL
from tests.llm import test_dedup_and_decontaminate as brute
from tests.llm import test_shingle_dedup as near


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toPandas())
        out.append(docs.collect())
    return out


def test_stages_follow_brute_force(steps, spark):
    documents, kept, unique, apart, clean, packed = steps
    assert 0 < len(kept) < len(documents)
    last = {}
    for r in kept:
        last[brute.lower(r.text)] = max(r.doc_id, last.get(brute.lower(r.text), r.doc_id))
    assert {r.doc_id for r in unique} == set(last.values()) and len(unique) == len(last)
    assert sorted(((r.doc_id, r.text) for r in apart), key=repr) == near.survivors([(r.doc_id, r.text) for r in unique])
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = brute.words(r.text)
        windows |= {tuple(w[k : k + 13]) for k in range(max(len(w) - 13, 0) + 1) if w}
    sizes = {len(w) for w in windows}
    want = set()
    for r in apart:
        w, hit = brute.words(r.text), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
        if not hit or 20 * len(hit) < len(w):
            want.add(r.doc_id)
    assert {r.doc_id for r in clean} == want
    assert {r.doc_id for r in packed} == want


def test_run_is_the_stages(steps, spark):
    rows = P.run(spark, SMALL)
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in steps[-1])
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_registered_queries():
    names = driver.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", name)) for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op10_benchmark_decontamination"])
def test_queries_against_sql(name, spark):
    con: duckdb.DuckDBPyConnection = connect(SMALL)
    assert differences(driver.queries()[name](spark, SMALL), con, driver.oracle_sql()[name]) is None
