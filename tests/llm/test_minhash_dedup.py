"""MinHash near-dedup against all pairs, and the properties of its sketches."""

import random
import re

import numpy as np
import pytest

from millrace.llm import minhash_dedup as M
from tests.compare import connect, differences
from tests.conftest import SMALL

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(1, 6))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def changed(text, n):
    words = text.split(" ")
    for p in RNG.sample(range(len(words)), n):
        words[p] = f"new{RNG.randrange(10**6)}"
    return " ".join(words)


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    k = min(3, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_force(rows):
    """The rows the operator should give, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    name = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if name[i] != name[j] and a and b and 100 * len(a & b) >= 85 * len(a | b):
                name = [name[j] if x == name[i] else x for x in name]
    least = {}
    for (i, _), g in zip(rows, name):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, len(s), least.get(g), i == least.get(g)) for (i, _), s, g in zip(rows, sets, name)), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("run_shingles", [500, M.RUN_SHINGLES])
def test_groups_equal_all_pairs(spark, run_shingles):
    texts = [None, "", " \t", "one", "ONE", "one two", "One  two", "two one", "a b c", "a b c d", "w " * 30000, "É é x", "é é x"]
    for _ in range(15):
        base = prose(RNG.randint(40, 260))
        texts += [base, base.upper()] + [changed(base, n) for n in (1, 1, 2, 3, 4, 5, 6) if n < len(base) // 40]
    chain = prose(200).split(" ")  # each text is near the one before only
    texts += [" ".join(chain[i * 8 : i * 8 + 150]) for i in range(6)]
    base = prose(200)
    texts += [base] + [changed(base, 4) for _ in range(40)]  # a group linked through its centre
    rows = list(enumerate(texts, -4)) + [(None, base), (900, prose(60)), (900, changed(base, 1)), (900, changed(base, 1))]
    docs = spark.createDataFrame([(i, t, "x", 0, []) for i, t in rows], "doc_id BIGINT, text STRING, node STRING, n INT, bands ARRAY<INT>")
    assert rows_of(M.minhash_groups(docs.repartition(5), run_shingles=run_shingles)) == brute_force(rows)


def test_empty_table_and_table_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id BIGINT, text STRING")
    assert rows_of(M.minhash_groups(docs)) == [(None, 0, None, True), (None, 2, None, True), (None, 2, None, True)]
    assert M.minhash_groups(docs.limit(0)).collect() == []


def test_every_coordinate_fills_and_agrees_like_the_sets():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 60, 3000):
        sketch = M.fast_sketches([np.unique(rng.integers(0, 1 << 62, size, np.uint64))])
        assert (sketch != np.iinfo(np.uint64).max).all()
    for similarity in (0.3, 0.6, 0.85):
        agreed = []
        for size in [12, 100, 1000] * 20:
            common = round(2 * size * similarity / (1 + similarity))
            pool = np.unique(rng.integers(0, 1 << 62, 2 * size, np.uint64))
            rng.shuffle(pool)
            a, b = pool[:size], np.concatenate([pool[:common], pool[size : 2 * size - common]])
            x, y = M.fast_sketches([np.sort(a), np.sort(b)])
            agreed.append((x == y).mean() - common / (2 * size - common))
        assert abs(np.mean(agreed)) < 0.02 and np.std(agreed) < 0.05


def test_search_of_a_bucket_finds_each_pair_once():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 62, 400, np.uint64)
    sets = [np.unique(np.concatenate([pool[: rng.integers(80, 110)], rng.integers(0, 1 << 62, rng.integers(0, 12), np.uint64)])) for _ in range(60)]
    got = {(i, j) for i, near in M.linked_places(sets, np.ones(60, bool), np.arange(60)) for j in near.tolist()}
    want = set()
    for i in range(60):
        for j in range(60):
            common = len(np.intersect1d(sets[i], sets[j]))
            if i != j and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                want.add((i, j))
    assert got == want and want


def test_query_against_sql(spark):
    import __spark_entry__ as driver

    name = "op13_minhash_near_dedup"
    assert differences(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None
