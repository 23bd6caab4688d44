"""Quality classifier and language model: arithmetic, held-out accuracy, brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lm_scoring as L
from millrace.llm import quality as Q
from millrace.tables import Tables
from tests.conftest import SMALL

SF = SMALL.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def test_quality_held_out_accuracy(tables):
    labels = {r.doc_id: r.quality for r in tables.labels.collect()}
    rows = Q.quality_scores(tables.documents, tables.labels).collect()
    assert len(rows) == tables.documents.count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    good = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_discriminant_equals_normal_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(200, Q.WIDTH)), rng.normal(1, 2, size=(300, Q.WIDTH))]
    n = np.array([len(a) for a in x], float)
    model = Q.fit_sums(n, np.array([a.sum(axis=0) for a in x]), np.array([a.T @ a for a in x]))
    pooled = sum((len(a) - 1) * np.cov(a.T) for a in x) / (n.sum() - 2)
    logs = []
    for a in x:
        c = (1 - Q.SHRINK_TO_POOLED) * np.cov(a.T) + Q.SHRINK_TO_POOLED * pooled
        c = (1 - Q.SHRINK_TO_DIAGONAL) * c + Q.SHRINK_TO_DIAGONAL * np.diag(np.diag(c)) + 1e-6 * np.eye(Q.WIDTH)
        d = x[0][:5] - a.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1])
    odds = Q.TEMPER * (logs[1] - logs[0]) + math.log(301 / 201)
    assert np.allclose(model.score(x[0][:5]), 1 / (1 + np.exp(-odds)))


def test_quality_edge_rows(spark, tables):
    rows = [(1, None, 5), (2, "", 5), (None, "some words here", 5), (3, "w " * 100000, 5), (3, "w " * 100000, 5)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, score INT")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (77, 0)], "doc_id BIGINT, quality INT")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == 5 and len({r.score for r in got}) == 1  # one class is missing
    assert Q.quality_scores(docs.where("false"), labels).count() == 0
    assert len(Q.quality_scores(docs, tables.labels).collect()) == 5
    stays = Q.drop_low_quality(docs, tables.labels)
    assert stays.columns == docs.columns and stays.where("doc_id IS NULL").count() == 1


TEXTS = ["the cat sat on the mat", "The cat sat", "a dog sat on the mat", None, "", "x " * 3000, "new words only", "the cat sat on the mat"] * 6


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(None, "the cat", "z"), (3, "the the", "z"), (3, "the the", "z")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, block STRING")


def words(text):
    return [*(text or "").encode().lower().split(), L.END]


def test_language_model(docs):
    rows = docs.collect()
    held = [r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    one, two = Counter(), Counter()
    for r, h in zip(rows, held):
        if not h:
            w = words(r.text)
            one.update(w)
            two.update(zip([L.START, *w], w))
            one[L.START] += 1
    starts = one.pop(L.START)
    n, v = sum(one.values()), len(one)

    def p(u, w, share, out=0):
        smooth = (one[w] + 1 - out) / (n + v + 1)
        history = (starts if u == L.START else one[u]) - out
        return share * (two[u, w] - out) / history + (1 - share) * smooth if history else smooth

    def bin_of(u, out=0):
        history = (starts if u == L.START else one[u]) - out
        return int(np.searchsorted(L.HISTORY_BINS, history, side="right")) if history else 0

    fit = np.zeros((len(L.SHARES), len(L.HISTORY_BINS) + 1))
    for (u, w), c in two.items():
        for g, share in enumerate(L.SHARES):
            fit[g, bin_of(u, 1)] += c * math.log10(p(u, w, share, 1))
    best = L.SHARES[fit.argmax(axis=0)]
    want = []
    for r, h in zip(rows, held):
        w = words(r.text)
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(p(a, b, best[bin_of(a)])) for a, b in zip([L.START, *w], w))
        want.append((-1 if r.doc_id is None else r.doc_id, h, len(w), sum(one[x] > 0 for x in w), n, base, score))
    got = [(-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in L.lm_scores(docs).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_history_after_any_word_sums_to_one(docs):
    """Arc and failure weights of a state add up to one over vocabulary and unknown word."""
    counts, total = np.array([3, 1, 0]), 4 + 2 + 1
    for share in L.SHARES:
        arcs = share * np.array([2, 2, 0]) / 4 + (1 - share) * (counts + 1) / total
        assert arcs.sum() == pytest.approx(1)


def test_language_model_of_nothing(docs):
    assert L.lm_scores(docs.where("false")).count() == 0
    rows = L.lm_scores(docs.where("doc_id IS NULL")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(3, 0, 0)]


def test_held_out_text_is_likelier_than_by_unigrams(tables):
    rows = [r for r in L.lm_scores(tables.documents).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
