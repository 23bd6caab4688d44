"""The pipeline's near-dedup stage against brute force on five-word shingles."""

import random

import pytest

import corpus_pipeline as P
from millrace.llm import shingle_dedup as S
from tests.conftest import SMALL
from tests.llm import test_dedup_and_decontaminate as brute

RNG = random.Random(11)


def shingles(text):
    w = brute.re.findall(r"[^\x20\x09-\x0D]+", brute.lower(text))
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def groups(texts):
    """Component of each text under links of 0.8 or more, by all pairs."""
    sets = [shingles(t) for t in texts]
    name = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            near = a == b or 10 * len(a & b) >= 8 * len(a | b)
            if near and name[i] != name[j]:
                name = [name[j] if x == name[i] else x for x in name]
    return name


def survivors(rows):
    best = {}
    for (i, t), g in zip(rows, groups([t for _, t in rows])):
        best[g] = min(best.get(g, (True, 0, "")), (i is None, i or 0, brute.hashlib.sha256((t or "").encode()).hexdigest(), t), key=lambda x: (len(x) == 3, x[:3]))
    return sorted(((None if b[0] else b[1], b[3]) for b in best.values()), key=repr)


def changed(text, n):
    words = text.split(" ")
    for p in RNG.sample(range(len(words)), n):
        words[p] = f"new{RNG.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("run_shingles", [300, S.RUN_SHINGLES])
def test_near_copies_by_brute_force(spark, run_shingles):
    texts = [None, "", " \t", "one two", "One  two", "one three"]
    for _ in range(12):
        base = brute.prose(RNG.randint(60, 250))
        texts += [base, base.upper()] + [changed(base, n) for n in (1, 1, 2, 3, 4, 6, 10) if n < len(base) // 20]
    rows = list(enumerate(texts, -5))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id BIGINT, text STRING, node STRING")
    got = S.drop_similar(docs, run_shingles=run_shingles)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == survivors(rows)


def test_repeated_and_missing_ids(spark):
    first, other = brute.prose(100), brute.prose(100)
    rows = [(3, first), (5, other), (5, changed(first, 1)), (None, changed(first, 1)), (None, brute.prose(50))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert sorted(map(tuple, S.drop_similar(docs).collect()), key=repr) == sorted([rows[0], rows[1], rows[4]], key=repr)
    assert S.drop_similar(docs.limit(0)).count() == 0


def test_stage_drops_pairs_of_four_fifths(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = P.exact(spark, P.quality(spark, docs, SMALL), SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = survivors(rows)
    assert 0 < len(want) < len(rows)
    assert sorted(((r.doc_id, r.text) for r in P.near(spark, docs, SMALL).collect()), key=repr) == want


def test_work_of_loosely_similar_texts_grows_with_their_number(spark):
    """Texts that share a third of their shingles with each other join nothing; one real pair is found."""
    counts = {}
    for n in (60, 120):
        common = brute.prose(120)
        texts = [f"{common} {brute.prose(110)}" for _ in range(n)]
        texts.append(changed(texts[0], 2))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
        rows = S.sketches(docs)
        counts[n] = S.candidate_pairs(S.bucket_members(S.index_entries(rows))).count()
        got = {r.doc_id for r in S.drop_similar(docs).collect()}
        assert got == set(range(n))
    assert 0 < counts[120] <= 3 * counts[60]


def test_chain_is_one_group(spark):
    """Each text is near the next one only; the group is the whole chain, in any order of hashes."""
    words = [f"w{i}" for i in range(460)]
    texts = [" ".join(words[12 * i : 12 * i + 220]) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert len(set(groups(texts))) == 1
    for run_shingles in (500, S.RUN_SHINGLES):
        assert [r.doc_id for r in S.drop_similar(docs, run_shingles=run_shingles).collect()] == [0]


def test_fingerprint_links_are_candidates_and_are_checked(spark, monkeypatch):
    """Without bands, operator 2's links alone find close copies; equal fingerprints of other sets join nothing."""
    members = S.bucket_members
    monkeypatch.setattr(S, "bucket_members", lambda entries: members(entries).where("false"))
    long = brute.prose(1500)
    repeated = "one two three four five six " * 300
    texts = [long, f"{long} tail", f"{long} other end", f"{repeated}{brute.prose(20)}", f"{repeated}{brute.prose(20)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    entries = S.index_entries(S.sketches(docs))
    assert entries.count() == 5 and S.fingerprint_pairs(entries).count() >= 2
    assert sorted(r.doc_id for r in S.drop_similar(docs).collect()) == [0, 3, 4]
    assert S.fingerprint_pairs(entries.where("false")).count() == 0
