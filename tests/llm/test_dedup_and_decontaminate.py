"""Exact dedup, SimHash dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontaminate as D
from millrace.llm import exact_dedup as E
from millrace.llm import simhash_dedup as H
from millrace.sizing import BROADCAST_BYTES

RNG = random.Random(3)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(1, 6))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def near(text):
    words = text.split(" ")
    words[RNG.randrange(len(words))] = "changed"
    return " ".join(words)


LONG = prose(400)
BASE = [prose(RNG.randint(20, 300)) for _ in range(60)]
TEXTS = [None, "", " \t", "One", "one", "Two words", "É É É", "é é é", LONG, LONG.upper(), "w " * 60000]
TEXTS += BASE + [near(t) for t in BASE[:40] for _ in range(3)] + [BASE[0]] * 200 + [near(LONG) for _ in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 - 50, t, "x", None, 1, "f") for i, t in enumerate(TEXTS)] + [(None, BASE[5], "x", "y", 1, "f"), (1000, BASE[5], "x", "y", 1, "f"), (1000, BASE[5], "x", "y", 1, "f")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, fp STRING, digest STRING, n INT, u STRING")


def lower(text):
    return (text or "").translate(str.maketrans(E_UPPER, E_UPPER.lower()))


E_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


def test_exact_dedup(docs):
    groups = {}
    for r in docs.collect():
        groups.setdefault(lower(r.text), []).append(r.doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert by_row(E.exact_dedup(docs).collect()) == by_row(want)
    stays = E.drop_exact_copies(docs)
    assert stays.columns == docs.columns
    assert sorted(lower(r.text) for r in stays.collect()) == sorted(groups)


def test_perfect_hash_has_a_slot_for_each_key_and_refuses_others():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, bits, slot = E.build_hash(np.frombuffer(b"".join(keys), np.uint8))
    assert sorted(slot.tolist()) == list(range(5000))
    held = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 32)[np.argsort(slot)].reshape(-1)
    asked = keys[::-1] + [hashlib.sha256(b"other%d" % i).digest() for i in range(5000)]
    got = E.find_slots(np.frombuffer(b"".join(asked), np.uint8), sizes, bits, held)
    assert (got[:5000] == slot[::-1]).all() and (got[5000:] == -1).all()
    one_byte_off = keys[0][:31] + bytes([keys[0][31] ^ 1])
    assert E.find_slots(np.frombuffer(one_byte_off, np.uint8), sizes, bits, held).tolist() == [-1]


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    width = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(fps))]


def test_simhash(docs):
    rows = docs.collect()
    fps = [fingerprint(r.text) for r in rows]
    distinct = sorted(set(fps))
    root = dict(zip(distinct, components(distinct)))
    first = {}
    for r, fp in zip(rows, fps):
        if r.doc_id is not None:
            first[root[fp]] = min(first.get(root[fp], r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{fp:016x}", first.get(root[fp])) for r, fp in zip(rows, fps)]
    assert by_row(H.simhash_groups(docs).collect()) == by_row(want)
    stays = H.drop_near_copies(docs)
    assert stays.columns == docs.columns
    assert {r.doc_id for r in stays.collect()} == {*first.values(), None}


@pytest.mark.parametrize("limit", [4, 4096])
def test_index_finds_every_component(spark, limit):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for s in seeds for k in (0, 1, 2, 3, 3, 4, 5) for _ in range(3)]
    distinct = sorted({f - (1 << 64) if f >> 63 else f for f in flips})
    fps = spark.createDataFrame([(f,) for f in distinct], "fp BIGINT")
    roots = {r.u: r.v for r in H.star_roots(H.index_links(fps, limit)).collect()}
    got, want = {}, {}
    for f, c in zip(distinct, components([f % (1 << 64) for f in distinct])):
        got.setdefault(roots.get(f, f), set()).add(f)
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


ITEMS = [(1, prose(60)), (2, prose(13)), (3, "Short unusual item"), (4, ""), (5, None), (6, "solo9"), (1, prose(20)), (7, "the the the the the the the the the the the the the the the")]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id BIGINT, text STRING, doc_id STRING")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


@pytest.fixture(params=["one_pass", "by_text"])
def window_plan(request, spark):
    """Windows small enough to broadcast, and too many for it."""
    if request.param == "by_text":
        spark.conf.set(BROADCAST_BYTES, "0")
    yield request.param
    spark.conf.unset(BROADCAST_BYTES)


def test_decontamination(spark, docs, benchmark, window_plan):
    planted = [
        ITEMS[0][1].upper(), prose(30) + "; " + ITEMS[0][1].replace(" ", "--") + " " + prose(5), ITEMS[1][1], prose(3000) + " " + ITEMS[1][1],
        "a short, UNUSUAL item", "item short unusual", "solo9 " + prose(19), "solo9 " + prose(20), "the " * 40, ITEMS[6][1] + " " + ITEMS[0][1],
        " ".join(ITEMS[0][1].split(" ")[20:32]), " ".join(ITEMS[0][1].split(" ")[20:33]), ITEMS[1][1][:-1], "ÉÉ solo9É",
    ]
    table = docs.unionByName(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(planted)], "doc_id BIGINT, text STRING"), allowMissingColumns=True)
    windows = [(str(i), words(t)[k : k + 13]) for i, t in ITEMS for k in range(max(len(words(t)) - 13, 0) + 1) if words(t)]
    want = []
    for r in table.collect():
        w, hit, items = words(r.text), set(), set()
        for item, win in windows:
            for p in range(len(w) - len(win) + 1):
                if w[p] == win[0] and w[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    items.add(item)
        want.append((r.doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    got = D.benchmark_hits(table, benchmark).drop("items")
    assert by_row(got.collect()) == by_row(want)
    plan = got._jdf.queryExecution().toString()
    assert ("t_digest" in plan) == (window_plan == "by_text")
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert sum(w[2] > 0 for w in want) > 8
    gone = {w[0] for w in want if w[5]}
    stays = D.drop_contaminated(table, benchmark)
    assert stays.columns == table.columns
    assert {r.doc_id for r in stays.collect()} == {w[0] for w in want} - gone


def test_places_pass_the_bit_table_and_meet_anchors_without_words(spark, docs, benchmark, monkeypatch):
    monkeypatch.setattr(D, "FILTER_BITS", 128)  # a full table lets every place through and changes no row
    spark.conf.set(BROADCAST_BYTES, "0")
    try:
        crowded = by_row(D.benchmark_hits(docs, benchmark).collect())
    finally:
        spark.conf.unset(BROADCAST_BYTES)
    assert crowded == by_row(D.benchmark_hits(docs, benchmark).collect())
    anchors = D.rarest_shingles(D.item_windows(benchmark))
    own = {r.h for r in anchors.collect()}
    spots = anchors.select(F.col("h").alias("d_h")).distinct().unionAll(spark.range(100000).select(F.xxhash64("id").alias("d_h")))
    monkeypatch.setattr(D, "FILTER_BITS", 1 << 23)
    passed = [r.d_h for r in D._possible(spots, anchors).collect()]
    assert own <= set(passed) and len(passed) < len(own) + 20


def test_empty_tables(spark, docs, benchmark, window_plan):
    none = docs.where("false")
    for f in (E.exact_dedup, E.drop_exact_copies, H.simhash_groups, H.drop_near_copies):
        assert f(none).count() == 0
    assert D.benchmark_hits(none, benchmark).count() == 0
    got = D.benchmark_hits(docs, benchmark.where("false"))
    assert got.where("contaminated").count() == 0 and got.count() == docs.count()
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_hub_with_many_links_is_one_component(spark):
    links = spark.range(1, 50001).selectExpr("id AS u", "0L AS v").unionAll(spark.range(60000, 60050).selectExpr("id + 1 AS u", "id AS v"))
    roots = H.star_roots(links)
    assert roots.groupBy("v").count().orderBy("v").collect() == [(0, 50000), (60000, 50)]
