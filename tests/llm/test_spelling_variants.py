"""Spelling variants against a comparison of all words."""

import random
import re
import zlib

import pytest

from millrace.llm import spelling_variants as V
from tests.conftest import SMALL

RNG = random.Random(9)


def brute_counts(rows):
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """True if one insertion, deletion or replacement leads from a to b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    counts = brute_counts(rows)
    near = {w: [] for w in counts}
    # Words one edit apart agree in their first or their second half, shifted by at most one.
    blocks = {}
    for w in counts:
        for part in {("a", w[:3]), ("z", w[-3:])}:
            blocks.setdefault(part, []).append(w)
    for members in blocks.values():
        for i, a in enumerate(members):
            for b in members[:i]:
                if abs(len(a) - len(b)) < 2 and b not in near[a] and apart(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def variants(word):
    letters = "abcdeéÿ×"
    yield word
    for i in range(0, len(word), 2):
        yield word[:i] + word[i + 1 :]
        yield word[:i] + RNG.choice(letters) + word[i + 1 :]
        yield word[:i] + RNG.choice(letters) + word[i:]


def test_groups_equal_all_pairs(spark):
    rows, words = [], []
    for base in ["aaaaaaaa", "committee", "bookkeeper", "abababab", "Größenordnung", "aaaaaaab", "naïvetés"]:
        for k, w in enumerate(variants(base)):
            words += [w] * RNG.choice([1, 2, 3, 30 if k % 4 else 300])
    words += ["aaaaaaaaa"] * 4000 + ["aaaaaaaaaa"] * 40000  # a chain of forms
    RNG.shuffle(words)
    rows = [(i, " ".join(words[i * 200 : i * 200 + 200])) for i in range(len(words) // 200 + 1)]
    rows += [(None, "committee, committee"), (5, None), (6, ""), (7, "x" * 30000 + "1" + "y" * 30000), (7, "x" * 30000), (8, "\x00$committeeĀcommittee")]
    docs = spark.createDataFrame([(i, t, "w", 1, "k") for i, t in rows], "doc_id BIGINT, text STRING, word STRING, n INT, key STRING")
    got = rows_of(V.spelling_variants(docs.repartition(4)))
    assert got == brute_force(rows)
    assert any(r[2] != r[1] for r in got if r[1]), "no chain of forms"
    assert V.spelling_variants(docs.limit(0)).collect() == []


def test_whole_table(spark):
    import __spark_entry__ as driver

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(driver.queries()["op11_spelling_variants"](spark, SMALL))
    assert got == brute_force([tuple(r) for r in docs]) and any(r[4] for r in got)


@pytest.mark.parametrize("word", ["abc", "aab", "éa"])
def test_rotations_turn_back(word):
    rows = list(V.rotation_rows(word))
    assert {V.unturned(k, c) for k, c, _ in rows} == {word}
    assert len(rows) == 2 * len(word) + 1
