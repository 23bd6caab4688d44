"""Collocations against counting every phrase, and against SQL."""

import random
import re
from collections import Counter

import pytest

from millrace.llm import collocations as C
from tests.compare import connect, differences
from tests.conftest import SMALL

RNG = random.Random(21)


def brute_counts(rows):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f, total


def brute_force(rows, least=30, top=2000):
    f, total = brute_counts(rows)
    often = {p: n for p, n in f.items() if n >= least}
    around = Counter()
    for (lang, p), n in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                around[lang, p[i : i + k]] = max(around[lang, p[i : i + k]], n)
    out = []
    for lang in total:
        kept = []
        for (x, p), a in often.items():
            if x == lang and len(p) > 1 and 100 * around[lang, p] < 80 * a:
                cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    words = ["".join(RNG.choices("abcdé", k=RNG.randint(1, 3))) for _ in range(9)]
    fixed = ["new york city hall", "new york", "ad hoc", "a A a A a", "x\ty\tz", "É-1 n'est pas", "over the moon and far"]
    out = []
    for i in range(700):
        parts = [RNG.choice(fixed) if RNG.random() < 0.25 else RNG.choice(words) for _ in range(RNG.randint(0, 60))]
        text = "".join(p + RNG.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\x0b", "\t"]) for p in parts)
        out.append((RNG.choice(["en", "en", "fr", None]), text))
    return out + [("en", None), ("xx", ""), ("en", "so it goes " * 5000), ("de", "the \x00 end " * 40)]


def test_phrases_equal_full_counting(spark, rows):
    docs = spark.createDataFrame([(i, l, t, 1, "p") for i, (l, t) in enumerate(rows)], "doc_id BIGINT, lang STRING, text STRING, n INT, phrase STRING")
    want = brute_force(rows)
    assert len(want) > 60 and {r[0] for r in want} == {"en", "fr", "und", "de"}
    assert rows_of(C.collocations(docs.repartition(6))) == want
    assert rows_of(C.collocations(docs, least=40, top=7)) == brute_force(rows, 40, 7)
    assert C.collocations(docs.limit(0)).collect() == []


def test_border_failures_are_closed(spark, rows):
    """Whatever is proposed, all frequent phrases come out with their counts, each once."""
    texts = spark.createDataFrame([(l or "und", t or "") for l, t in rows], "lang STRING, text STRING")
    want = {(l, " ".join(p), n) for (l, p), n in brute_counts(rows)[0].items() if n >= 30}
    half = C.no_phrases() | C.np.uint64(0x5555555555555555)  # holds about a quarter of everything
    for proposed in (C.no_phrases(), half, ~C.no_phrases(), C.mined_sample(texts.limit(50), 3)):
        got = [(r.lang, r.phrase, r.n) for r in C.closed_counts(texts, proposed, 30).where("k > 0").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_blocks_of_any_size_count_alike(rows):
    none, full, sums = C.no_phrases(), ~C.no_phrases(), []
    for size, before, frequent in ((1, full, full), (40, full, full), (len(rows), full, full), (40, none, none)):
        f = Counter()
        for at in range(0, len(rows), size):
            block = C._Block()
            for lang, text in rows[at : at + size]:
                block.add(lang or "und", text or "")
            for b in C._phrase_rows(block, full, before, frequent):
                for r in b.to_pylist():
                    f[r["lang"], r["phrase"], r["k"]] += r["n"]
        sums.append(f)
    brute, total = brute_counts(rows)
    assert {k[0]: n for k, n in sums[0].items() if not k[2]} == {l: n for l, n in total.items() if n}
    want = {(l, " ".join(p), len(p)): n for (l, p), n in brute.items()}
    for f in sums[:3]:
        assert {k: n for k, n in f.items() if k[2]} == want
    assert {k: n for k, n in sums[3].items() if k[2]} == {k: n for k, n in want.items() if k[2] > 1}


def test_fingerprints_never_count_too_low(rows):
    block, prints, words = C._Block(), Counter(), Counter()
    for lang, text in rows:
        block.add(lang or "und", text or "")
    for b in C._print_rows(block, ~C.no_phrases()):
        for r in b.to_pylist():
            prints[r["h"]] += r["n"]
    for (lang, p), n in brute_counts(rows)[0].items():
        hashes = [C.np.array([C.word_hash(lang, w.encode())], C.np.uint64) for w in p]
        h = hashes[0]
        for w in hashes[1:]:
            h = C.longer_hash(h, w)
        words[int(h.view(C.np.int64)[0])] += n
    assert prints == words


def test_query_against_sql(spark):
    import __spark_entry__ as driver

    name = "op12_phrase_collocations"
    assert differences(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None
