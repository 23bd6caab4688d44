"""The licence classifier on notices, near-notices and prose."""

import random

import pytest

from millrace.llm import licenses as L
from millrace.tables import Tables
from tests.conftest import SMALL

RNG = random.Random(2)
PROSE = [" ".join("".join(RNG.choices("etaoinshr", k=RNG.randint(2, 9))) for _ in range(30)) for _ in range(300)]


@pytest.fixture(scope="module")
def model():
    return L.train(PROSE)


def test_templates_are_told_apart(model):
    for family, texts in L.TEMPLATES.items():
        for text in texts:
            assert model.judge(text)[0] == family, text
            assert model.judge("Copyright 2020 Someone. " + text.upper())[0] == family, text


def test_prose_and_loose_words_are_no_licence(model):
    for line in [*PROSE[:50], "", "the license to software is free", "public version of the terms", "under the sea"]:
        assert model.judge(line)[0] in ("none", "unknown")
    assert sum(model.judge(line)[0] != "none" for line in PROSE) == 0


def test_an_unconfirmed_notice_is_unknown(model):
    assert model.judge("Licensed under the Frobnicator Public License, version 3.")[0] in ("unknown", "none")


def test_training_is_repeatable(model):
    assert (L.train(PROSE).weights == model.weights).all()


def test_spans_and_edge_rows(spark):
    apache, gpl = L.TEMPLATES["apache"][0], L.TEMPLATES["gpl"][0]
    wrapped = L.TEMPLATES["mit"][2]
    rows = [
        (1, f"É prose\n{apache}\nmore {PROSE[0]}\n{gpl}", 0),
        (2, None, 0),
        (3, "", 0),
        (4, "\n\n" + wrapped[:60] + "\n" + wrapped[60:], 0),
        (None, apache, 0),
        (5, apache, 0),
        (5, apache, 0),
        (6, (PROSE[1] + "\n") * 5000 + apache, 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, families INT")
    got = {r.doc_id: r for r in L.license_scan(docs).collect()}
    assert L.license_scan(docs).count() == len(rows) and L.license_scan(docs.where("false")).count() == 0
    text = rows[0][1]
    assert got[1].families == "apache,gpl" and got[1].n_paragraphs == 4
    assert got[1].spans == f"apache:8:{8 + len(apache)},gpl:{text.index(gpl)}:{len(text)}"
    assert (got[2].n_paragraphs, got[2].spans, got[3].spans) == (0, "", "")
    assert got[4].families == "mit" and got[4].n_licensed == 1
    assert got[None].families == got[5].families == got[6].families == "apache"


def test_corpus_lines(spark):
    docs = Tables(spark, SMALL).documents
    notices = [L.TEMPLATES[f][0] for f in ("apache", "mit", "gpl", "cc-by-nc")]
    for r in docs.join(L.license_scan(docs), "doc_id").collect():
        assert (r.n_licensed > 0) == any(n in r.text for n in notices)
