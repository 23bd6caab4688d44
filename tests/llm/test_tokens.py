"""Piece-wise encoding, token counts, token files and packing against the library itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.packing import best_fit_runs, pack_documents, packed_sequences
from millrace.llm.token_counts import token_counts
from millrace.llm.token_files import (
    decode_ranks,
    encode_ranks,
    pack_block,
    read_token_files,
    unpack_block,
    write_token_files,
)
from millrace.llm.tokens import IdTable, LengthTable, library

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE_LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)

TEXTS = [
    None,
    "",
    " ",
    "the THE The, the. don't  two  spaces\n\nand lines \t tab",
    "Übergröße – Köln nbsp é composed",
    "a<|endoftext|>b  <|endoftext|> c<|startoftext|>",
    "x" * 300 + " " + "word " * 6000,
    "日本語 text mixed 123,456.78 \x1c odd   space",
]
PIECES = st.sampled_from([*"aA é.,'s\n\t<|>12", "  ", "the", "<|endoftext|>", " ", "́", "\x1c", "漢", "'re"])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", f"s{i}", 0, "other") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None, None, None), (None, "no id", "x", "y", 1, "z")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, ids STRING")


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join) | st.text(max_size=40))
def test_pieces_are_encoded_as_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    assert LengthTable(library(BYTE), {}).count(text) == len(BYTE_LIBRARY.encode(text, add_special_tokens=False).ids)
    packed = IdTable(library(WORD)).encode(text)
    assert np.frombuffer(packed, "<u2").tolist() == WORD_LIBRARY.encode(text, add_special_tokens=False).ids


def test_token_counts(docs):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, BYTE, 1024).collect())
    want = []
    for r in docs.collect():
        text = r.text or ""
        n = len(BYTE_LIBRARY.encode(text, add_special_tokens=False).ids)
        want.append((r.doc_id is None, r.doc_id, len(text.encode()), n, n > 1024))
    assert got == sorted(want)


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=200))
def test_rank_coding_round_trip(numbers):
    control, data = encode_ranks(np.array(numbers, np.uint32))
    got = decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(numbers))
    assert got.tolist() == numbers


def test_block_round_trip():
    ids, lengths, ranks = unpack_block(pack_block([None, -5, 7], [0, 2, 1], np.array([1, 70000, 3])))
    assert (ids, lengths.tolist(), ranks.tolist()) == ([None, -5, 7], [0, 2, 1], [1, 70000, 3])


def word_ids(text, end):
    return [*WORD_LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(docs):
    got = read_token_files(write_token_files(docs, WORD, 2)).collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(word_ids(r.text, 2)), crc(word_ids(r.text, 2))) for r in docs.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order[:-1]]]).tolist()
    known = [r.doc_id for r in in_order if r.doc_id is not None]
    assert known == sorted(known)


def test_empty_table(docs):
    none = docs.where("false")
    assert token_counts(none, BYTE, 10).count() == 0
    assert read_token_files(write_token_files(none, WORD, 2)).count() == 0
    assert pack_documents(none, WORD, 1, 64).count() == 0


@given(st.lists(st.integers(1, 40), max_size=80))
def test_runs_equal_sequential_best_fit_decreasing(lengths):
    capacity, gaps = 40, []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        best = min(fits, default=None)
        if best is not None:
            gaps.remove(best)
        gaps.append((best if best is not None else capacity) - n)
    counts = {n: lengths.count(n) for n in lengths}
    runs = best_fit_runs(counts, capacity)
    assert runs.sequences == len(gaps)
    filled = {}
    for n, c in counts.items():
        seq, off = runs.place(np.full(c, n), np.arange(c))
        for s, o in zip(seq.tolist(), off.tolist()):
            filled.setdefault(s, []).append((o, n))
    for parts in filled.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts))
        assert sum(n for _, n in parts) <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == sorted(gaps)


def test_packing(docs):
    capacity = 64
    rows = pack_documents(docs, WORD, 1, capacity).collect()
    want = []
    for r in docs.collect():
        ids = word_ids(r.text, 1)
        want += [(-1 if r.doc_id is None else r.doc_id, k, s, len(ids[s : s + capacity]), crc(ids[s : s + capacity])) for k, s in enumerate(range(0, len(ids), capacity))]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= capacity
    texts = packed_sequences(docs, WORD, 1, capacity).collect()
    assert sum(r.n_tokens for r in texts) == sum(n for *_, n, _ in want)
    assert all(len(r.ids) == 4 * r.n_tokens for r in texts)


def test_small_cache_gives_the_same_ids():
    """A full table turns into the older generation; the two never hold more than the bound."""
    texts = [" ".join(f"Word{(i * k) % 97}, thing{i}" for i in range(40)) for k in range(30)]
    small, large = IdTable(library(WORD), 64), IdTable(library(WORD))
    for t in texts:
        assert small.encode(t) == large.encode(t) and len(small) + len(small.older) <= 64
        assert np.frombuffer(small.encode(t), library(WORD).dtype).tolist() == WORD_LIBRARY.encode(t, add_special_tokens=False).ids
    assert small.older
