"""Spelling variants of words through permuterm rotations.

A word is marked with a terminator and all its rotations are taken.  Rotated to start
just behind position i, the marked word ends in the character at i: words that differ
there only (a replacement) have the same rotation but for the last character.  A word
that lacks that character (an indel) has the rest as a whole rotation of its own.  So a
range of rotations with one prefix holds, side by side, the word of one character less
(the prefix itself) and all words that replace one another in the skipped place.

Each rotation is written twice: under itself and under its prefix.  The rows are dealt
by that key, sorted by (key, count falling, character), and scanned: a group has at most
one whole rotation and one row for each letter of the alphabet, so it is bounded however
often words occur.  A group sends each member the number of its neighbours and the most
frequent one, never pairs.  A character repeated in a row is left out in its first place
only for indels, so every near pair is met exactly once.

Word counts are summed per worker before the shuffle.  Forms (a near word at least
``RATIO`` times as frequent) are followed to their roots by pointer doubling: counts grow
tenfold with each step, so chains are short.

Defined results: null text has no words; a null doc_id is written as nothing before the
colon of the checksum's text; repeated rows count as often as they come; words of equal
count are settled by code-point order; an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep_table, whole_text

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
END = "\x00"  # below every letter, in no word
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DAMAGED = 31  # of so many crc32 values one loses a character
HELD_WORDS = 1 << 18  # words a worker counts before it sends them on
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# --- words and their counts ---------------------------------------------------
def text_words(name: str, text: str) -> dict[str, int]:
    """The words of one text with their counts; ``name`` is the doc_id."""
    runs: dict[str, int] = {}
    for run in LETTERS.findall(text.translate(_UPPER)):
        if len(run) >= LEAST_LENGTH:
            runs[run] = runs.get(run, 0) + 1
    start, out = crc32(f"{name}:".encode()), {}
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] = out.get(run, 0) + n
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def sent() -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for b in batches:
        for name, text in zip(b.column("name"), b.column("text")):
            for word, n in text_words(name.as_py(), text.as_py()).items():
                held[word] = held.get(word, 0) + n
            if len(held) > HELD_WORDS:
                yield sent()
                held.clear()
    yield sent()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words that occur at least ``LEAST_COUNT`` times."""
    rows = docs.select(
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("name"), whole_text(docs, text_col).alias("text")
    )
    counted = rows.mapInArrow(_count_batches, "word STRING, n BIGINT")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- rotations ----------------------------------------------------------------
def rotation_rows(word: str) -> Iterator[tuple[str, str, bool]]:
    """(key, skipped character, first of its run) for each rotation, whole ones with no character."""
    marked = word + END
    for i in range(len(marked)):
        turned = marked[i:] + marked[:i]
        yield turned, "", False
        if i:  # the character before place i is the last one
            yield turned[:-1], turned[-1], i == 1 or word[i - 2] != word[i - 1]


def _rotation_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            part = b.slice(at, 2048)
            words = part.column("word").to_pylist()
            rows = [list(rotation_rows(w)) for w in words]
            n = np.repeat(part.column("n").to_numpy(), [len(r) for r in rows])
            keys, skipped, firsts = zip(*(x for r in rows for x in r))
            columns = [pa.array(keys), pa.array(skipped), pa.array(firsts), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "skipped", "first_of_run", "n"])


def unturned(key: str, skipped: str) -> str:
    """The word of a rotation."""
    turned = key + skipped
    at = turned.index(END)
    return turned[at + 1 :] + turned[:at]


def _group_neighbours(key: str, members: list[tuple[str, bool, int]], out: list[tuple]) -> None:
    """Neighbours inside one group; members come most frequent first, then by character."""
    letters = [m for m in members if m[0]]
    whole = [m for m in members if not m[0]]
    word_of = [unturned(key, c) for c, _, _ in letters]
    if len(letters) > 1:
        for j, (_, _, n) in enumerate(letters):
            best = 1 if j == 0 else 0
            out.append((word_of[j], n, len(letters) - 1, letters[best][2], word_of[best]))
    if whole:
        shorter, its_n = unturned(key, ""), whole[0][2]
        grown = [(w, m[2]) for w, m in zip(word_of, letters) if m[1]]
        if grown:
            top = max(n for _, n in grown)
            out.append((shorter, its_n, len(grown), top, min(w for w, n in grown if n == top)))
        out.extend((w, n, 1, its_n, shorter) for w, n in grown)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of two or more rows of one key; the last group of a batch waits for the next."""
    names = ["word", "n", "near", "near_n", "near_word"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def work(rows: pa.Table, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        out: list[tuple] = []
        many = np.flatnonzero(ends - begins > 1)
        taken = np.concatenate([np.arange(a, b) for a, b in zip(begins[many], ends[many])] or [np.zeros(0, np.int64)])
        few = rows.take(pa.array(taken))
        keys = few.column("key").to_pylist()
        members = list(zip(few.column("skipped").to_pylist(), few.column("first_of_run").to_pylist(), few.column("n").to_pylist()))
        at = 0
        for size in (ends - begins)[many].tolist():
            _group_neighbours(keys[at], members[at : at + size], out)
            at += size
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names)

    wait: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b])
        if wait is not None:
            rows = pa.concat_tables([wait, rows]).combine_chunks()
        key = rows.column("key").combine_chunks()
        cuts = np.flatnonzero(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)) + 1
        begins = np.concatenate([[0], cuts])
        wait = rows.slice(int(begins[-1]))
        if len(cuts):
            yield work(rows, begins[:-1], cuts)
    if wait is not None:
        yield work(wait, np.array([0]), np.array([wait.num_rows]))


def near_words(counts: DataFrame) -> DataFrame:
    """Per (word, group): the number of near words in it and the most frequent of them."""
    turned = counts.mapInArrow(_rotation_batches, "key STRING, skipped STRING, first_of_run BOOLEAN, n BIGINT")
    dealt = turned.repartition("key").sortWithinPartitions("key", F.col("n").desc(), "skipped")
    return dealt.mapInArrow(_scan_batches, "word STRING, n BIGINT, near BIGINT, near_n BIGINT, near_word STRING")


# --- forms and roots ----------------------------------------------------------
def root_words(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form); counts grow along a chain, so it ends."""
    ways = keep_table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = keep_table(ways.join(step, "root", "left").select("word", "root", "further"), "spelling-roots")
        moved = longer.where(F.col("further").isNotNull()).count()
        ways = longer.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            return ways


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    counts = keep_table(word_counts(docs, id_col, text_col), "spelling-words")
    alone = counts.withColumns({"near": F.lit(0).cast("bigint"), "near_n": F.lit(None).cast("bigint"), "near_word": F.lit(None).cast("string")})
    found = near_words(counts).unionByName(alone)
    best = F.struct((-F.col("near_n")).alias("falling"), F.col("near_word").alias("word"))
    words = found.groupBy("word").agg(
        F.first("n").alias("n"),
        F.sum("near").alias("n_near"),
        F.min(F.when(F.col("near_n") >= RATIO * F.col("n"), best)).alias("best"),
    )
    words = keep_table(
        words.select("word", F.col("best.word").alias("form"), "n", "n_near", (-F.col("best.falling")).alias("form_n")),
        "spelling-forms",
    )
    roots = root_words(words.where(F.col("form").isNotNull()))
    named = words.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
