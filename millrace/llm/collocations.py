"""Phrase collocations by Toivonen's sampling method.

A sample proposes: the phrases of up to ``LONGEST`` words that reach a lowered count in
one text of ``SAMPLE_OF``.  A pass over all texts then counts every word, every proposed
phrase and the negative border: the phrases that are not proposed although their parts of
one word less are.  Border phrases that turn out frequent join the proposed ones, and an
expansion pass counts what thereby enters the border.  It takes the newly entered phrases
for held in turn, so what they could lead to is counted in the same pass and nothing is
open after it.  The result depends on the texts alone; the sample decides how much is left
to the expansion.

The first pass counts 64-bit fingerprints, where two phrases may share one: its counts are
never too low, so what stays under the bound is done with.  The expansion pass counts the
rest again by their words, and only these exact counts are used.

The proposed phrases reach the workers as a bit table of fixed size (``TABLE_BITS``, two
probes).  A phrase it holds by chance is counted although it need not be; no phrase is
ever missed.  Workers number the words of about ``HELD_WORDS`` tokens at a time, count
positions with numpy and send each phrase once with its count; a word or phrase that is
everywhere costs one row per worker and flush.

Scores are exact: products that may pass 64 bits are decimals.

Defined results: null text is empty, null lang is ``und``; repeated rows count as often as
they come; ties go to the smaller cut, then to the phrase that is first in byte order; an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, whole_text

SEED = 42
LONGEST = 4
LEAST_COUNT = 30
SAMPLE_OF = 8  # one text of so many is in the sample
SAMPLE_LEAST = 3  # lowered from LEAST_COUNT / SAMPLE_OF
TOP = 2000
PARTS = 64  # of a language's phrases, ranked apart first
TABLE_BITS = 1 << 26
HELD_WORDS = 1 << 19
TOTAL_ROW_BYTES = 40
BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)  # all pieces end in the same mark

_WORD = np.uint64(0x9E3779B97F4A7C15)


# --- hashes and the table of proposed phrases -----------------------------------
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\x00" + word, SEED)


def longer_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase followed by a word."""
    return _mixed(phrase * _WORD + word)


def probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in the table."""
    bits = np.uint64(TABLE_BITS - 1)
    return (h & bits).astype(np.int64), ((h >> np.uint64(32)) & bits).astype(np.int64)


def is_held(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the table holds (and a few it does not)."""
    found = np.ones(len(h), bool)
    for at in probes(h):
        found &= (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


def _place_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = np.concatenate(probes(b.column("h").to_numpy().view(np.uint64)))
        mask = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(mask)], ["slot", "mask"])


def table_with(prints: DataFrame, table: np.ndarray) -> np.ndarray:
    """``table`` with the bits of ``prints`` (h); at most ``TABLE_BITS`` / 64 rows reach the driver."""
    slots = prints.select("h").mapInArrow(_place_batches, "slot BIGINT, mask BIGINT")
    rows = slots.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    grown = table.copy()
    grown[rows["slot"].to_numpy()] |= rows["mask"].to_numpy().view(np.uint64)
    return grown


def no_phrases() -> np.ndarray:
    return np.zeros(TABLE_BITS >> 6, np.uint64)


# --- counting -------------------------------------------------------------------
def tokens(text: str) -> list[bytes]:
    """The lower-cased words, with ``.`` where a piece ends (no word holds one)."""
    return text.encode("utf-8", "surrogatepass").lower().translate(BREAKS).replace(b".", b" . ").split()


class _Block:
    """Numbered words of some texts; number 0 ends a piece."""

    def __init__(self) -> None:
        self.number: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.ids: list[int] = [0]

    def add(self, lang: str, text: str) -> None:
        known = self.number.setdefault(lang, {b".": 0})
        words = tokens(text)
        for w in set(words).difference(known):
            known[w] = len(self.words)
            self.words.append(w)
            self.langs.append(lang)
        self.ids.extend(map(known.__getitem__, words))
        self.ids.append(0)

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all tokens, and the hash of each number's word."""
        hashes = np.fromiter(map(word_hash, self.langs, self.words), np.uint64, len(self.words))
        return np.array(self.ids, np.int64), hashes


def _border(
    ids: np.ndarray, hashes: np.ndarray, table: np.ndarray, before: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For 1 to ``LONGEST`` words, the phrases to be counted: place, fingerprint, held, counted before.

    A phrase is counted where its first and its last part of one word less are held.  With
    the table of an earlier pass, phrases that it had not counted stand for held ones in
    turn: all longer phrases they could lead to come with them.
    """
    words = np.arange(len(hashes)) > 0
    h, held = hashes[ids], (is_held(table, hashes) & words)[ids]
    was = held if before is None else (is_held(before, hashes) & words)[ids]
    at = np.flatnonzero(ids)
    yield at, h[at], held[at], np.full(len(at), before is not None)
    for k in range(2, LONGEST + 1):
        at = np.flatnonzero(held[:-1] & held[1:])
        h = longer_hash(h[:-1], hashes[ids[k - 1 :]])
        member, old = is_held(table, h[at]), np.zeros(len(at), bool)
        held = np.zeros(len(h), bool)
        held[at] = member
        if before is not None:
            old = was[:-1][at] & was[1:][at]
            was = np.zeros(len(h), bool)
            was[at[old]] = is_held(before, h[at[old]])
            held[at[~old]] = True
        yield at, h[at], member, old


def _print_rows(block: _Block, table: np.ndarray, only: int | None = None) -> Iterator[pa.RecordBatch]:
    """(h, n, held): fingerprints of the phrases ``table`` has counted (of ``only`` words)."""
    ids, hashes = block.numbers()
    for k, (_, h, held, _) in enumerate(_border(ids, hashes, table), 1):
        if only in (None, k):
            prints, first, n = np.unique(h, return_index=True, return_counts=True)
            columns = [pa.array(prints.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(held[first])]
            yield pa.RecordBatch.from_arrays(columns, ["h", "n", "held"])


def _phrase_rows(
    block: _Block, table: np.ndarray, before: np.ndarray, frequent: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, k, n) of the phrases that ``frequent`` holds or ``before`` had not counted.

    With k = 0, the words of each language.
    """
    ids, hashes = block.numbers()
    words = np.array([w.decode("utf-8", "surrogatepass") for w in block.words], object)
    langs = np.array(block.langs, object)
    for k, (at, h, _, old) in enumerate(_border(ids, hashes, table, before), 1):
        at = at[~old | is_held(frequent, h)]
        code = ids[at]
        for j in range(1, k):
            code = np.unique(code, return_inverse=True)[1] * len(words) + ids[at + j]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        place = at[first]
        phrases = list(map(" ".join, zip(*(words[ids[place + j]] for j in range(k)))))
        yield _rows(langs[ids[place]], phrases, k, n)
    names, sums = np.unique(langs[ids[ids > 0]].astype(str), return_counts=True)
    yield _rows(names, [""] * len(names), 0, sums)


def _rows(langs, phrases: list[str], k: int, n: np.ndarray) -> pa.RecordBatch:
    columns = [
        pa.array(list(langs), pa.string()),
        pa.array(phrases, pa.string()),
        pa.array(np.full(len(n), k, np.int32)),
        pa.array(n.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "k", "n"])


def _over_blocks(texts: DataFrame, rows_of, tables: list[np.ndarray], schema: str, *more) -> DataFrame:
    """The rows of every block of ``texts`` (lang, text)."""
    sent = [texts.sparkSession.sparkContext.broadcast(t) for t in tables]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = _Block(), [t.value for t in sent]
        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                block.add(lang.as_py(), text.as_py())
                if len(block.ids) > HELD_WORDS:
                    yield from rows_of(block, *held, *more)
                    block = _Block()
        yield from rows_of(block, *held, *more)

    return texts.mapInArrow(work, schema)


def frequent_prints(texts: DataFrame, table: np.ndarray, least: int, only: int | None = None) -> DataFrame:
    """(h, held): fingerprints with ``least`` occurrences of what ``table`` has counted."""
    rows = _over_blocks(texts, _print_rows, [table], "h BIGINT, n BIGINT, held BOOLEAN", only)
    sums = rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("held").alias("held"))
    return keep_table(sums.where(F.col("n") >= least).select("h", "held"), "phrase-prints")


def mined_sample(sample: DataFrame, least: int) -> np.ndarray:
    """The table of the sample's phrases of ``least`` occurrences, found one length after another."""
    table = no_phrases()
    for k in range(1, LONGEST + 1):
        table = table_with(frequent_prints(sample, table, least, k), table)
    return table


def closed_counts(texts: DataFrame, proposed: np.ndarray, least: int) -> DataFrame:
    """(lang, phrase, k, n) of all phrases with at least ``least`` occurrences, and the k = 0 totals."""
    prints = frequent_prints(texts, proposed, least)
    frequent = table_with(prints, no_phrases())
    grown = table_with(prints.where(~F.col("held")), proposed)  # with the border's failures
    rows = _over_blocks(
        texts, _phrase_rows, [grown, proposed, frequent], "lang STRING, phrase STRING, k INT, n BIGINT"
    )
    # A phrase has one k; as a plain maximum it leaves Spark its hash aggregate.
    counts = rows.groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.sum("n").alias("n"))
    return counts.where((F.col("n") >= least) | (F.col("k") == 0))


def frequent_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT
) -> DataFrame:
    """(lang, phrase, k, n) of all phrases that occur ``least`` times, and the k = 0 totals."""
    texts = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        whole_text(docs, text_col).alias("text"),
        docs[id_col].cast("string").alias("name"),
    )
    chosen = F.pmod(F.xxhash64("name", "text"), F.lit(SAMPLE_OF)) == 0
    sample = keep_table(texts.where(chosen).select("lang", "text"), "phrase-sample")
    return closed_counts(texts.select("lang", "text"), mined_sample(sample, SAMPLE_LEAST), least)


# --- scores ---------------------------------------------------------------------
def _part(begin, length):
    return F.array_join(F.slice("words", begin, length), " ")


def scored_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every phrase of two words or more, by its lowest cut."""
    whole = phrases.where("k >= 2").withColumn("words", F.split("phrase", " "))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "cut",
        _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    sides = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) div (CAST(l AS DECIMAL(19, 0)) + r) AS BIGINT)")
    low = F.min(F.struct(score.alias("score"), F.col("cut"), F.col("l"), F.col("r"))).alias("low")
    return sides.groupBy("lang", "phrase", "a").agg(low).select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def not_inside(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """The candidates that no longer frequent phrase holds in four fifths of their places."""
    longer = phrases.where("k >= 3").withColumn("words", F.split("phrase", " "))
    sized = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    placed = sized.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inner = placed.select("lang", _part(F.col("begin"), F.col("size")).alias("phrase"), "n")
    around = inner.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    covered = F.expr("CAST(around AS DECIMAL(22, 0)) * 100 >= CAST(a AS DECIMAL(22, 0)) * 80")
    return candidates.join(around, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("around")


def collocations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    least: int = LEAST_COUNT, top: int = TOP,
) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counted = keep_table(frequent_phrases(docs, id_col, text_col, lang_col, least), "phrases")
    phrases = counted.where("k > 0")
    kept = keep_table(not_inside(scored_phrases(phrases), phrases), "phrase-scores")
    falling = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The first of each part bound what the last ranking of a language has to read.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*falling)
    firsts = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*falling)
    best = firsts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counted.where("k = 0").select("lang", "n")
    totals = if_small(totals, totals.count(), TOTAL_ROW_BYTES)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
