"""Language-model scores by a weighted backoff automaton.

The model is a bigram model over whole words.  Its states are histories: a word,
the start of a text, or the root.  A state has an arc for each word seen after it
in training and a failure arc to the root, whose arcs are the smoothed unigrams.
With history count c(u), the arc weighs log10(l * c(u,v)/c(u) + (1-l) * p(v)), the
failure arc log10(1-l), and p(v) = (c(v)+1)/(N+V+1), which leaves one unit for all
unknown words.  The share l depends on how often the history was seen and is
chosen by leave-one-out likelihood over all training tokens.

The whole model never meets in one place.  Documents are cut into blocks of a few
MB; each block asks, by 64-bit hash, for the counts of its own distinct n-grams.
The shuffle carries one entry per block and distinct n-gram (a word that is a
third of all tokens is one entry a block), counts are summed per hash bucket, and
the answers, in the block's own hash order, go back.  A block then builds the part of
the automaton that its texts can reach and traverses them once from left to right.

Defined results: null text is empty (the end token alone); a null doc_id is never
learned from and counts as held out; repeated rows are learned from each; with no
training tokens every word is unknown; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import input_bytes, keep_table, shuffle_width, whole_text

BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20
SHARES = np.array([0.001, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95, 0.99])
HISTORY_BINS = np.array([1, 2, 4, 8, 32, 256, 4096, 65536])  # lower ends of the counts
START, END = b"\r", b"\n"  # no word has these characters

BLOCKS = (
    "block BIGINT, doc_ids BINARY, has_id BINARY, held BINARY, lengths BINARY, tokens BINARY, hashes BINARY"
)
ENTRIES = "block BIGINT, kind INT, bucket INT, hashes BINARY, counts BINARY"
ANSWERS = "block BIGINT, kind INT, bucket INT, counts BINARY"


class _Numbers(dict):
    """Words of a block, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def text_blocks(docs: DataFrame, id_col: str, text_col: str, folds: int, fold: int) -> DataFrame:
    """Blocks of numbered tokens: documents, and the hash of each number's word."""
    doc_id = docs[id_col].cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True)).alias("held"),
        whole_text(docs, text_col).alias("text"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        ids, held, lengths, tokens, words = [], [], [], [], _Numbers({START: 0, END: 1})

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            cells = [
                np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]), np.array(held),
                np.array(lengths, np.int32), np.concatenate(tokens), hashes,
            ]
            names = ["block", "doc_ids", "has_id", "held", "lengths", "tokens", "hashes"]
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), *[pa.array([c.tobytes()], pa.binary()) for c in cells]], names
            )

        for b in batches:
            for i, h, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                found = list(map(words.__getitem__, text.encode("utf-8", "replace").lower().split()))
                found.append(1)
                ids.append(i)
                held.append(h)
                lengths.append(len(found))
                tokens.append(np.array(found, np.uint32))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield flush()
                    block, size = block + 1, 0
                    ids, held, lengths, tokens, words = [], [], [], [], _Numbers({START: 0, END: 1})
        if ids:
            yield flush()

    return rows.mapInArrow(number, BLOCKS)


class Block:
    """One block's tokens and its distinct unigrams and bigrams in hash order."""

    def __init__(self, row: dict):
        self.hashes = np.frombuffer(row["hashes"], np.uint64)
        self.tokens = np.frombuffer(row["tokens"], np.uint32).astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.held = np.frombuffer(row["held"], bool)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.history = np.concatenate([[0], self.tokens[:-1]])
        self.history[np.cumsum(self.lengths)[:-1]] = 0
        self.learn = ~self.held[self.doc]
        keys = self.history * len(self.hashes) + self.tokens
        self.pairs, self.pair_of = np.unique(keys, return_inverse=True)
        a, b = self.hashes[self.pairs // len(self.hashes)], self.hashes[self.pairs % len(self.hashes)]
        mixed = (a * np.uint64(0x9E3779B97F4A7C15) ^ (b << np.uint64(31) | b >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
        self.pair_hashes = mixed ^ mixed >> np.uint64(29)
        self.orders = [np.argsort(self.hashes, kind="stable"), np.argsort(self.pair_hashes, kind="stable")]

    def entries(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hashes, training counts) of unigrams and of bigrams, in hash order."""
        words = np.bincount(self.tokens[self.learn], minlength=len(self.hashes))
        words[0] = np.count_nonzero(~self.held)
        pairs = np.bincount(self.pair_of[self.learn], minlength=len(self.pairs))
        both = [(self.hashes, words), (self.pair_hashes, pairs)]
        return [(h[o], n[o]) for (h, n), o in zip(both, self.orders)]

    def in_place(self, kind: int, answer: np.ndarray) -> np.ndarray:
        """Counts that came in hash order, by word number or by pair."""
        out = np.empty(len(answer), np.int64)
        out[self.orders[kind]] = answer
        return out


def _ask(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                for kind, (hashes, counts) in enumerate(Block(row).entries()):
                    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                    cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
                    ends = list(zip(cut[:-1], cut[1:])) if len(bucket) else []
                    n = len(ends)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["block"]] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                            pa.array([int(bucket[s]) for s, _ in ends], pa.int32()),
                            pa.array([hashes[s:e].tobytes() for s, e in ends], pa.binary()),
                            pa.array([counts[s:e].astype("<u4").tobytes() for s, e in ends], pa.binary()),
                        ],
                        ["block", "kind", "bucket", "hashes", "counts"],
                    )

    return ask


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums the counts of a bucket and answers every block in its own order."""
    hashes = np.frombuffer(b"".join(rows["hashes"]), np.uint64)
    counts = np.frombuffer(b"".join(rows["counts"]), np.uint32)
    distinct, place = np.unique(hashes, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype("<i8")
    sizes = rows["hashes"].map(len).to_numpy() // 8
    ends = np.cumsum(sizes)
    back = total[place]
    out = pd.DataFrame(
        {
            "block": rows["block"], "kind": rows["kind"], "bucket": rows["bucket"],
            "counts": [back[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())],
        }
    )
    if key[1] == 0:  # the sums over the vocabulary: one row with block -1
        word = distinct != np.uint64(xxhash.xxh64_intdigest(START))
        facts = np.array([total[word].sum(), np.count_nonzero(total[word])], "<i8")
        out.loc[len(out)] = [-1, 0, key[0], facts.tobytes()]
    return out


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        facts = np.frombuffer(b"".join(b.column("counts").to_pylist()), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(facts[:, 0]), pa.array(facts[:, 1])], ["n", "v"])


class Automaton:
    """The part of the backoff automaton that a block's texts reach."""

    def __init__(self, block: Block, words: np.ndarray, pairs: np.ndarray, n: int, v: int):
        self.block, self.words, self.pairs, self.total = block, words, pairs, n + v + 1
        self.known = words > 0
        self.known[0] = False
        self.history_count = words[block.pairs // len(block.hashes)]
        self.word_count = words[block.pairs % len(block.hashes)]

    def root(self) -> np.ndarray:
        """Root arcs: log10 p(v) of each word number."""
        return np.log10((self.words + 1) / self.total)

    def arcs(self, share: float, held_out: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Of each (state, word): log10 weight (arc, or failure and root arc), and the state's bin or -1.

        With ``held_out`` false, one occurrence of the pair itself is taken away.
        """
        one = 0 if held_out else 1
        history, pair = self.history_count - one, np.maximum(self.pairs - one, 0)
        smooth = np.maximum(self.word_count + 1 - one, 1) / self.total
        seen = history > 0
        p = np.where(seen, share * pair / np.maximum(history, 1) + (1 - share) * smooth, smooth)
        bins = np.where(seen, np.searchsorted(HISTORY_BINS, history, side="right") - 1, -1)
        return np.log10(p), bins


def _score(key: tuple, blocks: pd.DataFrame, answers: pd.DataFrame, n: int, v: int) -> pd.DataFrame:
    row = blocks.iloc[0]
    block = Block(row)
    answers = answers.sort_values(["kind", "bucket"])
    counts = [
        block.in_place(k, np.frombuffer(b"".join(answers.loc[answers["kind"] == k, "counts"]), np.int64)) for k in (0, 1)
    ]
    auto = Automaton(block, *counts, n, v)
    docs, width = len(block.lengths), len(HISTORY_BINS) + 1
    sums = np.zeros((docs, len(SHARES), width))
    learned = np.zeros((len(SHARES), width))
    own = np.bincount(block.pair_of[block.learn], minlength=len(block.pairs)).astype(float)
    for g, share in enumerate(SHARES):
        weight, bins = auto.arcs(share)
        walked = weight[block.pair_of]  # the state after a word is that word: one pass, left to right
        place = block.doc * width + bins[block.pair_of] + 1
        sums[:, g] = np.bincount(place, weights=walked, minlength=docs * width).reshape(docs, width)
        weight, bins = auto.arcs(share, held_out=False)
        use = own > 0
        learned[g] = np.bincount(bins[use] + 1, weights=own[use] * weight[use], minlength=width)
    ids, has = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["has_id"], bool)
    known = np.bincount(block.doc, weights=auto.known[block.tokens], minlength=docs).astype(np.int64)
    base = np.bincount(block.doc, weights=auto.root()[block.tokens], minlength=docs)
    out = pd.DataFrame(
        {
            "doc_id": pd.array([int(i) if h else None for i, h in zip(ids, has)], dtype="Int64"),
            "held_out": block.held, "n_tokens": block.lengths, "n_known": known, "base_score": base,
            "sums": list(sums.reshape(docs, -1)), "fit": False,
        }
    )
    fit = {
        "doc_id": pd.array([None], dtype="Int64"), "held_out": [False], "n_tokens": [0], "n_known": [0],
        "base_score": [0.0], "sums": [learned.reshape(-1)], "fit": [True],
    }
    return pd.concat([out, pd.DataFrame(fit)], ignore_index=True)


SCORED = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, sums ARRAY<DOUBLE>, fit BOOLEAN"
)


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    buckets = max(2 * shuffle_width(spark), -(-4 * input_bytes(docs, text_col) // BUCKET_BYTES))
    blocks = keep_table(text_blocks(docs, id_col, text_col, folds, fold), "lm-blocks", "zstd")
    answers = keep_table(
        blocks.mapInArrow(_ask(buckets), ENTRIES).groupBy("bucket", "kind").applyInPandas(_answer, ANSWERS), "lm-answers"
    )
    facts = answers.where("block = -1").mapInArrow(_vocabulary, "n BIGINT, v BIGINT")
    n, v = facts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _score(key, left, right, n, v)

    scored = keep_table(
        blocks.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInPandas(score, SCORED),
        "lm-scored",
    )
    width = len(HISTORY_BINS) + 1
    fit = np.zeros(len(SHARES) * width)
    learned = scored.where("fit").select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    for r in learned.collect():  # one row per share and bin
        fit[r["i"]] = r["x"]
    best = fit.reshape(len(SHARES), width).argmax(axis=0)
    total = sum((F.get("sums", F.lit(int(g) * width + b)) for b, g in enumerate(best)), F.lit(0.0))
    return scored.where("NOT fit").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score",
        total.alias("score"),
    )
