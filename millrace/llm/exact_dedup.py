"""Exact dedup against a minimal perfect hash of the digests seen before.

The digests of a history are spread over buckets.  Each bucket gets a minimal
perfect hash: levels of bit arrays in which every key owns exactly one set bit,
whose rank is the key's slot.  A slot holds the full 32-byte digest, the locator
(doc_id) of the group's winner and the group's size.  A batch is grouped first
(combined map-side, so a text that is a third of all rows is one row per task),
then its digests are looked up and compared byte for byte: members are repeats
of the history, nonmembers form groups of their own.

Defined results: null text is empty text; a null doc_id takes part but never
wins against another; rows repeating one doc_id and text are one document (each
row carries the same verdict); empty tables give empty results.  Only the id and
text columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, lower_ascii, shuffle_width, whole_text

DIGEST_BYTES = 32
KEYS_PER_BUCKET = 32_768
BUCKETS_PER_PARTITION = 4
GAMMA = 2  # bits of a level per key still to be placed
MAX_LEVELS = 48
ODD_ROW_BYTES = 120  # an id, a hex digest and their overhead in a broadcast
NO_ID = np.iinfo(np.int64).min

GROUPS = "digest BINARY, has_id BOOLEAN, winner BIGINT, n BIGINT"
INDEX = (
    "bucket INT, n INT, sizes ARRAY<INT>, bits BINARY, slots BINARY, winners BINARY, "
    "counts BINARY"
)


# --- the hash of one bucket -------------------------------------------------
def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = digests.reshape(-1, DIGEST_BYTES).view("<u8")
    return w[:, 1].copy(), w[:, 2] | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    h = a + b * np.uint64(level)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the bits of all levels, and each key's slot (a permutation)."""
    a, b = _words(digests)
    left = np.arange(len(a))
    where = np.full(len(a), -1, np.int64)
    sizes, bits, base = [], [], 0
    for level in range(MAX_LEVELS):
        if not len(left):
            break
        size = max(8, GAMMA * len(left))
        at = _place(a[left], b[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        ok = alone[at]
        where[left[ok]] = base + at[ok]
        left = left[~ok]
        sizes.append(size)
        bits.append(alone)
        base += size
    all_bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    slot = np.empty(len(a), np.int64)
    placed = where >= 0
    slot[placed] = np.cumsum(all_bits)[where[placed]] - 1 if placed.any() else 0
    slot[left] = placed.sum() + np.arange(len(left))  # never placed: the last slots, compared one by one
    return sizes, all_bits, slot


def find_slots(digests: np.ndarray, sizes: list[int], bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The slot of each digest, or -1 where the slot's digest differs in any byte."""
    keys = digests.reshape(-1, DIGEST_BYTES)
    held = slots.reshape(-1, DIGEST_BYTES)
    out = np.full(len(keys), -1, np.int64)
    if not len(keys) or not len(held):
        return out
    a, b = _words(digests)
    rank, left, base = np.cumsum(bits), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + _place(a[left], b[left], level, size)
        hit = bits[at]
        found, slot = left[hit], rank[at[hit]] - 1
        same = (held[slot] == keys[found]).all(axis=1)
        out[found[same]] = slot[same]
        left, base = left[~hit], base + size
    for slot in range(int(bits.sum()), len(held)):
        out[left[(keys[left] == held[slot]).all(axis=1)]] = slot
    return out


# --- Spark steps --------------------------------------------------------------
def document_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the whole text, A-Z lower-cased, as UTF-8."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(lower_ascii(whole_text(docs, text_col)), 256)).alias("digest"),
    )


def group_digests(digests: DataFrame) -> DataFrame:
    """One row per distinct digest, combined map-side: winner is the largest doc_id."""
    return digests.groupBy("digest").agg(
        F.max("doc_id").isNotNull().alias("has_id"),
        F.coalesce(F.max("doc_id"), F.lit(int(NO_ID))).alias("winner"),
        F.count(F.lit(1)).alias("n"),
    )


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8)


def _build_bucket(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    sizes, bits, slot = build_hash(digests)
    order = np.argsort(slot)
    return pd.DataFrame(
        {
            "bucket": [key[0]],
            "n": [len(rows)],
            "sizes": [[int(s) for s in sizes]],
            "bits": [np.packbits(bits).tobytes()],
            "slots": [digests.reshape(-1, DIGEST_BYTES)[order].tobytes()],
            "winners": [rows["winner"].to_numpy(np.int64)[order].tobytes()],
            "counts": [rows["n"].to_numpy(np.int64)[order].tobytes()],
        }
    )


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of history groups: hash levels, digests, winners, counts."""
    return _bucketed(groups, buckets).groupBy("bucket").applyInPandas(_build_bucket, INDEX)


def _resolve_bucket(batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(batch["digest"])
    top, n = batch["winner"].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
    if not len(index):
        return pd.DataFrame({"digest": batch["digest"], "has_id": top != NO_ID, "winner": top, "n": n})
    row = index.iloc[0]
    sizes = [int(s) for s in row["sizes"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    held = np.frombuffer(row["slots"], np.uint8)
    winners = np.frombuffer(row["winners"], np.int64).copy()
    counts = np.frombuffer(row["counts"], np.int64).copy()
    slot = find_slots(digests, sizes, bits, held)
    member = slot >= 0
    winners[slot[member]] = np.maximum(winners[slot[member]], top[member])
    counts[slot[member]] += n[member]
    raw = held.tobytes()
    known = [raw[i : i + DIGEST_BYTES] for i in range(0, len(raw), DIGEST_BYTES)]
    all_top = np.concatenate([winners, top[~member]])
    return pd.DataFrame(
        {
            "digest": known + list(batch["digest"][~member]),
            "has_id": all_top != NO_ID,
            "winner": all_top,
            "n": np.concatenate([counts, n[~member]]),
        }
    )


def resolve_batch(batch: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """All groups after the batch: members move their slot's winner, nonmembers are new groups."""
    return (
        _bucketed(batch, buckets)
        .groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(_resolve_bucket, GROUPS)
    )


def bucket_count(spark, keys: int) -> int:
    """Buckets for ``keys`` digests: bounded keys per bucket, and enough for every task."""
    return max(BUCKETS_PER_PARTITION * shuffle_width(spark), -(-keys // KEYS_PER_BUCKET))


def exact_groups(digests: DataFrame, history: DataFrame) -> DataFrame:
    """Groups of ``digests`` plus ``history``; both have (doc_id, digest)."""
    spark = digests.sparkSession
    buckets = bucket_count(spark, max(digests.count(), history.count()))
    index = keep_table(build_index(group_digests(history), buckets), "digest-index")
    return resolve_batch(group_digests(digests), index, buckets)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One verdict per row: doc_id, keep_id, group_size, kept, text_sha256.

    The lower half of the id range is the history, the rest the new batch.  The
    digests (40 bytes a row) are kept as a table, so texts are hashed once.
    """
    digests = keep_table(document_digests(docs, id_col, text_col), "digests")
    ends = digests.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    middle = 0 if ends.lo is None else (ends.lo + ends.hi) // 2
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    groups = exact_groups(digests.where(~old), digests.where(old))
    keep = F.when(F.col("has_id"), F.col("winner"))
    return digests.join(groups, "digest").select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows repeating one doc_id and text, one stays.
    """
    verdicts = exact_dedup(docs, id_col, text_col)
    odd = keep_table(
        verdicts.groupBy(F.col("doc_id").alias("_odd_id"), F.col("text_sha256").alias("_odd_sha"))
        .agg(F.first("kept").alias("_odd_kept"), F.count(F.lit(1)).alias("_odd_rows"))
        .where(~F.col("_odd_kept") | (F.col("_odd_rows") > 1)),
        "exact-odd",
    )
    facts = odd.agg(F.count(F.lit(1)).alias("n"), F.count_if("_odd_kept").alias("repeated")).first()
    odd = if_small(odd, facts.n, ODD_ROW_BYTES)
    sha = F.sha2(lower_ascii(whole_text(docs, text_col)), 256)
    same = docs[id_col].cast("bigint").eqNullSafe(F.col("_odd_id")) & (sha == F.col("_odd_sha"))
    stays = docs.join(odd, same, "left_anti")
    if not facts.repeated:
        return stays
    again = docs.join(odd.where("_odd_kept"), same).dropDuplicates([id_col, "_odd_sha"])
    return stays.unionByName(again.select(*docs.columns))
