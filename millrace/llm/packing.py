"""Best-fit packing of token sequences in bulk-synchronous supersteps.

Documents longer than the capacity are cut into pieces.  Pieces are range-sorted
by falling length and ranked inside their length; gaps (what open sequences have
left) are sorted by size.  One superstep takes the pieces of one length: their
successor is the smallest gap that holds them, conflicts over it are settled by
rank (the first pieces take it, as many as fit, the next ones go on to the next
gap), the gaps shrink, and the next length follows; what finds no gap opens new
sequences.  The outcome is that of sequential best-fit decreasing.

Lengths and gaps are whole numbers up to the capacity, so supersteps exchange
runs (length, ranks, sequences) instead of rows: how many there are depends on
the capacity and never on the number of documents.  The ranking of the pieces and
their placing are distributed: each piece looks its run up by (length, rank).

Defined results: null text is empty text (its end id alone is packed); pieces of
repeated rows are packed each; an empty table packs nothing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import keep_table, shuffle_width, whole_text
from millrace.llm.tokens import CACHE_PIECES, id_table

RANK_BITS = 48  # of the (length, rank) key
TEXTS = 256  # of a batch, held as Python strings at once


@dataclass(frozen=True)
class Runs:
    """Placements: piece ``rank_from + i`` of ``length`` goes to sequence
    ``sequence + i // per`` at ``offset + (i % per) * length``."""

    length: np.ndarray
    rank_from: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of each piece."""
        keys = self.length << RANK_BITS | self.rank_from
        order = np.argsort(keys)
        at = order[np.searchsorted(keys[order], length << RANK_BITS | rank, side="right") - 1]
        i = rank - self.rank_from[at]
        return self.sequence[at] + i // self.per[at], self.offset[at] + i % self.per[at] * length


def best_fit_runs(counts: dict[int, int], capacity: int) -> Runs:
    """Supersteps over falling lengths; ``counts`` has the number of pieces of each length."""
    gaps: dict[int, deque[tuple[int, int]]] = {}
    sizes: list[int] = []
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap > 0 and n > 0:
            if gap not in gaps:
                gaps[gap] = deque()
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(sizes, length)
            if i == len(sizes):
                new = -(-left // (capacity // length))
                leave(capacity, opened, new)
                opened += new
                continue
            gap = sizes[i]
            first, n = gaps[gap].popleft()
            if not gaps[gap]:
                del gaps[gap], sizes[i]
            per = min(gap // length, left)
            used = min(n, left // per)
            rows.append((length, rank, per, first, capacity - gap))
            leave(gap - per * length, first, used)
            leave(gap, first + used, n - used)
            rank, left = rank + per * used, left - per * used
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Runs(*columns, sequences=opened)


def ranked(pieces: DataFrame, key: list[str], chunks: int) -> DataFrame:
    """``pieces`` with their rank inside their length.

    A length may have a third of all pieces, so each is ranked in ``chunks`` parts;
    a part starts after the counted rows of the earlier ones.
    """
    cut = pieces.withColumn("chunk", F.pmod(F.xxhash64(*key), F.lit(chunks)).cast("int"))
    counts = cut.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start_rank"))
    inside = Window.partitionBy("length", "chunk").orderBy(*key)
    return (
        cut.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, ["length", "chunk"])
        .select(*pieces.columns, (F.col("start_rank") + F.col("inside")).alias("rank"))
    )


def best_fit_pack(pieces: DataFrame, key: list[str], capacity: int) -> DataFrame:
    """``pieces`` (with ``length`` BIGINT from 1 to ``capacity``) plus sequence_id and offset.

    ``key`` orders pieces of equal length.  ``pieces`` is read twice: pass a table.
    """
    spark = pieces.sparkSession
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per length
    runs = spark.sparkContext.broadcast(best_fit_runs({r["length"]: r["n"] for r in lengths}, capacity))
    rows = ranked(pieces, key, 4 * shuffle_width(spark))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sequence, offset = runs.value.place(
                    b.column("length").to_numpy(zero_copy_only=False), b.column("rank").to_numpy(zero_copy_only=False)
                )
                keep = [b.column(c) for c in b.schema.names if c != "rank"]
                names = [c for c in b.schema.names if c != "rank"]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
                )

    schema = rows.drop("rank").schema.add("sequence_id", LongType()).add("offset", LongType())
    return rows.mapInArrow(place, schema)


def document_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    cache_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and ``ids``, packed, if wanted).

    A worker holds the ids of at most ``cache_pieces`` pieces of text.
    """
    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = id_table(tokenizer_path, cache_pieces)
        kind = table.lib.dtype
        end = np.array([end_id], kind).tobytes()
        for b in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            texts = b.column("text")
            for i, text in enumerate(t for at in range(0, len(texts), TEXTS) for t in texts.slice(at, TEXTS).to_pylist()):
                ids = np.frombuffer(table.encode(text) + end, kind)
                for k, s in enumerate(range(0, len(ids), capacity)):
                    part = ids[s : s + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                    if with_ids:
                        kept.append(part.astype("<u4").tobytes())
            columns = [
                b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT" + ", ids BINARY" * with_ids
    return texts.mapInArrow(cut, schema)


PIECE_KEY = ["doc_id", "piece", "ids_crc32"]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = keep_table(
        document_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, cache_pieces=cache_pieces), "pieces"
    )
    return best_fit_pack(pieces, PIECE_KEY, capacity)


def packed_sequences(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (packed 32-bit ids in order).

    A sequence has at most ``capacity`` tokens, so its group is bounded.
    """
    pieces = keep_table(
        document_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids=True), "pieces-ids", "zstd"
    )
    placed = best_fit_pack(pieces, PIECE_KEY, capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
    )
