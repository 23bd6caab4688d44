"""Token ids as frequency-ranked, byte-aligned, variable-length files.

The table is range-sorted by doc_id into parts.  A part's task encodes its texts,
replaces ids by their rank of frequency in the part, so common ids are small
numbers, and writes blocks.  A rank takes one to four bytes; the lengths of four
ranks share one control byte, kept apart from the data bytes.  Decoding looks each
control byte up in a table of 256 rows and gathers whole blocks with numpy.

Files are Parquet files in ascending doc_id order (by part, then block), one row
per block: part, block, n_docs, n_ids, block BINARY.  The block itself is
self-contained, all numbers little-endian:

    4s magic "MRV1" | u32 docs | u64 ids | u64 data bytes
    docs bytes: 1 where the document has an id | docs * i64 doc_id | docs * u64 ids of the document
    ceil(ids / 4) control bytes, two bits a rank, lowest first: bytes of the rank - 1
    data bytes

A part's first row has block -1 and holds the ids by rank (u32 each), at most as
many as the vocabulary has.

Defined results: null text is empty text (the end id alone); null doc_ids sort
first; equal doc_ids are ordered by their text's hash, then their text; an empty
table gives no blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import if_small, input_bytes, keep_table, whole_text
from millrace.llm.tokens import id_table

MAGIC = b"MRV1"
HEAD = struct.Struct("<4sIQQ")
BLOCK_IDS = 1 << 20
PART_BYTES = 16 << 20  # of the table's files, some 10 million ids
RANK_TABLE_BYTES = 200_000  # ids by rank of a part in a broadcast
BLOCK_ROW_BYTES = 64  # an offset row in a broadcast

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


# --- the coding ---------------------------------------------------------------
def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    r = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    quads = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    quads[: len(r)] = size - 1
    q = quads.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4)[None, :] < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` numbers."""
    size = _LENGTHS[control].reshape(-1)[:n]
    end = np.cumsum(size)
    at = end - size
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    out = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        wide = np.flatnonzero(size > k)
        out[wide] |= padded[at[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_block(doc_ids: list[int | None], lengths: list[int], ranks: np.ndarray) -> bytes:
    control, data = encode_ranks(ranks)
    has = bytes(d is not None for d in doc_ids)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    head = HEAD.pack(MAGIC, len(doc_ids), len(ranks), len(data))
    return b"".join([head, has, ids, np.array(lengths, "<u8").tobytes(), control, data])


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ranks) of a block."""
    magic, docs, n, size = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    raw, at = np.frombuffer(block, np.uint8), HEAD.size
    has = raw[at : at + docs]
    ids = np.frombuffer(block, "<i8", docs, at + docs).tolist()
    lengths = np.frombuffer(block, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    controls = -(-n // 4)
    ranks = decode_ranks(raw[at : at + controls], raw[at + controls : at + controls + size], n)
    return [d if h else None for d, h in zip(ids, has)], lengths, ranks


# --- Spark steps ----------------------------------------------------------------
FILES = "part INT, block INT, n_docs INT, n_ids BIGINT, data BINARY"


def rank_ids(counts: np.ndarray) -> np.ndarray:
    """Ids by falling frequency, then by id; ids that do not occur are left out."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    return order[: np.count_nonzero(counts)].astype("<u4")


def _row(part: int, block: int, n_docs: int, n_ids: int, data: bytes) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    cells = [pa.array([v], k) for v, k in zip((part, block, n_docs, n_ids, data), kinds)]
    return pa.RecordBatch.from_arrays(cells, ["part", "block", "n_docs", "n_ids", "data"])


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode ``docs``, each text followed by ``end_id``; the files, under the shared folder."""
    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    parts = max(1, -(-input_bytes(docs, text_col) // PART_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = id_table(tokenizer_path), TaskContext.get().partitionId()
        kind = table.lib.dtype
        end = np.array([end_id], kind).tobytes()
        doc_ids, packed, counts = [], [], np.zeros(1 << 8 * kind.itemsize if kind.itemsize == 2 else 0, np.int64)
        for b in batches:  # a part's ids stay in memory: PART_BYTES bounds them
            fresh = [table.encode(t) + end for t in b.column("text").to_pylist()]
            found = np.bincount(np.frombuffer(b"".join(fresh), kind), minlength=len(counts))
            if len(found) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
            counts += found
            doc_ids += b.column("doc_id").to_pylist()
            packed += fresh
        if not doc_ids:
            return
        ids_by_rank = rank_ids(counts)
        rank_of = np.zeros(len(counts), np.uint32)
        rank_of[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)
        yield _row(part, -1, 0, 0, ids_by_rank.tobytes())
        lengths = [len(p) // kind.itemsize for p in packed]
        first = size = block = 0
        for last, n in enumerate(lengths, 1):
            size += n
            if size >= BLOCK_IDS or last == len(lengths):
                ranks = rank_of[np.frombuffer(b"".join(packed[first:last]), kind)]
                data = pack_block(doc_ids[first:last], lengths[first:last], ranks)
                yield _row(part, block, last - first, size, data)
                first, size, block = last, 0, block + 1

    ordered = (
        texts.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    return keep_table(ordered.mapInArrow(write, FILES), "token-files", "zstd")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("part", "block", "data", "ranks"))
            for part, block, data, ranked in zip(*columns):
                doc_ids, lengths, ranks = unpack_block(data)
                raw = memoryview(np.frombuffer(ranked, "<u4")[ranks].tobytes())
                end = np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(end.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(doc_ids), part, np.int32)), pa.array(np.full(len(doc_ids), block, np.int32)),
                        pa.array(doc_ids, pa.int64()), pa.array(end - lengths), pa.array(lengths), pa.array(crc, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    blocks, tables = files.where("block >= 0"), files.where("block < 0").select("part", F.col("data").alias("ranks"))
    parts = tables.count()
    rows = (
        blocks.join(if_small(tables, parts, RANK_TABLE_BYTES), "part")
        .select("part", "block", "data", "ranks")
        .mapInArrow(read, "part INT, block INT, doc_id BIGINT, inside BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    )
    before = if_small(block_starts(blocks), blocks.count(), BLOCK_ROW_BYTES)
    return rows.join(before, ["part", "block"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def block_starts(blocks: DataFrame) -> DataFrame:
    """(part, block, before): ids of all earlier blocks, in two levels of sums."""
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = parts.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("part_before"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("earlier", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "block", (F.col("part_before") + F.col("earlier")).alias("before"))
    )
