"""Token counts by a two-tier lookup on the map side.

First tier: the token lengths of the most frequent pre-tokens, a hash table of at
most ``FREQUENT`` entries of at most ``tokens.CACHE_PIECE_BYTES`` characters, sent
to every worker (a few MB at any corpus size).  Second tier: each worker's own
bounded cache; what it misses is encoded by the library.  Pre-tokens are never
shuffled: to find the frequent ones every task summarises its whole partition
with bounded counters and only these summaries are added up.  The tiers decide
speed alone; every text is counted whole and exactly.

Defined results: null text is empty text with zero tokens; a null doc_id stays
null; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole_text
from millrace.llm.tokens import CACHE_PIECE_BYTES, SPACED_PIECES, LengthTable, library

FREQUENT = 32_768
COUNTERS = 400_000  # of a task; the rarest half goes when they are used up


def frequent_pieces(texts: DataFrame, most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, at most ``most`` of them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(SPACED_PIECES.findall(text))
                if len(seen) > COUNTERS:
                    seen = Counter(dict(seen.most_common(COUNTERS // 2)))
        top = [(p, n) for p, n in seen.most_common(most) if len(p) <= CACHE_PIECE_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["piece", "n"],
        )

    found = texts.select("text").mapInArrow(summarise, "piece STRING, n BIGINT")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(most)
    return [r.piece for r in top.select("piece").collect()]


_WORKER: dict[str, LengthTable] = {}


def _worker_table(path: str, tier: str, sent) -> LengthTable:
    """This worker's table; a later call with another first tier starts anew."""
    held = _WORKER.get(path)
    if held is None or held.tier != tier:
        held = _WORKER[path] = LengthTable(library(path), sent.value)
        held.tier = tier
    return held


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    lib = library(tokenizer_path)
    frequent = {p: len(lib.piece_ids(p)) for p in frequent_pieces(texts)}
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    tier = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker_table(tokenizer_path, tier, sent)
        for b in batches:
            n = [table.count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    sized = texts.select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))
    return sized.mapInArrow(count, "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT").withColumn(
        "over_limit", F.col("n_tokens") > F.lit(limit)
    )
