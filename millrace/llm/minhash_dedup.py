"""Near-dedup by fast similarity sketches, banding and a check of whole shingle sets.

A document's set holds its distinct 3-word shingles (A-Z lower-cased, words parted by
white space; a shorter text is one shingle).  Documents are linked when 100 * common
>= 85 * united.

The sketch places shingles in ``COORDINATES`` bins.  In round r below the number of
bins every shingle falls in a bin of its own hash; in round ``COORDINATES`` + j all
shingles fall in bin j, so every bin of a set that is not empty is filled, whatever its
size.  A bin keeps the least (round, hash); a set takes no further round once it is
full.  Two sets agree in a coordinate with a chance of their similarity, and the bins
are filled without replacement, so the agreement is concentrated at least as well as
that of independent draws.

``BANDS`` bands of ``BAND_VALUES`` coordinates name buckets.  At a similarity of 0.85 a
pair shares no bucket with a chance of 2.6e-7, above it with less.  Pairs that share a
bucket are settled in two steps, both on whole sets:

1. each member against the least member of its bucket: a number of pairs in proportion
   to the members, joined to their sets by the id of the set;
2. buckets whose members are then still in different components are searched whole.
   Inside one component nothing is left to find, so only members outside a bucket's
   largest component ask.  A bucket of more than ``RUN_SHINGLES`` shingles is dealt into
   runs and each pair of runs is a group of its own: nothing is left out.

Equal sets are one entry of the index, so copies are never paired.  Components come from
star contraction over tables in the shared folder.

Defined results: null, empty and blank texts have no shingles and are linked with
nothing, each a component of its own.  A repeated doc_id with different texts joins both
texts' components only by name (the least doc_id), not by link.  Rows without a doc_id
take part; they name a component only if none of its rows has an id (then the name is
null).  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, whole_text
from millrace.llm.shingle_dedup import text_digest
from millrace.llm.simhash_dedup import star_roots

SEED = 42
SHINGLE = 3
BANDS = 32
BAND_VALUES = 6
COORDINATES = BANDS * BAND_VALUES
LEAST, OF = 85, 100  # links have OF * common >= LEAST * united
RUN_SHINGLES = 1 << 19
KNOWN_WORDS = 1 << 18  # word hashes a worker keeps
BATCH_SHINGLES = 1 << 20  # sketched at once
WANTED_ROW_BYTES = 120  # a digest and a set's id in a broadcast

_RNG = np.random.default_rng(SEED)
_ROUND = _RNG.integers(0, 1 << 63, 2 * COORDINATES, np.uint64)
_FOLD = _RNG.integers(0, 1 << 63, (BANDS, BAND_VALUES), np.uint64) * np.uint64(2) + np.uint64(1)
_OPEN = np.iinfo(np.uint64).max
_word_hash: dict[bytes, int] = {}


# --- shingle sets and sketches ------------------------------------------------
def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the distinct shingles, ascending."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_word_hash) > KNOWN_WORDS:
        _word_hash.clear()
    for w in set(words).difference(_word_hash):
        _word_hash[w] = xxhash.xxh64_intdigest(w, SEED)
    codes = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    width = min(shingle, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        h = mixed(h + codes[k : len(codes) - width + 1 + k])
    return np.unique(h)


def fast_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` values per set (none of them empty)."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shingles = np.concatenate(sets)
    out = np.full((len(sets), COORDINATES), _OPEN, np.uint64)
    flat, half, low = out.reshape(-1), np.uint64(32), np.uint64(0xFFFFFFFF)
    for r in range(2 * COORDINATES):
        h = mixed(shingles ^ _ROUND[r])
        bin_ = (((h >> half) * np.uint64(COORDINATES)) >> half).astype(np.int64) if r < COORDINATES else r - COORDINATES
        np.minimum.at(flat, owner * COORDINATES + bin_, (np.uint64(r) << half) | (h & low))
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        alive = owner[begins]
        wanting = np.zeros(len(sets), bool)
        wanting[alive] = (out[alive] == _OPEN).any(axis=1)
        more = wanting[owner]
        if not more.any():
            break
        if not more.all():
            owner, shingles = owner[more], shingles[more]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One bucket key per band of every sketch; the band is part of the key."""
    folded = (mixed(sketch.reshape(-1, BANDS, BAND_VALUES)) * _FOLD).sum(axis=2, dtype=np.uint64)
    return mixed(folded + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def set_id(s: np.ndarray) -> bytes:
    """128 bits that stand for a shingle set."""
    return xxhash.xxh3_128_digest(s.tobytes(), SEED)


def _sketch_rows(sets: list[np.ndarray]) -> list:
    full = [s for s in sets if len(s)]
    keys = iter(band_keys(fast_sketches(full))) if full else iter(())
    return [next(keys) if len(s) else np.zeros(0, np.int64) for s in sets]


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, shas, texts = b.column("doc_id"), b.column("sha"), b.column("text")
        begin, sets, held = 0, [], 0
        for i in range(len(texts)):
            sets.append(shingle_set(texts[i].as_py()))
            held += len(sets[-1])
            if held < BATCH_SHINGLES and i + 1 < len(texts):
                continue
            n = i + 1 - begin
            columns = [
                ids.slice(begin, n),
                shas.slice(begin, n),
                pa.array([set_id(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(_sketch_rows(sets), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "node", "n", "bands"])
            begin, sets, held = i + 1, [], 0


def document_sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, sha of the text, node (its shingle set), n shingles, bucket keys."""
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        text_digest(docs, text_col).alias("sha"),
        whole_text(docs, text_col).alias("text"),
    )
    return rows.mapInArrow(_sketch_batches, "doc_id BIGINT, sha BINARY, node BINARY, n BIGINT, bands ARRAY<BIGINT>")


# --- candidates ---------------------------------------------------------------
def index_entries(rows: DataFrame) -> DataFrame:
    """(node, n, bands, sha): one entry per shingle set that is not empty, with one text that has it."""
    held = rows.where("n > 0").groupBy("node")
    return held.agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("sha").alias("sha"))


def shared_buckets(entries: DataFrame) -> DataFrame:
    """(key, node, n, first, first_n): members of buckets that hold more than one set, and the least of them."""
    members = entries.select(F.explode("bands").alias("key"), "node", "n")
    low = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("low"), F.max("node").alias("top"))
    low = keep_table(low.where("low.node < top").select("key", F.col("low.node").alias("first"), F.col("low.n").alias("first_n")), "minhash-shared")
    return keep_table(members.join(low, "key"), "minhash-buckets")


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t).view(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def shingle_sets(docs: DataFrame, wanted: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, shingles) of the sets in ``wanted`` (node, sha), from one text each."""
    wanted = if_small(wanted, wanted.count(), WANTED_ROW_BYTES)
    texts = docs.select(text_digest(docs, text_col).alias("sha"), whole_text(docs, text_col).alias("text"))
    held = texts.join(wanted, "sha").select("node", "text")
    sets = held.mapInArrow(_set_batches, "node BINARY, shingles ARRAY<BIGINT>")
    return keep_table(sets, "minhash-sets").groupBy("node").agg(F.first("shingles").alias("shingles"))


def first_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v), u > v, of members with the least member of a bucket."""
    pairs = members.where(
        (F.col("node") > F.col("first"))
        & (OF * F.least("n", "first_n") >= LEAST * F.greatest("n", "first_n"))
    ).select(F.col("node").alias("u"), F.col("first").alias("v")).distinct()
    pairs = keep_table(pairs, "minhash-pairs")
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b")).cast("bigint")
    united = F.size("a").cast("bigint") + F.size("b") - common
    return pairs.join(left, "u").join(right, "v").where(OF * common >= LEAST * united).select("u", "v")


def open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, n, root) of the buckets whose members are in more than one component so far.

    Buckets with the same members are one.
    """
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    held = members.select("key", "node", "n").join(named, "node", "left")
    held = keep_table(held.withColumn("root", F.coalesce("root", "node")), "minhash-members")
    facts = held.groupBy("key").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.count(F.lit(1)).alias("k"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(SEED))).alias("y"),
    )
    # A bucket of two has had its one pair compared.
    once = facts.where("lo < hi AND k > 2").groupBy("k", "x", "y").agg(F.min("key").alias("key"))
    return held.join(keep_table(once.select("key"), "minhash-open"), "key")


# --- whole search of a bucket -------------------------------------------------
def linked_places(sets: list[np.ndarray], asks: np.ndarray, root: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each asking set, the places of the sets of other roots that it is linked with.

    A linked set holds at least LEAST / OF of the asking set's shingles, so it holds one of
    the few rarest ones: only the holders of those are counted.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.bincount(code)
    end = np.cumsum(size)
    begin = end - size
    holders = np.repeat(np.arange(len(sets)), size)[np.argsort(code, kind="stable")]
    first = np.cumsum(held) - held
    mine = np.zeros(len(held), bool)
    for i in np.flatnonzero(asks):
        codes = code[begin[i] : end[i]]
        rare = codes[np.argsort(held[codes], kind="stable")][: size[i] - -(-LEAST * size[i] // OF) + 1]
        near = np.unique(np.concatenate([holders[first[c] : first[c] + held[c]] for c in rare]))
        fits = (root[near] != root[i]) & (OF * np.minimum(size[near], size[i]) >= LEAST * np.maximum(size[near], size[i]))
        near = near[fits]
        if not len(near):
            continue
        mine[codes] = True
        common = np.fromiter((np.count_nonzero(mine[code[begin[j] : end[j]]]) for j in near), np.int64, len(near))
        mine[codes] = False
        near = near[OF * common >= LEAST * (size[i] + size[near] - common)]
        if len(near):
            yield i, near


def _search_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """A forest of the links between the components of two runs (or inside one)."""
    node, run = rows["node"].tolist(), rows["run"].to_numpy()
    names, root = np.unique(np.array(rows["root"].tolist(), dtype=object), return_inverse=True)
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in rows["shingles"]]
    asks = root != np.bincount(root).argmax()
    if rows["lo"].iloc[0] != rows["hi"].iloc[0] and np.count_nonzero(asks) > np.count_nonzero(run == run.min()):
        asks = run == run.min()
    us, vs, up = [], [], list(range(len(names)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, near in linked_places(sets, asks, root):
        for j in near[np.unique(root[near], return_index=True)[1]]:  # one link to each component
            a, b = top(root[i]), top(root[j])
            if a != b:
                up[max(a, b)] = min(a, b)
                us.append(max(node[i], node[j]))
                vs.append(min(node[i], node[j]))
    return pd.DataFrame({"u": us, "v": vs}, dtype=object)


def late_links(held: DataFrame, sets: DataFrame, run_shingles: int = RUN_SHINGLES) -> DataFrame:
    """Links between the components that meet in an open bucket."""
    sizes = held.groupBy("key").agg(F.sum("n").alias("shingles"))
    placed = (
        held.join(sizes, "key")
        .withColumn("runs", F.ceil(F.col("shingles") / F.lit(run_shingles)).cast("int"))
        .withColumn("run", F.pmod(F.xxhash64("node"), F.col("runs")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
        .select("key", "node", "root", "run", F.least("run", "other").alias("lo"), F.greatest("run", "other").alias("hi"))
    )
    searched = placed.join(sets, "node").groupBy("key", "lo", "hi").applyInPandas(_search_runs, "u BINARY, v BINARY")
    return searched.distinct()


# --- groups -------------------------------------------------------------------
def minhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_shingles: int = RUN_SHINGLES
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest reachable doc_id), kept."""
    rows = keep_table(document_sketches(docs, id_col, text_col), "minhash-sketches")
    entries = keep_table(index_entries(rows), "minhash-entries")
    members = shared_buckets(entries)
    wanted = entries.select("node", "sha").join(members.select("node").distinct(), "node", "left_semi")
    sets = keep_table(shingle_sets(docs, keep_table(wanted, "minhash-wanted"), text_col), "minhash-full-sets")
    links = keep_table(first_links(members, sets), "minhash-links")
    late = keep_table(late_links(open_buckets(members, star_roots(links)), sets, run_shingles), "minhash-late")
    named = star_roots(links.unionByName(late)).select(F.col("u").alias("node"), F.col("v").alias("root"))
    # Only groups of more than one set need a name from elsewhere.
    joined = named.unionByName(named.select(F.col("root").alias("node"), "root").distinct())
    firsts = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = firsts.join(joined, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = keep_table(rooted, "minhash-rooted")
    names = keep_table(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "minhash-names")
    by_node = keep_table(rooted.join(names, "root").select("node", "component_id"), "minhash-named")
    full = rows.where("n > 0").select("doc_id", "node", F.col("n").alias("n_shingles")).join(by_node, "node").drop("node")
    bare = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
