"""Near-dedup by SimHash fingerprints and by the five-word shingles that texts share.

Two texts are near copies when their sets of five-word shingles have a Jaccard
similarity of at least 0.8; components of such pairs are one group.  The first
candidates are the links of operator 2 (fingerprints of three-word shingles in its
Gray-ordered index, three bits), checked on whole shingle sets.  Near copies of 0.8
differ in more bits than masks can find, so more candidates come from MinHash bands: at a similarity of 0.8 a pair shares none of 32 bands of
five values with a chance of 3e-6, above it with less.  Band values name buckets,
and each bucket is settled by itself, on whole shingle sets: first every member
against the bucket's least one, then, where the members still lie in several
components, all pairs of different components.  A band shared by texts under 0.8
thus costs a comparison and joins nothing.  A bucket with more than
``RUN_SHINGLES`` shingles is dealt into runs, and each pair of runs is searched as
a group of its own: nothing is left out.

Defined results: words are what white space parts, A-Z lower-cased; a text of
fewer than five words is one shingle; null text is empty text; equal shingle sets
are one entry.  Of a group one text stays, that of the smallest doc_id; rows
without an id take part and stay only if no row of their group has one.  Rows are
told apart by id and text, so a repeated doc_id never takes another text along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, whole_text
from millrace.llm.simhash_dedup import fingerprint, index_links, star_roots

SEED = 42
SHINGLE = 5
BANDS = 32
BAND_VALUES = 5
CHUNK = 256  # shingles under all permutations at once
NEAR, NEAR_OF = 4, 5  # links have NEAR_OF * common >= NEAR * united
RUN_SHINGLES = 1 << 19
WANTED_ROW_BYTES = 120  # a digest and a set's id in a broadcast
GONE_ROW_BYTES = 100  # an id and a digest in a broadcast

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * BAND_VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, BANDS * BAND_VALUES, np.uint64)
_MIX = _RNG.integers(0, 1 << 63, (BANDS, BAND_VALUES), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str) -> np.ndarray:
    """The distinct hashes of all five-word shingles, ascending."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width, digest = min(SHINGLE, len(words)), xxhash.xxh64_intdigest
    spans = (b" ".join(words[i : i + width]) for i in range(len(words) - width + 1))
    return np.unique(np.fromiter((digest(s, SEED) for s in spans), np.uint64))


def band_keys(s: np.ndarray) -> np.ndarray:
    """One key per MinHash band of a shingle set; none of an empty set."""
    if not len(s):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * BAND_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), CHUNK):
        np.minimum(least, (s[i : i + CHUNK, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    mixed = least ^ (least >> np.uint64(29))
    return (mixed.reshape(BANDS, BAND_VALUES) * _MIX).sum(axis=1, dtype=np.uint64).view(np.int64)


def node_id(s: np.ndarray) -> bytes:
    """128 bits that stand for a shingle set."""
    return xxhash.xxh3_128_digest(s.tobytes(), SEED)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t) for t in b.column("text").to_pylist()]
        columns = [
            b.column("doc_id"),
            b.column("sha"),
            pa.array([node_id(s) for s in sets], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
            pa.array(np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "node", "n", "bands", "fp"])


def text_digest(docs: DataFrame, text_col: str = "text") -> Column:
    """SHA-256 of the whole text."""
    return F.unhex(F.sha2(whole_text(docs, text_col), 256))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, sha of the text, node (its shingle set), n shingles, bands, fp (operator 2's fingerprint)."""
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        text_digest(docs, text_col).alias("sha"),
        whole_text(docs, text_col).alias("text"),
    )
    schema = "doc_id BIGINT, sha BINARY, node BINARY, n BIGINT, bands ARRAY<BIGINT>, fp BIGINT"
    return rows.mapInArrow(_sketch_batches, schema)


def index_entries(rows: DataFrame) -> DataFrame:
    """(node, n, bands, sha, fp): one entry per shingle set that is not empty, with one text that has it."""
    held = rows.where("n > 0").groupBy("node")
    text = F.min(F.struct("sha", "fp"))
    entries = held.agg(F.first("n").alias("n"), F.first("bands").alias("bands"), text.alias("text"))
    return entries.select("node", "n", "bands", "text.sha", "text.fp")


def fingerprint_pairs(entries: DataFrame) -> DataFrame:
    """(u, v), u > v: sets whose fingerprints operator 2 links, where their sizes allow 0.8.

    Each set meets the least set of its own fingerprint and of the smaller ones its
    fingerprint has links to, which are few for each: their number grows with the sets.
    """
    least = entries.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("least"))
    least = keep_table(least.select("fp", F.col("least.node").alias("first"), F.col("least.n").alias("first_n")), "near-fingerprints")
    links = keep_table(index_links(least.select("fp")), "near-fingerprint-links")
    # From the larger fingerprint only: the smallest of a large group is met by all others.
    smaller = links.select(F.col("u").alias("fp"), F.col("v").alias("to")).join(least.withColumnRenamed("fp", "to"), "to")
    met = smaller.select("fp", "first", "first_n").unionByName(least)
    held = entries.select("node", "n", "fp").join(met, "fp")
    fits = NEAR_OF * F.least("n", "first_n") >= NEAR * F.greatest("n", "first_n")
    pairs = held.where((F.col("node") != F.col("first")) & fits)
    return pairs.select(F.greatest("node", "first").alias("u"), F.least("node", "first").alias("v")).distinct()


def bucket_members(entries: DataFrame) -> DataFrame:
    """(band, node, n, first, first_n): the sets of each band value that two or more share, and the least of them."""
    each = entries.select(F.explode("bands").alias("band"), "node", "n")
    least = each.groupBy("band").agg(F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("top"))
    shared = least.where("least.node < top").select("band", F.col("least.node").alias("first"), F.col("least.n").alias("first_n"))
    return each.join(keep_table(shared, "near-shared"), "band")


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t).view(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def whole_sets(docs: DataFrame, wanted: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, shingles) of the entries in ``wanted`` (node, sha), each from one of its texts."""
    wanted = if_small(wanted, wanted.count(), WANTED_ROW_BYTES)
    texts = docs.select(text_digest(docs, text_col).alias("sha"), whole_text(docs, text_col).alias("text"))
    sets = texts.join(wanted, "sha").select("node", "text").mapInArrow(_set_batches, "node BINARY, shingles ARRAY<BIGINT>")
    # Equal texts of a set come once each.
    return keep_table(sets, "near-texts").groupBy("node").agg(F.first("shingles").alias("shingles"))


def candidate_pairs(members: DataFrame) -> DataFrame:
    """(u, v), u > v: each member with the least of its bucket, where their sizes allow 0.8.

    At most one pair per member, so their number grows with the members.
    """
    fits = NEAR_OF * F.least("n", "first_n") >= NEAR * F.greatest("n", "first_n")
    return members.where((F.col("node") > F.col("first")) & fits).select(F.col("node").alias("u"), F.col("first").alias("v")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets have a similarity of 0.8 or more."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b")).cast("bigint")
    united = F.size("a").cast("bigint") + F.size("b") - common
    return pairs.join(left, "u").join(right, "v").where(NEAR_OF * common >= NEAR * united).select("u", "v")


def unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, node, n, root) of the buckets of three and more whose members lie in several components.

    Buckets with the same members are one.
    """
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    rooted = members.select("band", "node", "n").join(named, "node", "left")
    rooted = keep_table(rooted.withColumn("root", F.coalesce("root", "node")), "near-rooted")
    facts = rooted.groupBy("band").agg(
        (F.min("root") < F.max("root")).alias("several"),
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.bit_xor(F.xxhash64("node", F.lit(SEED))).alias("second_mark"),
    )
    once = facts.where("several AND size > 2").groupBy("size", "mark", "second_mark").agg(F.min("band").alias("band"))
    return rooted.join(keep_table(once.select("band"), "near-unsettled"), "band")


def similar_places(sets: list[np.ndarray], root: np.ndarray, asks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each asking set, the places of the sets of other roots with a similarity of 0.8 or more.

    A similar set holds four fifths of the asking set's shingles, and so one of the
    fifth that is rarest here: only the sets that hold one of those are compared.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(code, kind="stable")]
    held = np.bincount(code)
    stop, end = np.cumsum(held), np.cumsum(size)
    own = [code[e - k : e] for e, k in zip(end, size)]
    for i in np.flatnonzero(asks):
        by_rarity = own[i][np.argsort(held[own[i]], kind="stable")]
        rare = by_rarity[: size[i] - -(-NEAR * size[i] // NEAR_OF) + 1]
        near = np.unique(np.concatenate([holder[stop[c] - held[c] : stop[c]] for c in rare]))
        near = near[root[near] != root[i]]
        near = near[NEAR_OF * np.minimum(size[near], size[i]) >= NEAR * np.maximum(size[near], size[i])]
        common = np.array([len(np.intersect1d(own[i], own[j], assume_unique=True)) for j in near], np.int64)
        near = near[NEAR_OF * common >= NEAR * (size[i] + size[near] - common)]
        if len(near):
            yield i, near


def _run_pair(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join the components of one run, or of two; of all links only a forest."""
    node, run = rows["node"].tolist(), rows["run"].to_numpy()
    root, _ = pd.factorize(rows["root"])
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in rows["shingles"]]
    # Inside a component nothing is left to find, so its largest one need not ask.
    asks = root != np.bincount(root).argmax()
    first = run == run.min()
    if rows["lo"].iloc[0] != rows["hi"].iloc[0] and first.sum() < asks.sum():
        asks = first  # pairs inside the first run are settled in a group of its own
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    for i, near in similar_places(sets, root, asks):
        for j in near:
            a, b = top(int(root[i])), top(int(root[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((max(node[i], node[j]), min(node[i], node[j])))
    return pd.DataFrame(links, columns=["u", "v"], dtype=object)


def bucket_links(held: DataFrame, sets: DataFrame, run_shingles: int = RUN_SHINGLES) -> DataFrame:
    """Links between the components of each unsettled bucket, every pair of them searched."""
    sizes = held.groupBy("band").agg(F.sum("n").alias("shingles"))
    dealt = (
        held.join(sizes, "band")
        .withColumn("runs", F.ceil(F.col("shingles") / F.lit(run_shingles)).cast("int"))
        .withColumn("run", F.pmod(F.xxhash64("node"), F.col("runs")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
        .select("band", "node", "root", "run", F.least("run", "other").alias("lo"), F.greatest("run", "other").alias("hi"))
    )
    return dealt.join(sets, "node").groupBy("band", "lo", "hi").applyInPandas(_run_pair, "u BINARY, v BINARY").distinct()


def similar_roots(docs: DataFrame, rows: DataFrame, text_col: str = "text", run_shingles: int = RUN_SHINGLES) -> DataFrame:
    """(u, v): nodes that are not the least of their group, and the least; ``rows`` are the sketches of ``docs``."""
    entries = keep_table(index_entries(rows), "near-entries")
    members = keep_table(bucket_members(entries), "near-members")
    linked = keep_table(fingerprint_pairs(entries), "near-linked")
    ends = linked.select(F.explode(F.array("u", "v")).alias("node")).unionByName(members.select("node"))
    wanted = entries.select("node", "sha").join(ends.distinct(), "node", "left_semi")
    sets = keep_table(whole_sets(docs, keep_table(wanted, "near-wanted"), text_col), "near-sets")
    pairs = keep_table(linked.unionByName(candidate_pairs(members)).distinct(), "near-pairs")
    roots = star_roots(confirmed(pairs, sets))
    late = keep_table(bucket_links(unsettled(members, roots), sets, run_shingles), "near-late")
    return star_roots(roots.unionByName(late))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_shingles: int = RUN_SHINGLES) -> DataFrame:
    """The rows of ``docs`` that are not near copies of a row with a smaller doc_id, with all columns."""
    rows = keep_table(sketches(docs, id_col, text_col), "near-sketches")
    roots = similar_roots(docs, rows, text_col, run_shingles)
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")
    entries = rows.groupBy("node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows"))
    rooted = entries.join(named, "node", "left").select("node", "first", "rows", F.coalesce("root", "node").alias("root"))
    winners = rooted.groupBy("root").agg(F.min("first").alias("winner"), F.sum("rows").alias("all_rows")).where("all_rows > 1")
    verdicts = rows.join(rooted.join(winners, "root").select("node", "winner"), "node")
    stays = F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("sha") == F.col("winner.sha"))
    gone = keep_table(
        verdicts.where(~stays).select(F.col("doc_id").alias("_gone_id"), F.col("sha").alias("_gone_sha")).distinct(),
        "near-copies",
    )
    gone = if_small(gone, gone.count(), GONE_ROW_BYTES)
    same = docs[id_col].cast("bigint").eqNullSafe(gone["_gone_id"]) & (text_digest(docs, text_col) == gone["_gone_sha"])
    return docs.join(gone, same, "left_anti")
