"""SimHash near-dedup through a Gray-ordered hierarchical index.

Upper nodes factor out bits that fingerprints share: a node is a pattern under a
mask.  Two fingerprints that differ in at most three bits agree on one of four
16-bit bands, and then on one of four parts of the other 48 bits, so the nodes of
the top two levels (16 masks of 28 bits) that hold both have no difference so
far; all other node pairs are pruned unseen.  Below a top node the fingerprints
are sorted by Gray rank, where neighbours share long patterns: runs of them form
groups with a mask of shared bits, and pairs of groups whose shared patterns
already differ in more than three bits are pruned whole.  What is left is
compared bit by bit.

A top node yields a spanning forest of its links, never all pairs.  Components of
the forest are found by star contraction over tables in the shared folder.  A
node with more than ``NODE_LIMIT`` fingerprints is dealt into runs, and each pair
of runs is searched as a group of its own: nothing is left out.

Defined results: null text is empty text and has fingerprint zero; equal
fingerprints are one index entry; a null doc_id never names a component unless
all its ids are null; repeated rows get equal verdicts; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, whole_text

SEED = 42
SHINGLE = 3
MAX_BITS = 3
CHUNK = 1 << 16  # shingles hashed at once
NODE_LIMIT = 4096
GROUP = 64  # fingerprints of a lower node
GONE_ROW_BYTES = 32  # an id in a broadcast


# --- fingerprints -------------------------------------------------------------
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the hashes of all shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    width = min(shingle, len(words))
    first = begins[: len(words) - width + 1]
    last = (begins + sizes)[width - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(first), CHUNK):
        spans = zip(first[i : i + CHUNK].tolist(), last[i : i + CHUNK].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        fps = np.array([fingerprint(t) for t in b["text"]], np.uint64)
        yield pd.DataFrame({"row_id": b["row_id"], "fp": fps.view(np.int64)})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed BIGINT."""
    rows = docs.select(
        docs[id_col].cast("string").alias("row_id"), whole_text(docs, text_col).alias("text")
    )
    return rows.mapInPandas(_fingerprint_batches, "row_id STRING, fp BIGINT").select(
        F.col("row_id").cast("bigint").alias("doc_id"), "fp"
    )


# --- the index ----------------------------------------------------------------
def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray order (prefix parity of its bits)."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _gray_rank_column(fp: Column) -> Column:
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp


def top_masks() -> list[int]:
    """The 16 masks of the upper nodes, signed: a 16-bit band and a quarter of the rest."""
    masks = []
    for band in range(4):
        rest = [i for i in range(64) if i // 16 != band]
        for part in range(4):
            bits = [*range(16 * band, 16 * band + 16), *rest[12 * part : 12 * part + 12]]
            mask = sum(1 << i for i in bits)
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def upper_nodes(fps: DataFrame) -> DataFrame:
    """(mask, pattern, fp): the 16 upper nodes of every fingerprint."""
    nodes = [
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern"))
        for i, m in enumerate(top_masks())
    ]
    return fps.select("fp", F.explode(F.array(*nodes)).alias("node")).select("node.mask", "node.pattern", "fp")


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component under the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _group_patterns(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits all members of each lower node share, and those bits."""
    at = np.arange(0, len(fp), GROUP)
    both, either = np.bitwise_and.reduceat(fp, at), np.bitwise_or.reduceat(fp, at)
    return ~(both ^ either), both


def _search(left: np.ndarray, right: np.ndarray | None) -> np.ndarray:
    """Component root of every member of ``left`` followed by ``right``.

    Both are in Gray order.  Lower nodes are compared first by the bits all their
    members share; only pairs not yet too far apart are opened.
    """
    lm, lp = _group_patterns(left)
    rm, rp = (lm, lp) if right is None else _group_patterns(right)
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    n = len(left) + (0 if right is None else len(right))
    root, held_a, held_b, held = np.arange(n), [], [], 0
    for i in range(len(lm)):
        alive = np.flatnonzero(np.bitwise_count((lp[i] ^ rp) & lm[i] & rm) <= MAX_BITS)
        alive = alive[alive >= i] if right is None else alive
        at = (alive[:, None] * GROUP + np.arange(GROUP)[None, :]).reshape(-1)
        at = at[at < len(other)]
        near = np.bitwise_count(left[i * GROUP : (i + 1) * GROUP, None] ^ other[at][None, :]) <= MAX_BITS
        a, b = np.nonzero(near)
        held_a.append(a + i * GROUP)
        held_b.append(at[b] + shift)
        held += len(a)
        if held > 1 << 20 or i == len(lm) - 1:  # fold the links found so far into the forest
            grown = np.flatnonzero(root != np.arange(n))
            root = roots_of(
                n, np.concatenate([*held_a, grown]), np.concatenate([*held_b, root[grown]])
            )
            held_a, held_b, held = [], [], 0
    return root


def node_links(fp: np.ndarray, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Star links (u, v), u > v as signed numbers, of the components in a node or two runs of it."""
    root = _search(fp, right)
    every = (fp if right is None else np.concatenate([fp, right])).view(np.int64)
    smallest = np.full(len(every), np.iinfo(np.int64).max)
    np.minimum.at(smallest, root, every)
    v = smallest[root]
    apart = every != v
    return every[apart], v[apart]


def _node_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of whole nodes; rows come sorted by node, then Gray rank.

    Nodes of two, the common case, are handled for a whole batch at once; the
    last node of a batch waits for the rest of its rows.
    """

    def work(rows: pd.DataFrame, start: np.ndarray, size: np.ndarray) -> pd.DataFrame:
        fp = rows["fp"].to_numpy(np.int64)
        two = start[size == 2]
        a, b = fp[two], fp[two + 1]
        near = np.bitwise_count(a ^ b) <= MAX_BITS
        us, vs = [np.maximum(a, b)[near]], [np.minimum(a, b)[near]]
        for s, k in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            u, v = node_links(fp[s : s + k].view(np.uint64))
            us.append(u)
            vs.append(v)
        return pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    wait: pd.DataFrame | None = None
    for b in batches:
        if not len(b):
            continue
        rows = b if wait is None else pd.concat([wait, b], ignore_index=True)
        mask, pattern = rows["mask"].to_numpy(), rows["pattern"].to_numpy()
        cut = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        start = np.concatenate([[0], cut])
        wait = rows.iloc[start[-1] :]
        if len(cut):
            yield work(rows.iloc[: start[-1]], start[:-1], np.diff(start))
    if wait is not None:
        yield work(wait, np.array([0]), np.array([len(wait)]))


def _run_pair(rows: pd.DataFrame) -> pd.DataFrame:
    fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
    run = rows["run"].to_numpy()
    order = np.argsort(gray_rank(fp), kind="stable")
    fp, first = fp[order], (run == run.min())[order]
    u, v = node_links(fp) if first.all() else node_links(fp[first], fp[~first])
    return pd.DataFrame({"u": u, "v": v})


def index_links(fps: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (u, v), u > v, that join the components of ``fps`` (distinct fp)."""
    nodes, by = upper_nodes(fps), ["mask", "pattern"]
    sizes = nodes.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = nodes.join(sizes, by)
    usual = (
        shared.where(F.col("n") <= node_limit)
        .withColumn("gray", _gray_rank_column(F.col("fp")))
        .repartition(*by)
        .sortWithinPartitions(*by, F.shiftrightunsigned("gray", 1), "gray")
        .select(*by, "fp")
        .mapInPandas(_node_batches, "u BIGINT, v BIGINT")
    )
    runs = F.ceil(F.col("n") / F.lit(max(1, node_limit // 2))).cast("int")
    placed = (
        shared.where(F.col("n") > node_limit)
        .withColumn("runs", runs)
        .withColumn("run", F.pmod(F.xxhash64("fp"), F.col("runs")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
    )
    large = (
        placed.select(*by, "fp", "run", F.least("run", "other").alias("lo"), F.greatest("run", "other").alias("hi"))
        .groupBy(*by, "lo", "hi")
        .applyInPandas(_run_pair, "u BIGINT, v BIGINT")
    )
    return usual.unionByName(large).distinct()


# --- components ---------------------------------------------------------------
def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours.

    The least neighbours are a table of their own: a node with very many links then meets
    its one row through a join of two plain shuffles, which Spark splits where it is skewed.
    """
    both = links.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        links.select(F.col("v").alias("a"), F.col("u").alias("b"))
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = keep_table(least, "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the least of them."""
    least = keep_table(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    ends = F.explode(F.array(F.col("u"), F.col("v")))
    return (
        links.join(least, "u").select(ends.alias("w"), "m").where("w <> m")
        .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
    )


def star_roots(links: DataFrame) -> DataFrame:
    """(u, v): every node that is no smallest of its component, and that smallest node.

    Large and small stars in turn until nothing moves; each round is a table in
    the shared folder, and only its count and checksum reach the driver.
    """
    def mark(t: DataFrame):
        return tuple(t.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    links = keep_table(links, "links")
    before = mark(links)
    while before[0]:
        links = keep_table(_small_star(_large_star(links)), "links")
        after = mark(links)
        if after == before:
            break
        before = after
    return links


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id)."""
    rows = keep_table(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = keep_table(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = star_roots(index_links(distinct.select("fp")))
    named = distinct.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    linked = named.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    components = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = linked.join(components, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component; rows without an id stay."""
    gone = keep_table(
        simhash_groups(docs, id_col, text_col)
        .where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias("_gone_id"))
        .distinct(),
        "near-copies",
    )
    gone = if_small(gone, gone.count(), GONE_ROW_BYTES)
    return docs.join(gone, docs[id_col].cast("bigint") == gone["_gone_id"], "left_anti")
