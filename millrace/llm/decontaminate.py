"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only.

Every item is cut into windows (13 words; a shorter item is one window).  A window
can only occur where all its word shingles occur, so one shingle of it is enough
to find every place: shingles are ordered by rarity among the windows, and each
window joins by its rarest one (its necessary prefix).  Shingles have five words,
or as many as a shorter window has.  A join match fixes the window's position, the
length bound drops places where the window would reach over an end of the
document, and the words are compared one by one.

Windows that fit a broadcast are met in one pass over the documents, and one row per
document leaves the task.  More windows are met by shuffled numbers (``_hits_by_text``):
same rows.  Neither way do long documents, passages shared by many documents or
documents without a hit gather in one task.

Defined results: null text has no words; items without words are no windows; an
item listed twice counts once; repeated documents give repeated rows; a null
doc_id stays null; empty tables give no rows (documents) or no hits (benchmark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import if_small, keep_table, lower_ascii
from millrace.sizing import BROADCAST_BYTES, limit_bytes

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 5
PLACES = "array<struct<d_width:int,at:int,d_h:bigint>>"
WINDOW_ROW_BYTES = 600  # 13 words, an item id and numbers in a broadcast
FILTER_BITS = 1 << 23


def words_of(text: Column) -> Column:
    """Words of ``text`` after lower-casing A-Z; null has none."""
    lowered = lower_ascii(F.coalesce(text.cast("string"), F.lit("")))
    return F.filter(F.split(lowered, BETWEEN_WORDS), lambda w: w != "")


def _shingle_hash(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(words, at + i) for i in range(width)])


def _shingles(words: Column, width: int, at_name: str, hash_name: str, *first: Column) -> Column:
    """Place and hash of every ``width``-word shingle of ``words`` (at least ``width`` long)."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.struct(*first, i.alias(at_name), _shingle_hash(words, i, width).alias(hash_name)),
    )


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, words): every window of every item."""
    items = benchmark.select(
        benchmark[item_col].cast("string").alias("item"), words_of(benchmark[text_col]).alias("w")
    ).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - WINDOW, F.lit(0))
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(F.col("w"), i + 1, WINDOW))
    return items.select("item", F.explode(starts).alias("window")).distinct()


def rarest_shingles(windows: DataFrame) -> DataFrame:
    """(item, window, width, offset, h): each window with its rarest shingle.

    Rarity is the number of windows that hold the shingle; equal rarity is settled
    by the hash, so neighbouring windows tend to agree on one shingle.
    """
    size = F.size("window")
    width = F.least(size, F.lit(SHINGLE))
    hashes = None
    for n in range(1, SHINGLE + 1):
        every = _shingles(F.col("window"), n, "offset", "h")
        hashes = F.when(width == n, every) if hashes is None else hashes.when(width == n, every)
    each = windows.select("item", "window", width.alias("width"), F.explode(hashes).alias("s")).select(
        "item", "window", "width", "s.offset", "s.h"
    )
    counts = each.groupBy("h").agg(F.count(F.lit(1)).alias("held_by"))
    best = F.min_by(F.struct("offset", "h"), F.struct("held_by", "h", "offset"))
    return (
        each.join(counts, "h")
        .groupBy("item", "window", "width")
        .agg(best.alias("best"))
        .select("item", "window", "width", "best.offset", "best.h")
    )


def _places(widths: list[int]) -> Column:
    """Place and hash of every shingle of the given widths in the words ``w``."""
    places = F.array().cast(PLACES)
    for n in widths:
        found = _shingles(F.col("w"), n, "at", "d_h", F.lit(n).alias("d_width"))
        places = F.concat(places, F.when(F.size("w") >= n, found).otherwise(F.array().cast(PLACES)))
    return places


def _hits_in_one_pass(words: DataFrame, anchors: DataFrame, places: Column) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row, where the windows may be broadcast.

    A row carries its words past the generator of its places, so nothing but hits is shuffled.
    """
    # a document's own row, which every document has, matches this marker
    marker = words.sparkSession.range(1).selectExpr(
        "CAST(NULL AS STRING) AS item", "CAST(NULL AS ARRAY<STRING>) AS window", "0 AS width", "0 AS offset", "0L AS h"
    )
    anchors = F.broadcast(anchors.unionByName(marker))
    own = F.array(F.struct(F.lit(0).alias("d_width"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("d_h")))
    rows = words.withColumn("row", F.monotonically_increasing_id())
    spots = rows.select("doc_id", "row", "w", F.explode(F.concat(own, places)).alias("p")).select(
        "doc_id", "row", "w", "p.d_width", "p.at", "p.d_h"
    )
    begin = F.col("at") - F.col("offset")
    fits = (begin >= 0) & (begin + F.size("window") <= F.size("w"))
    same = F.when(F.col("width") == 0, True).otherwise(
        fits & (F.slice(F.col("w"), F.greatest(begin, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    )
    hits = spots.join(anchors, (F.col("d_h") == F.col("h")) & (F.col("d_width") == F.col("width"))).where(same)
    span = F.when(F.col("width") > 0, F.struct(begin.alias("a"), (begin + F.size("window")).alias("b")))
    return (
        hits.select("doc_id", "row", F.size("w").cast("bigint").alias("n_words"), span.alias("span"), "item")
        .groupBy("row", "doc_id", "n_words")
        .agg(F.sort_array(F.collect_set("span")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    )


def _possible(spots: DataFrame, anchors: DataFrame) -> DataFrame:
    """The spots whose hash may be an anchor's: a table of ``FILTER_BITS`` bits, at most 131,072 rows of 64."""

    def slot(h: str) -> Column:
        return F.pmod(F.col(h), F.lit(FILTER_BITS))

    one = F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")
    bits = (
        anchors.select(slot("h").alias("slot"))
        .groupBy(F.floor(F.col("slot") / 64).alias("f_part"))
        .agg(F.bit_or(one).alias("f_bits"))
    )
    placed = spots.withColumn("slot", slot("d_h")).withColumn("part", F.floor(F.col("slot") / 64))
    held = placed.join(F.broadcast(bits), F.col("part") == F.col("f_part"))
    return held.where(F.col("f_bits").bitwiseAND(one) != 0).select(*spots.columns)


def _hits_by_text(words: DataFrame, anchors: DataFrame, places: Column) -> DataFrame:
    """The same where the windows are too many to broadcast.

    Words do not travel with places.  A bit table of fixed size drops nearly all places before the
    shuffle; what is left meets the anchors as numbers, under a digest of the words.  Only texts with
    such places come back with their words, cut to the windows in question and compared word by word.
    Texts without hits are added by a left join, so no row is a key that all share.
    """
    rows = words.withColumn("digest", F.sha2(F.concat_ws(" ", "w"), 256))
    spots = rows.select("digest", F.size("w").alias("n"), F.explode(places).alias("p")).select(
        "digest", "n", "p.d_width", "p.at", "p.d_h"
    )
    windows = anchors.select("item", "window", F.xxhash64("window").alias("wid"))
    numbers = anchors.select("width", "h", "offset", F.size("window").alias("long"), F.xxhash64("window").alias("wid")).distinct()
    begin = F.col("at") - F.col("offset")
    near = _possible(spots, anchors).join(numbers, (F.col("d_h") == F.col("h")) & (F.col("d_width") == F.col("width")))
    candidates = (
        near.where((begin >= 0) & (begin + F.col("long") <= F.col("n")))
        .groupBy(F.col("digest").alias("c_digest"))
        .agg(F.collect_set(F.struct(begin.alias("a"), "long", "wid")).alias("found"))
    )
    cut = F.transform(
        "found",
        lambda c: F.struct(c["a"].alias("a"), c["wid"].alias("c_wid"), F.slice(F.col("w"), c["a"] + 1, c["long"]).alias("cut")),
    )
    pulled = rows.join(candidates, F.col("digest") == F.col("c_digest")).select("digest", F.explode(cut).alias("c"))
    sure = pulled.select("digest", "c.*").distinct().join(windows, (F.col("c_wid") == F.col("wid")) & (F.col("cut") == F.col("window")))
    span = F.struct(F.col("a"), (F.col("a") + F.size("window")).alias("b"))
    per_text = sure.groupBy(F.col("digest").alias("t_digest")).agg(
        F.sort_array(F.collect_set(span)).alias("spans"), F.sort_array(F.collect_set("item")).alias("items")
    )
    every = rows.select("doc_id", F.size("w").cast("bigint").alias("n_words"), "digest")
    joined = every.join(per_text, F.col("digest") == F.col("t_digest"), "left")
    none = F.array()
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("spans", none.cast("array<struct<a:int,b:int>>")).alias("spans"),
        F.coalesce("items", none.cast("array<string>")).alias("items"),
    )


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    anchors = keep_table(rarest_shingles(item_windows(benchmark, item_col, item_text_col)), "benchmark-windows")
    facts = anchors.groupBy("width").count().collect()  # at most five rows
    n_windows = sum(r["count"] for r in facts)
    words = docs.select(docs[id_col].cast("bigint").alias("doc_id"), words_of(docs[text_col]).alias("w"))
    places = _places(sorted(r["width"] for r in facts))
    in_one_pass = (n_windows + 1) * WINDOW_ROW_BYTES <= limit_bytes(docs.sparkSession, BROADCAST_BYTES)
    per_row = (_hits_in_one_pass if in_one_pass else _hits_by_text)(words, anchors, places)
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            (acc["n"] + F.greatest(s["b"] - F.greatest(acc["end"], s["a"]), F.lit(0))).alias("n"),
        ),
    )["n"]
    n_hit = F.col("n_hit")
    return (
        per_row.withColumn("n_hit", covered)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
            "items",
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id no contaminated row has; rows without an id stay."""
    gone = keep_table(
        benchmark_hits(docs, benchmark, id_col, text_col)
        .where("contaminated AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_gone_id"))
        .distinct(),
        "contaminated",
    )
    gone = if_small(gone, gone.count(), 32)
    return docs.join(gone, docs[id_col].cast("bigint") == gone["_gone_id"], "left_anti")
