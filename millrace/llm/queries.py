"""The registered queries of this package and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from millrace.llm.collocations import collocations
from millrace.llm.decontaminate import benchmark_hits
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.licenses import license_scan
from millrace.llm.lm_scoring import lm_scores
from millrace.llm.minhash_dedup import minhash_groups
from millrace.llm.packing import pack_documents
from millrace.llm.quality import quality_scores
from millrace.llm.secrets import find_secrets
from millrace.llm.simhash_dedup import simhash_groups
from millrace.llm.spelling_variants import spelling_variants
from millrace.llm.token_counts import token_counts
from millrace.llm.token_files import read_token_files, write_token_files
from millrace.tables import Tables


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(Tables(spark, folder).documents)


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(Tables(spark, folder).documents)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(Tables(spark, folder).documents, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(Tables(spark, folder).documents).drop("found")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return read_token_files(write_token_files(Tables(spark, folder).documents, path, end_id=2))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(Tables(spark, folder).documents)


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(Tables(spark, folder).documents)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return quality_scores(t.documents, t.labels)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(Tables(spark, folder).documents, path, end_id=1, capacity=4096)


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return benchmark_hits(t.documents, t.benchmark).drop("items")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(Tables(spark, folder).documents)


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(Tables(spark, folder).documents)


def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_groups(Tables(spark, folder).documents)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_files": op5_token_files,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_license_scan": op7_license_scan,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op10_benchmark_decontamination": f"""
        WITH dw AS (
            SELECT doc_id, {_WORDS} AS w FROM documents
        ), bw AS (
            SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item, w[i + 1 : i + 13] AS win
            FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS i FROM bw WHERE len(w) > 0)
        ), sizes AS (
            SELECT DISTINCT len(win) AS n FROM windows
        ), places AS (
            SELECT doc_id, p, n, w[p + 1 : p + n] AS win
            FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM dw, sizes WHERE len(w) >= n)
        ), hits AS (
            SELECT doc_id, p, n, item FROM places JOIN windows USING (win)
        ), words AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
            FROM hits GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op13_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, w[i + 1 : i + 3] AS shingle
            FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 3, 0) + 1)) AS i FROM d WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (shingle)
            WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
            WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), reach(u, v) AS (
            SELECT doc_id, doc_id FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v
        ), least AS (
            SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
    """,
    "op12_phrase_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
        ), f AS (
            SELECT lang, k, w[i + 1 : i + k] AS p, count(*) AS f
            FROM (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM w, range(1, 5) AS ks(k) WHERE len(w) >= k)
            GROUP BY 1, 2, 3
        ), totals AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
        ), often AS (
            SELECT * FROM f WHERE f >= 30
        ), cuts AS (
            SELECT c.lang, c.k, c.p, c.f AS a, cut, x.f AS l, y.f AS r,
                   CAST((CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k >= 2) c
            JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : cut] JOIN f y ON y.lang = c.lang AND y.p = c.p[cut + 1 : c.k]
        ), low AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
        ), inside AS (
            SELECT lang, p[i + 1 : i + size] AS p, max(f) AS f
            FROM (SELECT *, unnest(range(0, k - size + 1)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM often WHERE k >= 3))
            GROUP BY 1, 2
        ), kept AS (
            SELECT low.*, array_to_string(low.p, ' ') AS phrase
            FROM low LEFT JOIN inside ON inside.lang = low.lang AND inside.p = low.p
            WHERE inside.f IS NULL OR CAST(inside.f AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """,
}
