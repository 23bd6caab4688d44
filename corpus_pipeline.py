"""A training-corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import keep_table
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.exact_dedup import drop_exact_copies
from millrace.llm.packing import pack_documents
from millrace.llm.quality import drop_low_quality
from millrace.llm.shingle_dedup import drop_similar
from millrace.tables import Tables

CAPACITY = 4096
END_ID = 1
CACHE_PIECES = 1 << 17  # in a worker of the last stage: executors still hold what the others needed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return drop_low_quality(docs, Tables(spark, sf_dir).labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the one with the largest doc_id."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints or shared bands, and in fact by 0.8 or more of their
    five-word shingles, the one with the smallest doc_id."""
    return drop_similar(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of a twentieth of their words."""
    return drop_contaminated(docs, Tables(spark, sf_dir).benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY, cache_pieces=CACHE_PIECES)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

# Classifier, near-dedup and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
