"""A training corpus from ``documents``: language ID, quality, exact and near duplicates, packing.

Every stage takes what its predecessor kept, reread from Parquet.  All but the last return rows
of ``documents`` with its columns; the last returns the packed pieces of the texts that stayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alertlake.llm import exact, langid, pack, quality, simhash
from alertlake.llm.common import save, table
from alertlake.llm.queries import TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised and not rejected."""
    return langid.keep_identified(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no more perplexing than trusted text of their language."""
    return quality.keep_good(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints, the document with the smallest id."""
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences of 2048 tokens."""
    return pack.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Language models, fingerprints and a tokenizer have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each writes a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
    return docs
