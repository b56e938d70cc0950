"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.llm import (bpe, embed, exact, langid, linededup, negatives, pack, periodic, quality, shard, simhash,
                           toxicity, urls)
from alertlake.llm.common import table

#: The vocabulary file of BPE and packing.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return keep


@_query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@_query("op3_embedding_dedup", embed.ORACLE)
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), quality.trusted_ids(table(spark, sf_dir, "labels")))


@_query("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@_query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


@_query("op7_sharding", shard.oracle(shard.SHARD_BYTES))
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign_shards(table(spark, sf_dir, "documents"))


@_query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicate_lines(table(spark, sf_dir, "documents"))


@_query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@_query("op10_url_filter", urls.oracle())
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@_query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find_runs(periodic.planted(table(spark, sf_dir, "documents"))))


@_query("op13_hard_negatives", negatives.ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)
