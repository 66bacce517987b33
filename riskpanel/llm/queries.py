"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskpanel.llm.bpe import encoding_digests
from riskpanel.llm.collocations import top_phrases
from riskpanel.llm.common import table
from riskpanel.llm.language_gru import identify
from riskpanel.llm.lloyd import cluster_report
from riskpanel.llm.mixing import mix_sources
from riskpanel.llm.ngram_join import ngram_join
from riskpanel.llm.oracle import oracle_sql
from riskpanel.llm.quality_fm import score_quality
from riskpanel.llm.quality_rules import quality_rules
from riskpanel.llm.sharding import shard_documents
from riskpanel.llm.token_counts import count_tokens
from riskpanel.llm.topk_blocks import top_k
from riskpanel.llm.unit_dedup import repeated_units
from riskpanel.llm.url_reputation import judge_urls

__all__ = ["oracle_sql", "queries"]

VOCABULARY = "byte_bpe_50k.json"


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "seen")


def op2_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(table(spark, sf_dir, "documents"))


def op4_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_phrases(table(spark, sf_dir, "documents"))


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_url_reputation, op2_quality_machine, op3_line_dedup, op4_block_top_k, op5_ngram_join,
        op6_source_mixing, op7_bpe_round_trip, op8_token_counts, op9_jump_sharding, op10_quality_rules,
        op11_language_gru, op12_collocations, op13_sharded_lloyd,
    )
    return {query.__name__: query for query in registered}

