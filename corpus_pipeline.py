"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

All stages take nulls in any column, empty and very long texts, repeated rows, extra columns and empty tables; what each makes
of them stands with it. All but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskpanel.llm.bpe import encoding_digests
from riskpanel.llm.common import stored, table
from riskpanel.llm.mixing import mix_documents
from riskpanel.llm.ngram_join import keep_first_of_each
from riskpanel.llm.quality_rules import keep_documents
from riskpanel.llm.unit_dedup import remove_repeats

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a proven cutoff rejects go; null and empty texts have too few words and go too."""
    return keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id, null ids last.

    Of rows that repeat an id and its text one stays. Texts without words are copies of nothing and stay.
    """
    return keep_first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier place holds are cut out of the texts.

    Every row stays: null and empty texts as they are, a text that loses all its words as an empty one. Equal rows
    lose the same words.
    """
    return remove_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source. Rows equal in id, text and source are taken together. Null and empty texts have no words and
    are taken as often as the whole copies of their source say.
    """
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of what they decode to; a null text is an empty one."""
    return encoding_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("BPE encoding and decoding", tokens),
]

#: SQL has no byte-pair encoding; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
