"""From raw documents to token ids: every stage works on all that the one before has kept.

The stages but the last return the columns of ``documents``. Each result is written as Parquet and read
again, so that a lost executor never costs more than a stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fraudtide.llm import bpe, langid, linedup, mixing, sigtree
from fraudtide.llm.tables import materialised, read_table

VOCABULARY = "byte_bpe_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, with that language; the others go."""
    return langid.in_a_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier one."""
    return linedup.without_repeats(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its runs of five words."""
    return sigtree.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources asks."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document of the mix."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Trained languages decide the first stage's rows, so no SQL can state the last one's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
