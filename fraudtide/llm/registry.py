"""The registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fraudtide.llm import bpe, chat, divergence, langid, linedup, mixing, nearvec, phrases, pii, secrets, sigtree, simhash, urlfilter
from fraudtide.llm.oracle import LLM_ORACLE
from fraudtide.llm.tables import read_table

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvec.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_report(read_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(read_table(spark, sf_dir, "conversations"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = sigtree.Grams(words=3, over=9, under=10)
    return sigtree.similar_documents(read_table(spark, sf_dir, "documents"), rules)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(read_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_report(read_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.verdicts(read_table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_near_vectors,
    op2_mix_sources,
    op3_byte_bpe,
    op4_chat_format,
    op5_ngram_join,
    op6_language_id,
    op7_secret_scan,
    op8_personal_data,
    op9_line_dedup,
    op10_simhash,
    op11_url_filter,
    op12_source_divergence,
    op13_collocations,
)
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in OPERATORS}
