"""Queries of the training-data operators, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe, exact_dedup, fill_in_middle, fingerprints, language_id, ngram_join, piece_tokens, pii, preferences, source_mixing,
    sql, token_counts, toxicity, whitening)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).drop("candidate")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_with_next(docs)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return source_mixing.mix_counts(docs).drop("copies")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preferences.swapped_answers(table(spark, sf_dir, "conversations"))
    return preferences.preference_pairs(chosen, rejected)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_tokens.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_exact_dedup, op2_fingerprints, op3_mixing, op4_token_counts, op5_pii, op6_language_id,
           op7_byte_bpe, op8_preferences, op9_toxicity, op10_ngram_join,
           op11_sentencepiece, op12_whitening, op13_fill_in_middle, pipeline)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
