"""From raw documents to training tokens, in five written stages.

1. toxicity: documents scored at the threshold or above go;
2. exact dedup: one row of each group of equal texts stays;
3. n-gram Jaccard join: the smallest id of each group of near copies stays;
4. source mixing: documents are taken as often as the target weights say;
5. byte-level BPE: token ids of every row, checked by decoding.

Every stage gets what the one before kept, reread from Parquet; all but the
last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import byte_bpe, exact_dedup, ngram_join, source_mixing, toxicity
from ledgerlens.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return source_mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return byte_bpe.training_rows(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

# SQL expresses neither the learned scores nor the merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
