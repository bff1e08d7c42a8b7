"""From raw documents to token ids: five stages, each over all that the one before kept.

Each stage's rows are written as Parquet and read back as the next one's documents. Stages but the last keep all columns, whatever
their names; repeated rows are rows like others; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hitledger.llm import bpe, common, exact_dedup, language, mixing, ngram_join, queries


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are in no learned language go; mixtures of learned languages stay. Null and empty texts, and those without letters, go."""
    return language.keep_languages(docs, queries.train_languages(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays; null ids are smaller than any. Of wholly repeated rows one stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays; null ids come last. Texts without words are in no group."""
    return ngram_join.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix; a document of a source taken twice gives two rows. A null source or language is one of its own."""
    return mixing.select_mix(docs, queries.MIX).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (16 bits each, low byte first), ``decoded_sha256``."""
    return bpe.encode_binary(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Language identification and encoding have no form in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
