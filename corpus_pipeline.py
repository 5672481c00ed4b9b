"""The corpus pipeline: its stages, and their run over ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quakeframe.llm import bpe, exact_dedup, language, mixing, near_dedup
from quakeframe.llm.common import stored, table

TOKENIZER = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is more likely than all others together."""
    return language.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the one with the smallest id."""
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: none to three times."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text that they decode to."""
    return bpe.tokenized(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", known_language), ("exact dedup", without_copies), ("near dedup", without_near_copies),
    ("mixing", mixed), ("tokens", tokens),
]
ORACLE_SQL = None  # code lengths, near copies, the mix and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
