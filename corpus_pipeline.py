"""From raw documents to token files: language, near-duplicates, benchmarks, mix, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns a digest per document of the files it has written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparsemat.llm import decontaminate, langid, mixing, simhash, token_ids
from sparsemat.llm.catalog import IDS, table
from sparsemat.llm.common import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without a letter go."""
    return langid.known_only(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary files, and a digest of each document read back from them."""
    return token_ids.token_files(docs, public_tokenizers.path(IDS))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmarks", benchmarks),
    ("mix", mix),
    ("token_files", token_files),
]

#: SQL cannot express the language model, XXH64 and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
