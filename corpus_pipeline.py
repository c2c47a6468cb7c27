"""From raw documents to training sequences: language, line dedup, near-duplicates, packing.

Each stage reads the table that its predecessor wrote. All stages but the last return the columns
of `documents`; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language
from tidemark.llm.line_runs import drop_common_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.shared import written
from tidemark.llm.simhash import one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled rows teach. Null and empty texts and
    those without a letter are in none and go; where no row has a language, only these go;
    repeated rows are judged each; all columns stay."""
    models = language.fit(docs, docs["lang"].isNotNull())
    return language.without_rejected(docs, models)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten documents or more. Null texts become empty, and so
    does a text that only has such lines; no row goes; repeated rows count as documents each; all
    columns stay."""
    return drop_common_lines(docs).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, ties by text and the
    other columns; a row without an id only where its whole group has none. Texts without words
    are one group. Rows that repeat an id with other texts stay, each for its group."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens. A null or empty text is one
    piece with the end id alone; repeated rows are packed each; an empty table gives no pieces."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("packing", packing)]

# The fingerprints' XXH64, the trained language models and the tokenizer are not in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
