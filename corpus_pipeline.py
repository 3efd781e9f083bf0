"""A training corpus from ``documents``: language, near-duplicates, personal data, source mixture, packed windows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churnlake.llm import language, mixing, near_dedup, packing, pii
from churnlake.llm.common import DOCUMENT_COLUMNS, table
from churnlake.session import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach.

    Null and empty texts and texts without a letter go. Repeated rows and rows without an id stay or go by their text.
    """
    return language.keep_known(docs, DOCUMENT_COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of least id, of each group of SimHash fingerprints within four bits, of four-word shingles.

    Of repeated rows one stays. Rows without an id all stay.
    """
    return near_dedup.keep_one(docs.select(*DOCUMENT_COLUMNS))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; null texts stay null, every row stays."""
    return pii.masked(docs, DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row per document and pass over its source.

    A null source is a source of its own. Texts without a word are not drawn; equal rows count once.
    """
    return mixing.mixed_documents(docs, DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in windows; a null text is empty and has its end token alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", known_language), ("near_duplicates", one_of_each), ("personal_data", without_personal_data),
          ("mixture", mixed), ("packing", packed)]

#: SQL cannot express the language model, the tokenizer or the mixture's permutations; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
