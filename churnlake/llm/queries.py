"""Queries of the operators of this package, each over its whole table, and the oracle SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from churnlake.llm import (ball_search, block_search, language, mixing, near_dedup, packing, pii, prefix_trie, quality_rules, quote_chat,
                           suffix_dedup, url_filter, winnowing)
from churnlake.llm.common import table


RULES = [url_filter.Rule("allow", "com/"), url_filter.Rule("block", "example.com/en/"), url_filter.Rule("allow", "www.example.com/en/"),
         url_filter.Rule("block", "net/es/"), url_filter.Rule("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats at least 100 bytes of an earlier text, in all documents."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op4_quote_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return quote_chat.reply_ordered(table(spark, sf_dir, "conversations"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes."""
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised, in windows."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return winnowing.compare_edited(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digest(pii.find_spans(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op10_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector among all others."""
    return block_search.nearest(table(spark, sf_dir, "embeddings"), lambda id_: id_ % 50 == 0)


def op11_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of highest score for every benchmark item."""
    return ball_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdict of all documents."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all conversations share at their beginning."""
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_simhash_near_dedup, op3_suffix_dedup, op4_quote_chat, op5_mixing, op6_packing, op7_winnowing,
                                  op8_pii, op9_language_id, op10_block_search, op11_ball_search, op12_quality_rules, op13_prefix_trie)}
ORACLE: dict[str, str] = {"op10_block_search": block_search.NEAREST_SQL, "op11_ball_search": ball_search.RANK_SQL,
                          "op12_quality_rules": quality_rules.JUDGE_SQL, "op13_prefix_trie": prefix_trie.TRIE_SQL}
