"""Queries of this package by name: ``(spark, folder) -> DataFrame``. Each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarind.llm import (
    bpe, chat, digests, fill_in_middle, line_dedup, lm_scoring, mixing, ngram_join, personal, quality, sharding, turn_trie,
    urls,
)
from tamarind.sources.tables import read_table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.document_quality(read_table(spark, folder, "documents"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digests.document_duplicates(spark, read_table(spark, folder, "documents"))


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.with_planted(read_table(spark, folder, "conversations"))
    return chat.read_back(chat.transcripts(chat.format_turns(rows)))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.document_personal(read_table(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.document_tokens(read_table(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.document_shards(read_table(spark, folder, "documents"))


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.document_mix(read_table(spark, folder, "documents"))


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    return urls.judge_pages(pages, urls.listed_urls(pages))


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(read_table(spark, folder, "documents"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.document_lines(read_table(spark, folder, "documents"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.document_fim(read_table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.conversation_trie(read_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_lm_scoring,
        op3_exact_dedup,
        op4_chat_formatting,
        op5_personal_data,
        op6_byte_bpe,
        op7_sharding,
        op8_source_mixing,
        op9_url_filters,
        op10_ngram_jaccard_join,
        op11_line_dedup,
        op12_fill_in_middle,
        op13_prefix_trie,
    )
}
