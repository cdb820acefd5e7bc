"""From raw documents to token ids: clean, deduplicate, drop near copies, mix sources, encode.

Each stage is ``(spark, docs, folder) -> DataFrame`` and works on all its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.llm import bpe, digests, mixing, ngram_join, quality
from tamarind.session import freeze
from tamarind.sources.tables import read_table


#: Sources are mixed by their size to this power.
MIX_POWER = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out lines that fail a rule; documents that fail the base rules or lose too much text go."""
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return digests.without_duplicates(docs, digests.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.8 or more, the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that gives each source its target weight (the square root of its size)."""
    return mixing.in_mix_order(docs, power=MIX_POWER)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, with each document's place in the mix.

    The place is that in the files which the stage before has left. Deduplication has left one row for an id and a text.
    """
    tokens = bpe.document_tokens(docs)
    places = mixing.stored_places(docs).withColumnRenamed("doc_id", "_id")
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("decoded_sha256") == F.col("text_sha256"))
    return tokens.join(places, met).select(*tokens.columns, "mix_place")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("source mixing", source_mixing),
    ("byte-level BPE", byte_bpe),
]

#: SQL can't express the merges of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; what a stage returns is written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = freeze(docs, f"stage{place + 1}")
    return docs
