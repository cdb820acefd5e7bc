"""Fill-in-middle transformation of whole texts.

A text is a run of units: blanks with the word after them, or blanks at its end. One full match of ``(unit)*`` keeps the
capture of every repetition, so the ends of the captures give the number of units and both cut offsets at once. Only the
match runs in Python, on Arrow batches; texts are cut, joined and restored by column expressions.
"""

from __future__ import annotations

import sys

import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.texts import let

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 texts, so many are transformed; of 100 transformed ones, so many have the suffix first.
FIM_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80

#: The two kinds of units exclude each other at every place, so nothing has to be kept for going back.
UNITS = r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+"


def cut_offsets(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and the ends of the first ``first % (n + 1)`` and ``second % (n + 1)`` units, smaller one first."""
    ends = regex.fullmatch(UNITS, text).ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def _cut(texts: pd.Series, firsts: pd.Series, seconds: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [cut_offsets(*row) for row in zip(texts, firsts, seconds)], columns=["n", "low", "high"], dtype="int64"
    )


def _draws(key: Column, seed: int) -> list[Column]:
    """Four repeatable numbers of 32 bits for a key; a missing key counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    rows: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` of each row.

    ``n`` units; ``form`` is ``plain`` (the text as it is), ``psm`` or ``spm`` (parts in that order, each behind its marker).
    What is drawn hangs on the id and the seed alone, so repeated ids are drawn alike and a missing id like an empty one.
    Null texts count as empty. Empty texts and texts that hold a marker stay plain, so markers in an output are always the
    inserted ones. Character counts are null where the form is plain. Other columns, whatever their names, are not read.
    An empty table gives no rows.
    """
    cut = F.pandas_udf(_cut, "n bigint, low bigint, high bigint")
    h1, h2, h3, h4 = _draws(F.col("_id"), seed)
    text = F.col("_text")
    picked = rows.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    placed = picked.withColumn("_cut", cut(text, h1, h2))
    plain = (text == "") | (h3 % 100 >= fim_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(text, F.lit(marker))
    formed = placed.withColumn(
        "form", F.when(plain, "plain").when(h4 % 100 < suffix_first_percent, "spm").otherwise("psm")
    )
    low, high = F.col("_cut.low").cast("int"), F.col("_cut.high").cast("int")
    prefix = F.concat(F.lit(PREFIX), F.substring(text, F.lit(1), low))
    middle = F.concat(F.lit(MIDDLE), F.substring(text, low + 1, high - low))
    suffix = F.concat(F.lit(SUFFIX), F.substring(text, high + 1, F.length(text) - high))
    transformed = F.col("form") != "plain"
    return formed.select(
        F.col("_id").alias(id_col),
        F.col("_cut.n").alias("n"),
        "form",
        F.when(transformed, F.col("_cut.low")).alias("prefix_chars"),
        F.when(transformed, F.col("_cut.high") - F.col("_cut.low")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(prefix, suffix, middle))
        .when(transformed, F.concat(suffix, prefix, middle))
        .otherwise(text)
        .alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text an output was made from, taken from the output and its form alone."""

    def joined(parts: Column) -> Column:
        # The first part is what stands before the first marker: nothing.
        return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(
            F.concat(parts[2], parts[3], parts[1])
        )

    return F.when(form == "plain", output).otherwise(let(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}"), joined))


def document_fim(documents: DataFrame) -> DataFrame:
    """All documents, transformed; outputs and restored texts as SHA-256 of their UTF-8."""
    made = fill_in_middle(documents)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
