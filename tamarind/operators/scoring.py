"""Sentiment classes of comments: 0 negative, 1 positive, 2 neutral or not decidable.

The default scorer is a naive Bayes model over words: counts per (word, class), one aggregation. A class is scored by a sum
over the words of a text, so both training and scoring are joins and sums of linear cost, and texts of any length count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.text import clean_comment
from tamarind.functions.vectors import argmax
from tamarind.session import freeze

# Order of the classes.
NEGATIVE, POSITIVE, NEUTRAL = 0, 1, 2
CLASSES = (NEGATIVE, POSITIVE, NEUTRAL)

#: Words that are one in this many or more of all training words are looked up where the comments lie; no more than this
#: many words can be.
COMMON = 1 << 16


class Scorer(Protocol):
    """Turns texts into one row of (negative, positive, neutral) weights each."""

    def __call__(self, texts: list[str]) -> np.ndarray: ...


@dataclass
class CommentModel:
    """``words``: word, its log weight in each class (``w0 w1 w2``) and its count ``n``, ``total`` in all. ``priors``: log
    weight of each class."""

    words: DataFrame
    priors: tuple[float, float, float]
    total: int


def _words(text: str) -> Column:
    return F.split(clean_comment(F.col(text)), " ")


def train_comment_model(labelled: DataFrame, text: str = "text", label: str = "label", alpha: float = 1.0) -> CommentModel:
    """Word weights ``ln((count + alpha) / (words of the class + alpha * vocabulary))`` from labelled comments.

    Missing texts and labels are left out. Counts are frozen, so later steps do not clean the comments again.
    """
    # Nulls go before the cleaning: a condition on the clean words would clean every comment once more.
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).na.drop()
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r.label in CLASSES}
    counts = freeze(
        rows.select("label", F.explode(_words("text")).alias("word"))
        .filter("word <> ''")
        .groupBy("word")
        .agg(*[F.count(F.when(F.col("label") == c, 1)).alias(f"n{c}") for c in CLASSES]),
        "comment-words",
    )
    *totals, vocabulary = counts.agg(*[F.coalesce(F.sum(f"n{c}"), F.lit(0)) for c in CLASSES], F.count(F.lit(1))).first()
    weights = [
        F.log((F.col(f"n{c}") + alpha) / (totals[c] + alpha * max(1, vocabulary))).alias(f"w{c}") for c in CLASSES
    ]
    every = sum(sizes.values())
    priors = tuple(math.log((sizes.get(c, 0) + alpha) / (every + alpha * len(CLASSES))) for c in CLASSES)
    n = sum(F.col(f"n{c}") for c in CLASSES).alias("n")
    return CommentModel(counts.select("word", *weights, n), priors, sum(totals))


def class_weights(df: DataFrame, model: CommentModel, key: str, text: str = "text") -> DataFrame:
    """``key, weights``: log weight of each class for every comment that holds a word the model knows.

    Common words meet the model where the comments lie and become one row a comment before anything is shuffled. Other
    words are counted inside a comment and joined; none of them is a hot key of the model. Comments with one ``key`` count
    as one.
    """
    # ``COMMON`` words at most, by their share.
    common = model.words.filter(F.col("n") * COMMON >= model.total).select(
        F.col("word").alias("_common"), *[F.col(f"w{c}").alias(f"_w{c}") for c in CLASSES]
    )
    said = df.select(F.col(key).alias("_key"), F.explode(_words(text)).alias("_said"))
    met = said.join(F.broadcast(common), F.col("_said") == F.col("_common"), "left")
    # No word starts with a blank: the row of a comment's common words meets nothing, and such rows are spread.
    alone = F.concat(F.lit(" "), F.xxhash64("_key").cast("string"))
    counted = met.groupBy("_key", F.when(F.col("_common").isNull(), F.col("_said")).otherwise(alone).alias("word")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_w{c}").alias(f"_w{c}") for c in CLASSES]
    )
    summed = counted.join(model.words, "word", "left").groupBy("_key").agg(
        *[(F.sum(F.coalesce(F.col(f"_w{c}"), F.col("_n") * F.col(f"w{c}"))) + F.lit(model.priors[c])).alias(f"w{c}") for c in CLASSES]
    )
    return summed.filter(F.col("w0").isNotNull()).select(F.col("_key").alias(key), F.array(*[f"w{c}" for c in CLASSES]).alias("weights"))


def score_with_model(
    df: DataFrame, model: CommentModel, key: str, text: str = "text", name: str = "sentiment"
) -> DataFrame:
    """Class of each comment by a trained model; the lower class wins a tie. Comments without a known word are neutral."""
    weights = class_weights(df, model, key, text).withColumnRenamed(key, "_scored")
    # Sums of the same terms in another order differ in the last digits; rounding keeps ties ties.
    rounded = F.transform("weights", lambda w: F.round(w, 6))
    return df.join(weights, F.col(key) == F.col("_scored"), "left").withColumn(
        name, F.coalesce(argmax(rounded), F.lit(NEUTRAL))
    ).select(*df.columns, name)


def score_with(
    df: DataFrame,
    load: Callable[[], Scorer],
    text: str = "text",
    name: str = "sentiment",
    max_tokens: int | None = None,
) -> DataFrame:
    """Class of each comment by any scorer. ``load`` runs once per task; texts arrive in Arrow batches.

    The guards run as column expressions, so missing and empty text never reaches the scorer and is neutral. A scorer that
    can't take long text says so by ``max_tokens``; longer texts are neutral then. By default there is no limit.
    """

    @F.pandas_udf("array<double>")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for batch in batches:
            texts = batch.dropna()
            weights = iter(scorer(texts.tolist()) if len(texts) else ())
            yield pd.Series([[float(w) for w in next(weights)] if known else None for known in batch.notna()], dtype=object)

    clean = clean_comment(F.col(text))
    scorable = clean != ""
    if max_tokens is not None:
        scorable &= F.size(F.split(clean, " ")) <= max_tokens
    return (
        df.withColumn("_weights", weigh(F.when(scorable, clean)))
        .withColumn(name, F.coalesce(argmax(F.col("_weights")), F.lit(NEUTRAL)))
        .drop("_weights")
    )


def word_list_scorer(negative: set[str], positive: set[str]) -> Callable[[], Scorer]:
    """A scorer that counts listed words; half a point for neutral, so one listed word decides."""

    def load() -> Scorer:
        def score(texts: list[str]) -> np.ndarray:
            rows = [t.split(" ") for t in texts]
            return np.array([[sum(w in negative for w in r), sum(w in positive for w in r), 0.5] for r in rows])

        return score

    return load
