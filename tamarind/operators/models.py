"""Model selection: cross-validated grids, accuracy, confusion, leaderboard.

Searches share their work: all folds and penalties of the linear models take their steps in common passes, and trees are
grown once for all depths and split minima.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.operators import linear, trees
from tamarind.operators.features import hash_bucket

# The grids that are searched by default.
LOGISTIC_C = (0.01, 0.1, 1.0)
SVM_C = tuple(10.0**e for e in (-3.0, -1.5, 0.0, 1.5, 3.0))
TREE_IMPURITY = ("gini", "entropy")
TREE_DEPTH = tuple(range(2, 20, 2))
TREE_LEAF = (1, 2, 4)
TREE_SPLIT = (2, 5, 10)
TREE_FEATURES = (trees.ALL, trees.SQRT)
FOLDS = 10
#: Rows in a partition of a search. A search on few rows is many short jobs; spread over many tasks they would mostly wait.
SEARCH_ROWS = 50_000


@dataclass(frozen=True)
class GridSearch:
    """Points of a grid, their mean accuracies over the folds, and the model of the best point fitted on all rows."""

    points: list[dict]
    avgMetrics: list[float]
    bestModel: linear.LinearModel | trees.TreeModel

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.points


def _best(scores: Sequence[float]) -> int:
    """The first of equal maxima."""
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


def _gathered(rows: DataFrame) -> DataFrame:
    return rows.coalesce(-(-rows.count() // SEARCH_ROWS) or 1)


def as_training_rows(df: DataFrame, key: str, vector: str, label: str, folds: int = FOLDS, seed: int = 2) -> DataFrame:
    """``features, label, fold``: the fold hangs on the key, so every run and every model sees the same folds."""
    return df.select(
        F.col(key),
        array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
        hash_bucket(F.col(key), seed + 1, folds).alias("fold"),
    )


def _fold_mean(hits: np.ndarray, n: np.ndarray) -> list[float]:
    """Mean over the folds (last axis) of the share of hits; folds without rows do not count."""
    share = np.divide(hits, n, out=np.zeros(np.shape(hits)), where=n > 0)
    return (share.sum(axis=-1) / np.maximum((n > 0).sum(axis=-1), 1)).tolist()


def tune_linear(
    rows: DataFrame, grids: dict[str, Sequence[float]], folds: int = FOLDS, max_iter: int = 100
) -> dict[str, GridSearch]:
    """Searches over C for several losses at once, with a penalty of |w|^2 / 2 and a free offset.

    ``rows``: features, label (0 or 1), fold. All (loss, C, fold) and the models on all rows are fitted together.
    """
    blocks = linear.pack(_gathered(rows)).persist()
    try:
        first = rows.select(F.size(linear.vector_to_array("features")).alias("n")).na.drop().first()
        points = [(loss, float(c)) for loss, cs in grids.items() for c in cs]
        settings = [linear.Setting(loss, c, fold) for loss, c in points for fold in [*range(folds), linear.NO_FOLD]]
        weights = linear.fit(blocks, settings, first.n if first else 0, max_iter)
        found = linear.totals(blocks, weights, settings)
    finally:
        blocks.unpersist()
    shape = (len(points), folds + 1)
    n = found["rows"].reshape(shape)
    scores = _fold_mean(found["hits"].reshape(shape)[:, :-1], n[:, -1:] - n[:, :-1])
    models = weights.reshape(*shape, -1)[:, -1]
    out = {}
    for loss, cs in grids.items():
        at = [i for i, point in enumerate(points) if point[0] == loss]
        best = models[at[_best([scores[i] for i in at])]]
        model = linear.LinearModel(tuple(float(w) for w in best[:-1]), float(best[-1]))
        out[loss] = GridSearch([{"C": float(c)} for c in cs], [scores[i] for i in at], model)
    return out


def tune_logistic(rows: DataFrame, cs: Sequence[float] = LOGISTIC_C, folds: int = FOLDS, max_iter: int = 100) -> GridSearch:
    """Ridge-penalised logistic regression over C."""
    return tune_linear(rows, {linear.LOGISTIC: cs}, folds, max_iter)[linear.LOGISTIC]


def tune_linear_svm(rows: DataFrame, cs: Sequence[float] = SVM_C, folds: int = FOLDS, max_iter: int = 100) -> GridSearch:
    """Linear support-vector machine over C."""
    return tune_linear(rows, {linear.HINGE: cs}, folds, max_iter)[linear.HINGE]


def tune_tree(
    rows: DataFrame,
    impurities: Sequence[str] = TREE_IMPURITY,
    depths: Sequence[int] = TREE_DEPTH,
    leaves: Sequence[int] = TREE_LEAF,
    splits: Sequence[int] = TREE_SPLIT,
    features: Sequence[str] = TREE_FEATURES,
    folds: int = FOLDS,
    parallelism: int = 8,
) -> GridSearch:
    """Decision tree over criterion, depth, rows of a leaf, rows of a node that may be split, and features tried at a node.

    ``rows``: features, label, fold. One tree of the greatest depth is grown for each (fold, criterion, leaf, features).
    """
    rows = _gathered(rows).persist()
    try:
        found = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]
        held = [f for f in found if f is not None and 0 <= f < folds]
        if len(found) < 2:
            raise ValueError("a search needs rows in two folds at least")
        kinds = list(product(impurities, leaves, features))
        growths = [trees.Growth(i, n, s, fold) for i, n, s in kinds for fold in held]
        folder = trees.grow(rows, growths, max(depths), parallelism)
        board = {(r.tree, r.depth, r.split): (r.hits, r.n) for r in trees.hits(rows, folder, growths, depths, splits).collect()}
        points, counts = [], []
        for impurity, depth, leaf, split, subset in product(impurities, depths, leaves, splits, features):
            points.append({"impurity": impurity, "maxDepth": depth, "minLeaf": leaf, "minSplit": split, "features": subset})
            first = kinds.index((impurity, leaf, subset)) * len(held)
            counts.append([board[first + i, depth, split] for i in range(len(held))])
        hits, n = np.moveaxis(np.array(counts, "float64"), -1, 0)
        scores = _fold_mean(hits, n)
        best = points[_best(scores)]
        whole = [trees.Growth(best["impurity"], best["minLeaf"], best["features"])]
        folder = trees.grow(rows, whole, best["maxDepth"], parallelism)
        nodes = trees.node_tables(rows.sparkSession, folder, whole, [0])[0]
        model = trees.TreeModel(nodes, best["maxDepth"], best["minSplit"])
    finally:
        rows.unpersist()
    return GridSearch(points, scores, model)


def grid_report(spark: SparkSession, fitted: GridSearch) -> DataFrame:
    """One row per grid point with its mean accuracy over the folds, best first."""
    rows = [
        (i, ", ".join(f"{name}={v}" for name, v in sorted(point.items())), float(score))
        for i, (point, score) in enumerate(zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics))
    ]
    return spark.createDataFrame(rows, "grid_point int, params string, cv_accuracy double").orderBy(
        F.desc("cv_accuracy"), "grid_point"
    )


def predict(model: linear.LinearModel | trees.TreeModel, rows: DataFrame) -> DataFrame:
    """``label, prediction`` of each row."""
    return model.transform(rows).select("label", "prediction")


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label, as one row."""
    return predictions.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("score"))


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "predicted") -> DataFrame:
    """Number of rows per (label, prediction)."""
    return predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")).orderBy(label, prediction)


def confusion_matrix(predictions: DataFrame, labels: Sequence, label: str = "label", prediction: str = "predicted") -> DataFrame:
    """The same counts as a square table: one row per label, one column per prediction, zeros filled in."""
    return predictions.groupBy(label).pivot(prediction, list(labels)).count().na.fill(0).orderBy(label)


def best_of(board: DataFrame) -> DataFrame:
    """The first row of a leaderboard; the earlier position wins a tie."""
    return leaderboard(board).limit(1)


def leaderboard(scores: DataFrame) -> DataFrame:
    """Rows ``position, model, score`` with the best score first; the earlier position wins a tie."""
    return scores.orderBy(F.desc("score"), "position")
