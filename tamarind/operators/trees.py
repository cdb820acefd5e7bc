"""Decision trees that are grown once and read at every depth.

A greedy tree of small depth is the top of a deep one, and a node that is too small to be split is one where reading stops.
So a grid over depth and split minimum needs one deep tree for each (fold, criterion, leaf minimum, feature subset); its
node table, which the library stores as a plain table, answers for all the rest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

#: Held-out fold of a tree that is grown on all rows.
NO_FOLD = -1
ALL, SQRT = "all", "sqrt"
SEED = 2


@dataclass(frozen=True)
class Growth:
    """What decides a whole tree: criterion, rows a leaf must have, features tried at a node, fold that is held out."""

    impurity: str
    leaf: int
    features: str = ALL
    fold: int = NO_FOLD


@dataclass(frozen=True)
class Nodes:
    """Node table of a tree, the root first; ``left`` is -1 in a leaf. Every node has its rows and its own prediction."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    rows: np.ndarray
    prediction: np.ndarray

    def read(self, x: np.ndarray, depths: Sequence[int], splits: Sequence[int]) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(depth, split, predictions)`` of the tree cut at each depth and at nodes below each split minimum."""
        for split in splits:
            at, row = np.zeros(len(x), "int64"), np.arange(len(x))
            ends = (self.left < 0) | (self.rows < split)
            for depth in range(max(depths) + 1):
                if depth in depths:
                    yield depth, split, self.prediction[at]
                lower = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
                at = np.where(ends[at], at, lower)


def _estimator(growth: Growth, depth: int):
    if growth.features == SQRT:
        tree = RandomForestClassifier(numTrees=1, featureSubsetStrategy=SQRT, subsamplingRate=1.0, bootstrap=False, seed=SEED)
    else:
        tree = DecisionTreeClassifier(seed=SEED)
    return tree.setImpurity(growth.impurity).setMinInstancesPerNode(growth.leaf).setMaxDepth(depth)


#: Schema of the node tables that the library's model writer stores; a forest has them inside ``nodeData``.
_NODE = (
    "id int, prediction double, rawCount bigint, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>>"
)


def grow(rows: DataFrame, growths: Sequence[Growth], depth: int, parallelism: int = 8) -> str:
    """Grow the trees and return the folder where the library's own model writer has put them, one model a position.

    ``rows``: features, label (0, 1, ...), fold. The folder lies below the shared one, where all executors reach it.
    """
    spark = rows.sparkSession
    classes = int(rows.agg(F.max("label")).first()[0]) + 1
    # With the classes known from the schema no tree looks for them again.
    nominal = {"ml_attr": {"type": "nominal", "vals": [str(float(i)) for i in range(classes)]}}
    rows = rows.withColumn("label", F.col("label").alias("label", metadata=nominal))
    folder = scratch_path(spark, "trees")

    def one(place: int, growth: Growth) -> None:
        model = _estimator(growth, depth).fit(rows.filter(F.col("fold") != growth.fold))
        model.write().save(f"{folder}/{place}")

    # A copy of the local properties for every task: threads that share one object disturb each other's SQL executions.
    tasks = [inheritable_thread_target(spark)(lambda i=i, g=g: one(i, g)) for i, g in enumerate(growths)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        pool.map(lambda task: task(), tasks)
    return folder


def node_tables(spark: SparkSession, folder: str, growths: Sequence[Growth], of: Sequence[int]) -> dict[int, Nodes]:
    """The tables of some trees on the driver; a tree has 2 ** (depth + 1) nodes at most, whatever the number of rows."""
    tree = F.regexp_extract(F.col("_metadata.file_path"), "/([0-9]+)/data/[^/]*$", 1).cast("int").alias("tree")
    out = {}
    for subset in (ALL, SQRT):
        paths = [f"{folder}/{i}/data" for i in of if growths[i].features == subset]
        if not paths:
            continue
        stored = spark.read.schema(_NODE if subset == ALL else f"nodeData struct<{_NODE}>").parquet(*paths)
        found = stored.select(tree, "*" if subset == ALL else "nodeData.*").select(
            "tree", "id", F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
            F.greatest("split.featureIndex", F.lit(0)).alias("feature"),
            F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
            F.col("rawCount").alias("n"), "prediction",
        )
        for place, part in found.toPandas().sort_values(["tree", "id"]).groupby("tree"):
            out[int(place)] = Nodes(*(part[c].to_numpy() for c in ("left", "right", "feature", "threshold", "n", "prediction")))
    return out


def hits(
    rows: DataFrame, folder: str, growths: Sequence[Growth], depths: Sequence[int], splits: Sequence[int]
) -> DataFrame:
    """``tree, depth, split, hits, n``: right predictions of every tree on its held-out rows, at every cut.

    One job a fold, so that the tables of one fold's trees are with the tasks at a time. Rows without features are left out.
    """
    spark, parts = rows.sparkSession, []
    asked = rows.filter(F.col("features").isNotNull()).select(vector_to_array("features").alias("x"), "label", "fold")
    for fold in sorted({g.fold for g in growths}):
        found = node_tables(spark, folder, growths, [i for i, g in enumerate(growths) if g.fold == fold])
        tables = spark.sparkContext.broadcast({tree: tuple(vars(nodes).values()) for tree, nodes in found.items()})

        def score(batches: Iterator[pd.DataFrame], tables=tables) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                x, label = np.stack(batch["x"].to_list()), batch["label"].to_numpy()
                found = [
                    (tree, depth, split, int((predicted == label).sum()), len(x))
                    for tree, arrays in tables.value.items()
                    for depth, split, predicted in Nodes(*arrays).read(x, depths, splits)
                ]
                yield pd.DataFrame(found, columns=["tree", "depth", "split", "hits", "n"])

        held = asked.filter(F.col("fold") == fold)
        parts.append(held.mapInPandas(score, "tree int, depth int, split int, hits long, n long"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("tree", "depth", "split").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class TreeModel:
    """A tree cut at a depth and a split minimum; ``transform`` adds ``prediction`` to rows with ``features``."""

    nodes: Nodes
    depth: int
    split: int

    def transform(self, rows: DataFrame) -> DataFrame:
        nodes, depth, split = self.nodes, self.depth, self.split

        def predict(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="float64")
            return pd.Series(next(nodes.read(np.stack(vectors.to_list()), [depth], [split]))[2])

        return rows.withColumn("prediction", F.pandas_udf(predict, "double")(vector_to_array("features")))
