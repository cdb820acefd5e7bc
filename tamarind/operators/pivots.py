"""Exact k-nearest neighbours among any number of labelled rows, by an index of pivots.

A bounded number of labelled rows are pivots, and every labelled row belongs to its nearest one. A row that asks looks first
into the nearest groups that hold k rows; the k-th distance found there and the triangle inequality rule out all groups that
cannot hold a nearer one, and the rest is looked through. Groups are cut into blocks of bounded size and rows that ask into
packs, so a task sees one block and one pack at a time however crowded a pivot is, and no set of rows is broadcast.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.session import apply_options, freeze

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

#: Pivots (the rows that the driver and every task see), labelled rows in a block, rows that ask in a pack.
PIVOTS, BLOCK, PACK = 256, 1024, 256
#: Tasks that share the packs of one pivot.
SPREAD = 16

FOUND = "id long, neighbour long, label int, distance double"


def distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """All distances between the rows of two matrices, entry by entry: equal rows are 0 apart."""
    gap = np.abs(a[:, None, :] - b[None, :, :])
    return gap.sum(axis=2) if p == 1 else np.sqrt(np.square(gap).sum(axis=2))


def closest(asked: np.ndarray, vecs: np.ndarray, known: np.ndarray, k: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the k nearest ``vecs`` for each row of ``asked`` and their distances, by distance and then ``known``.

    For p = 2 a matrix product screens the candidates with a margin far above its rounding; only those are measured
    entry by entry as ``distances`` does, so the result is the same as sorting the whole matrix of ``distances``.
    """
    if p != 2 or len(vecs) <= k:
        d = distances(asked, vecs, p)
        order = np.lexsort((np.broadcast_to(known, d.shape), d), axis=1)[:, :k]
        return order, np.take_along_axis(d, order, axis=1)
    a2, b2 = np.square(asked).sum(axis=1), np.square(vecs).sum(axis=1)
    rough = a2[:, None] + b2[None, :] - 2.0 * (asked @ vecs.T)
    slack = 1e-9 * (a2[:, None] + b2.max()) + 1e-300
    kth = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    row, col = np.nonzero(rough <= kth + 2 * slack)
    exact = np.sqrt(np.square(np.abs(asked[row] - vecs[col])).sum(axis=1))
    ranked = np.lexsort((known[col], exact, row))
    row, col, exact = row[ranked], col[ranked], exact[ranked]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    order, near = np.empty((len(asked), k), "int64"), np.empty((len(asked), k))
    order[row[keep], place[keep]], near[row[keep], place[keep]] = col[keep], exact[keep]
    return order, near


def _packed(rows: DataFrame, keys: list[str], size: int, **columns: str) -> DataFrame:
    """One row for up to ``size`` rows that agree in ``keys``: other columns as bytes of their numpy types.

    ``rows`` are sorted by the keys in each partition; ``vec`` becomes a matrix. A pack is closed where a key changes.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def closed() -> pd.DataFrame:
            whole = pd.concat(waiting)
            cells = {c: np.stack(whole[c].to_list()) if c == "vec" else whole[c].to_numpy() for c in columns}
            first = {c: [whole[c].iloc[0]] for c in keys}
            return pd.DataFrame({**first, **{c: [v.astype(columns[c]).tobytes()] for c, v in cells.items()}})

        for batch in batches:
            for _, part in batch.groupby(keys, sort=False) if len(batch) else ():
                for at in range(0, len(part), size):
                    some = part.iloc[at : at + size]
                    if waiting and (
                        any(waiting[0][c].iloc[0] != some[c].iloc[0] for c in keys)
                        or sum(map(len, waiting)) + len(some) > size
                    ):
                        yield closed()
                        waiting.clear()
                    waiting.append(some)
        if waiting:
            yield closed()

    kinds = ", ".join([*(f"{c} int" for c in keys), *(f"{c} binary" for c in columns)])
    return rows.mapInPandas(pack, kinds)


def _looked_through(asking: DataFrame, blocks: DataFrame, k: int, p: int) -> DataFrame:
    """``FOUND``: up to k labelled rows of every block that a row asks, none beyond its ``reach``."""
    dealt = asking.repartition("pivot", F.pmod(F.xxhash64("id"), F.lit(SPREAD))).sortWithinPartitions("pivot")
    packs = _packed(dealt, ["pivot"], PACK, id="int64", reach="float64", vec="float64")
    pairs = packs.withColumnsRenamed({"id": "ids", "vec": "asked"}).join(blocks, "pivot")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, reach, known = np.frombuffer(row.ids, "int64"), np.frombuffer(row.reach), np.frombuffer(row.id, "int64")
                labels = np.frombuffer(row.label, "int32")
                asked, vecs = np.frombuffer(row.asked).reshape(len(ids), -1), np.frombuffer(row.vec).reshape(len(known), -1)
                order, near = closest(asked, vecs, known, k, p)
                keep = near <= reach[:, None]
                yield pd.DataFrame(
                    {
                        "id": np.repeat(ids, keep.sum(axis=1)), "neighbour": known[order][keep], "label": labels[order][keep],
                        "distance": near[keep],
                    }
                )

    return pairs.mapInPandas(match, FOUND)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest rows found by each id with their ``place``; every task drops its own losers before the shuffle."""
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def nearest_of_all(train: DataFrame, test: DataFrame, k: int = 10, p: int = 2, pivots: int = PIVOTS) -> DataFrame:
    """The k nearest of all labelled rows for each test row: ``id, neighbour, label, distance, place``.

    ``train``: id long, label int, vec array<double>; ``test``: id long (unique), vec array<double>. ``p`` is 1 or 2. Equal
    distances are ordered by the id of the labelled row. Rows without a vector neither ask nor are found; fewer than k
    labelled rows are all found, and without any there are no rows. All vectors must have one length and be finite.
    """
    spark = apply_options(train.sparkSession)
    vec = F.col("vec").cast("array<double>").alias("vec")
    labelled = train.filter(F.col("vec").isNotNull()).select("id", F.col("label").cast("int").alias("label"), vec)
    asking = test.filter(F.col("vec").isNotNull()).select("id", vec)
    chosen = labelled.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not chosen:
        return spark.createDataFrame([], f"{FOUND}, place int")
    centres = np.array([r.vec for r in chosen], "float64")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PACK):
                part = batch.iloc[at : at + PACK]
                d = distances(np.stack(part["vec"].to_list()), centres, p)
                yield part.assign(pivot=d.argmin(axis=1).astype("int32"), gap=d.min(axis=1))

    settled = freeze(labelled.mapInPandas(settle, "id long, label int, vec array<double>, pivot int, gap double"), "settled")
    groups = settled.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()
    n, radius = np.zeros(len(centres), "int64"), np.full(len(centres), -np.inf)
    for g in groups:
        n[g.pivot], radius[g.pivot] = g.n, g.radius
    cuts = F.get(F.array(*[F.lit(int(max(1, -(-size // BLOCK)))) for size in n]), F.col("pivot"))
    blocks = _packed(
        settled.withColumn("block", F.pmod(F.xxhash64("id"), cuts).cast("int"))
        .repartition("pivot", "block")
        .sortWithinPartitions("pivot", "block"),
        ["pivot", "block"], BLOCK, id="int64", label="int32", vec="float64",
    )

    def visits(which: Callable[[np.ndarray, np.ndarray | None], np.ndarray]):
        """Rows ``id, vec, reach, pivot`` for the groups that ``which`` marks by the distances to the pivots."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), PACK):
                    part = batch.iloc[at : at + PACK]
                    d, reach = distances(np.stack(part["vec"].to_list()), centres, p), part["reach"].to_numpy()
                    row, pivot = np.nonzero(which(d, reach))
                    yield part.iloc[row][["id", "vec", "reach"]].assign(pivot=pivot.astype("int32"))

        return run

    def home(d: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """The nearest groups that hold k rows together."""
        order = np.argsort(d, axis=1, kind="stable")
        before = n[order].cumsum(axis=1) - n[order]
        out = np.zeros(d.shape, bool)
        np.put_along_axis(out, order, (before < k) & (n[order] > 0), axis=1)
        return out

    def within(d: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Groups that may hold a row within reach and were not looked through yet; the slack covers rounding."""
        least = d - radius - 1e-9 * (d + np.maximum(radius, 0))
        return (least <= reach[:, None]) & (n > 0) & ~home(d, reach)

    visit = "id long, vec array<double>, reach double, pivot int"
    first = asking.withColumn("reach", F.lit(float("inf"))).mapInPandas(visits(home), visit)
    near = freeze(_nearest(_looked_through(first, blocks, k, p), k), "near")
    reach = near.groupBy("id").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("reach")
    )
    second = asking.join(reach, "id").select("id", "vec", "reach").mapInPandas(visits(within), visit)
    both = near.drop("place").unionByName(_looked_through(second, blocks, k, p))
    return _nearest(both, k).select("id", "neighbour", "label", "distance", F.col("place").cast("int").alias("place"))
