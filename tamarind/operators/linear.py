"""Linear classifiers for all folds and penalties in one pass over the rows.

The rows are packed once into blocks. Each pass is one aggregation: it brings the losses and gradients of all models as one
matrix, a model being a loss, a fold that is held out and a penalty. The steps themselves (limited-memory quasi-Newton with
a weak Wolfe line search, which also copes with the kinks of the hinge) need a few numbers a model and run on the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

LOGISTIC, HINGE = "logistic", "hinge"
#: Held-out fold of a model that learns from all rows.
NO_FOLD = -1
#: Rows in a block. A task's working memory is a block's rows times the number of models.
BLOCK_ROWS = 4096
#: Partial sums that the driver takes at once; more are added up by so many tasks at a time before.
FAN_IN = 64
#: Steps remembered by the quasi-Newton search, trials of a step, relative change at which a search ends.
MEMORY, TRIALS, TOLERANCE = 10, 30, 1e-6


@dataclass(frozen=True)
class Setting:
    """One model: minimise C * (sum of losses) + |w|^2 / 2 over the rows outside the held-out fold; the offset is free."""

    loss: str
    c: float
    fold: int = NO_FOLD


def pack(rows: DataFrame) -> DataFrame:
    """Blocks ``x, y, fold`` (float64, float64 of -1 and 1, int32; as bytes) of rows ``features, label, fold``.

    Rows without features or label are left out. Vectors of different lengths raise an error in the task.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("float64")
                if len(x) % len(part) or (np.diff(part.column("x").offsets.to_numpy()) != len(x) // len(part)).any():
                    raise ValueError("feature vectors of different lengths")
                y = 2 * part.column("label").to_numpy(zero_copy_only=False) - 1
                fold = part.column("fold").to_numpy(zero_copy_only=False)
                cells = (x.tobytes(), y.astype("float64").tobytes(), fold.astype("int32").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["x", "y", "fold"])

    known = rows.filter(F.col("features").isNotNull() & F.col("label").isNotNull())
    plain = known.select(vector_to_array("features").alias("x"), F.col("label").cast("double"), F.col("fold").cast("int"))
    return plain.mapInArrow(blocks, "x binary, y binary, fold binary")


def _totals(x, y, fold, weights, held, hinge) -> np.ndarray:
    """``m x (d + 4)``: loss, rows, gradient (the offset's last) outside the held-out fold, hits inside it."""
    margin = x @ weights[:, :-1].T + weights[:, -1]
    z, outside = y[:, None] * margin, fold[:, None] != held[None, :]
    loss, slope = np.empty_like(z), np.empty_like(z)
    loss[:, hinge], slope[:, hinge] = np.maximum(0, 1 - z[:, hinge]), z[:, hinge] < 1
    soft = z[:, ~hinge]
    loss[:, ~hinge], slope[:, ~hinge] = np.logaddexp(0, -soft), (1 - np.tanh(soft / 2)) / 2
    slope *= -y[:, None] * outside
    hits = ((margin > 0) == (y > 0)[:, None]) & ~outside
    return np.column_stack(
        [(loss * outside).sum(axis=0), outside.sum(axis=0), slope.T @ x, slope.sum(axis=0), hits.sum(axis=0)]
    )


def partial_totals(blocks: DataFrame, weights: np.ndarray, held: np.ndarray, hinge: np.ndarray, parts: int = 1) -> DataFrame:
    """Rows ``totals`` (float64 as bytes), FAN_IN at most: the sums over blocks in ``parts`` partitions for all models."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), weights.shape[1] + 3))
        for batch in batches:
            for x, y, fold in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "fold"))):
                y = np.frombuffer(y)
                total += _totals(np.frombuffer(x).reshape(len(y), -1), y, np.frombuffer(fold, "int32"), weights, held, hinge)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["totals"])

    def add_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(t) for batch in batches for t in batch.column("totals").to_pylist())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["totals"])

    sums = blocks.mapInArrow(add_up, "totals binary")
    while parts > FAN_IN:
        parts = math.ceil(parts / FAN_IN)
        sums = sums.repartition(parts).mapInArrow(add_again, "totals binary")
    return sums


def totals(blocks: DataFrame, weights: np.ndarray, settings: Sequence[Setting], parts: int = 1) -> dict[str, np.ndarray]:
    """``loss, rows, gradient, hits`` of every model at its weights, by one aggregation. Losses without the penalty."""
    held = np.array([s.fold for s in settings], "int32")
    hinge = np.array([s.loss == HINGE for s in settings])
    found = partial_totals(blocks, weights, held, hinge, parts).collect()
    total = sum((np.frombuffer(r.totals) for r in found), np.zeros(len(settings) * (weights.shape[1] + 3)))
    total = total.reshape(len(settings), -1)
    return {"loss": total[:, 0], "rows": total[:, 1], "gradient": total[:, 2:-1], "hits": total[:, -1]}


def figures(rows: DataFrame, weights: Sequence[float], settings: Sequence[Setting]) -> DataFrame:
    """``loss, fold, figure, value``: what ``totals`` gives for one vector of weights (the offset last), by name.

    Figures are ``loss``, ``rows`` and the gradient (``w0`` ..., ``offset``) outside the held-out fold, ``hits`` inside it.
    """
    found = totals(pack(rows), np.tile(np.array(weights, "float64"), (len(settings), 1)), settings, rows.rdd.getNumPartitions())
    names = [f"w{i}" for i in range(len(weights) - 1)] + ["offset"]
    table = [
        (s.loss, s.fold, name, float(value))
        for i, s in enumerate(settings)
        for name, value in [*zip(names, found["gradient"][i]), *((k, found[k][i]) for k in ("loss", "rows", "hits"))]
    ]
    return rows.sparkSession.createDataFrame(table, "loss string, fold int, figure string, value double")


@dataclass
class Descent:
    """Minimisation of one function that is asked for its value and gradient at one ``point`` at a time."""

    point: np.ndarray
    max_iter: int
    steps: int = 0
    done: bool = False
    _at: np.ndarray | None = None
    _seen: list = field(default_factory=list)
    _flat: int = 0

    def tell(self, value: float, gradient: np.ndarray) -> None:
        """Value and gradient at ``point``; sets the next point, or ``done`` (``point`` is then the best one)."""
        if self._at is None:
            return self._step_from(self.point, value, gradient)
        self._trial += 1
        slope = self._direction @ self._gradient
        if not value <= self._value + 1e-4 * self._length * slope:
            self._high = self._length
        elif gradient @ self._direction < 0.9 * slope:
            self._low = self._length
            if self._trial >= TRIALS:
                return self._accept(value, gradient)
        else:
            return self._accept(value, gradient)
        if self._trial >= TRIALS:
            self.point, self.done = self._at, True
            return None
        self._length = 2 * self._low if math.isinf(self._high) else (self._low + self._high) / 2
        self.point = self._at + self._length * self._direction
        return None

    def _accept(self, value: float, gradient: np.ndarray) -> None:
        moved, bent = self.point - self._at, gradient - self._gradient
        if moved @ bent > 1e-12 * (bent @ bent):
            self._seen = [*self._seen[1 - MEMORY :], (moved, bent)] if MEMORY > 1 else [(moved, bent)]
        self.steps += 1
        small = abs(self._value - value) <= TOLERANCE * max(abs(value), abs(self._value))
        self._flat = self._flat + 1 if small else 0
        if self.steps >= self.max_iter or self._flat >= 3:
            self.done = True
            return None
        return self._step_from(self.point, value, gradient)

    def _step_from(self, at: np.ndarray, value: float, gradient: np.ndarray) -> None:
        self._at, self._value, self._gradient = at, value, gradient
        if np.linalg.norm(gradient) <= 1e-8 * max(1.0, np.linalg.norm(at)):
            self.done = True
            return
        direction = -gradient
        weights = []
        for moved, bent in reversed(self._seen):
            weights.append((moved @ direction) / (moved @ bent))
            direction = direction - weights[-1] * bent
        if self._seen:
            moved, bent = self._seen[-1]
            direction = direction * (moved @ bent) / (bent @ bent)
        for (moved, bent), weight in zip(self._seen, reversed(weights)):
            direction = direction + (weight - (bent @ direction) / (moved @ bent)) * moved
        if direction @ gradient >= 0:
            self._seen, direction = [], -gradient
        self._direction = direction if self._seen else direction / max(1.0, np.linalg.norm(direction))
        self._low, self._high, self._length, self._trial = 0.0, math.inf, 1.0, 0
        self.point = at + self._direction


def fit(blocks: DataFrame, settings: Sequence[Setting], width: int, max_iter: int = 100) -> np.ndarray:
    """Weights of every model, one row each, the offset last; ``max_iter`` steps at most for each model.

    All models that are still moving share a pass; a model takes the same steps whatever the others are.
    """
    parts = blocks.rdd.getNumPartitions()
    searches = [Descent(np.zeros(width + 1), max_iter) for _ in settings]
    while moving := [i for i, s in enumerate(searches) if not s.done]:
        points = np.stack([searches[i].point for i in moving])
        found = totals(blocks, points, [settings[i] for i in moving], parts)
        for j, i in enumerate(moving):
            # Divided by C times the rows, so that values of one size are compared whatever the penalty.
            scale = 1 / max(found["rows"][j], 1.0)
            pull = scale / settings[i].c * np.append(points[j, :-1], 0.0)
            searches[i].tell(
                scale * found["loss"][j] + pull @ points[j] / 2, scale * found["gradient"][j] + pull
            )
    return np.stack([s.point for s in searches])


@dataclass(frozen=True)
class LinearModel:
    """A fitted model; ``transform`` adds ``prediction`` (0.0 or 1.0) to rows with ``features``."""

    weights: tuple[float, ...]
    offset: float

    def transform(self, rows: DataFrame) -> DataFrame:
        products = F.zip_with(
            vector_to_array("features"), F.array(*[F.lit(w) for w in self.weights]).cast("array<double>"), lambda x, w: x * w
        )
        margin = F.aggregate(products, F.lit(self.offset), lambda total, x: total + x)
        return rows.withColumn("prediction", (margin > 0).cast("double"))
