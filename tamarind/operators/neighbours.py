"""Exact k-nearest-neighbour classification.

The labelled rows are the model. For a vote, all of them are packed into blocks and the asked rows into packs; every pack
meets every block, and a task holds one of each at a time, however large the tables are. The work is the product of the
two counts, as exact search must be; most of it is done on rough distances, which tell which pairs have to be measured.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import freeze

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

#: Most labelled rows that are fitted (50 MB for 64 entries a row). More are reduced to those first by the hash of their id.
MOST_FITTED = 100_000
#: Numbers in a block of distances that a task computes at once.
_BLOCK = 4_000_000


def fitted_rows(train: DataFrame, most: int = MOST_FITTED) -> dict[str, np.ndarray]:
    """Ids, labels, folds and matrix of the labelled rows, ordered by id; ``most`` of them if there are more.

    Which ones is settled by the hash of the id, so the choice is the same in every run. Rows with a missing vector are
    left out. ``fold`` may be absent.
    """
    fold = F.col("fold").cast("int") if "fold" in train.columns else F.lit(-1)
    rows = train.filter(F.col("vec").isNotNull()).select(
        "id", F.col("label").cast("int").alias("label"), F.col("vec").cast("array<double>").alias("vec"), fold.alias("fold")
    )
    picked = sorted(rows.orderBy(F.xxhash64("id"), "id").limit(most).collect(), key=lambda r: r.id)
    return {
        "id": np.array([r.id for r in picked], "int64"),
        "label": np.array([r.label for r in picked], "int64"),
        "fold": np.array([r.fold for r in picked], "int64"),
        "vec": np.array([r.vec for r in picked], "float64").reshape(len(picked), len(picked[0].vec) if picked else 0),
    }


def _nearest():
    """The kernel of the tasks. Being local it travels with the task, so executors need not have this package installed."""

    def nearest(vectors: np.ndarray, folds: np.ndarray | None, fitted: dict, k: int, p: int):
        """Positions and distances of the k nearest fitted rows, equal distances by id; other folds only if folds are given."""
        width = max(1, fitted["vec"].size)
        step = max(1, _BLOCK // width)
        for start in range(0, len(vectors), step):
            gap = np.abs(vectors[start : start + step, None, :] - fitted["vec"][None, :, :])
            d = gap.sum(axis=2) if p == 1 else np.sqrt(np.square(gap).sum(axis=2))
            if folds is not None:
                d[folds[start : start + step, None] == fitted["fold"][None, :]] = np.inf
            yield start, *_first(d, k)

    def _first(d: np.ndarray, k: int):
        """Positions and values of the k smallest of each row of ``d``, equal values by position."""
        if d.shape[1] > k:
            kth = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
            if not np.isnan(kth).any():
                # Only values up to the k-th, ties with it included, are sorted: by row, value, position.
                rows, cols = np.nonzero(d <= kth)
                order = np.lexsort((cols, d[rows, cols], rows))
                rows, cols = rows[order], cols[order]
                best = cols[np.searchsorted(rows, np.arange(len(d)))[:, None] + np.arange(k)[None, :]]
                return best, np.take_along_axis(d, best, axis=1)
        # A stable sort of rows in id order leaves equal distances in id order.
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        return best, np.take_along_axis(d, best, axis=1)

    return nearest


def nearest_rows(train: DataFrame, test: DataFrame, k: int = 10, p: int = 2, most: int = MOST_FITTED) -> DataFrame:
    """The k nearest fitted rows of each test row: ``id, neighbour, label, distance, place``.

    ``train``: id long, label int, vec array<double>; ``test``: id long, vec array<double>. Equal distances are ordered
    by the id of the fitted row. ``most`` bounds the labelled rows that are fitted.
    """
    nearest, fitted = _nearest(), test.sparkSession.sparkContext.broadcast(fitted_rows(train, most))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = fitted.value
        for batch in batches:
            if not len(batch) or not len(known["id"]):
                continue
            ids, vectors = batch["id"].to_numpy(), np.stack(batch["vec"].to_list())
            for start, best, distance in nearest(vectors, None, known, k, p):
                n, m = best.shape
                yield pd.DataFrame(
                    {
                        "id": np.repeat(ids[start : start + n], m),
                        "neighbour": known["id"][best].ravel(),
                        "label": known["label"][best].ravel().astype("int32"),
                        "distance": distance.ravel(),
                        "place": np.tile(np.arange(1, m + 1, dtype="int32"), n),
                    }
                )

    rows = test.filter(F.col("vec").isNotNull()).select("id", F.col("vec").cast("array<double>").alias("vec"))
    return rows.mapInPandas(match, "id long, neighbour long, label int, distance double, place int")


#: Most rows in a pack of asked rows or in a block of labelled rows, bytes of vectors in one, and bytes of vectors in a
#: section. A task meets the packs of one partition with the blocks of one section, one pack and one block at a time.
BLOCK_ROWS, PACK_BYTES, SECTION_BYTES = 8192, 4 << 20, 64 << 20
#: Tasks for each core, so that all cores are busy to the end.
TASKS_PER_CORE = 3
#: Asked rows in a tile of screened pairs for p = 1 and 2; numbers that are measured entry by entry at once.
TILE_ROWS, MEASURED = {1: 16, 2: 64}, 2_000_000
#: Stands for a missing label or fold in a task.
MISSING = np.iinfo("int64").min


def _measured(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Distances of the rows of two matrices of one shape, entry by entry."""
    with np.errstate(over="ignore"):
        gap = np.abs(a - b)
        return gap.sum(axis=1) if p == 1 else np.sqrt(np.square(gap).sum(axis=1))


class _Steps:
    """Rough sums of absolute differences: entries become whole steps of one size, so that a tile is sums of small integers.

    ``error`` bounds, for each asked row, by how much a rough distance and the measured one differ (in steps). ``loss``
    is what an asked row outside the range of the steps may be farther away than it looks; it never looks too far.
    """

    def __init__(self, asked: np.ndarray, known: np.ndarray):
        width = asked.shape[1]
        kind, levels = ("int16", 32766 - width) if width <= 4096 else ("int32", (1 << 30) - width)
        low, high = known.min(axis=0), known.max(axis=0)
        step = max((high - low).sum() / levels, np.finfo("float64").tiny)
        inside = np.clip(asked, low, high)
        tiny = 2.0**-45 * (np.abs(asked).sum(axis=1) + np.abs(known).sum(axis=1).max())

        def stepped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            steps = np.rint((x - low) / step)
            return np.ascontiguousarray(steps.T.astype(kind)), np.abs(x - (low + step * steps)).sum(axis=1)

        (self.asked, off), (self.known, known_off) = stepped(inside), stepped(known)
        self.step, self.far = step, np.iinfo(kind).max
        self.error = (off + known_off.max() + tiny) / step
        self.loss = np.abs(asked - inside).sum(axis=1) / step
        self.good = np.isfinite(self.error)
        self.gap = np.empty((TILE_ROWS[1], known.shape[0]), kind)
        self.kind = kind

    def tile(self, rows: slice) -> np.ndarray:
        asked = self.asked[:, rows]
        total, gap = np.zeros((asked.shape[1], self.known.shape[1]), self.kind), self.gap[: asked.shape[1]]
        for one, other in zip(asked, self.known):
            np.subtract(one[:, None], other[None, :], out=gap)
            np.abs(gap, out=gap)
            np.add(total, gap, out=total)
        return total

    def limit(self, least: np.ndarray, kth: np.ndarray, rows: slice) -> np.ndarray:
        """Rough distances up to these may be among the k nearest: ``least`` is rough, ``kth`` was measured."""
        error, loss = self.error[rows], self.loss[rows]
        most = np.minimum(least + 2 * error + loss, kth / self.step * (1 + 1e-9) + error)
        return np.minimum(np.floor(most) + 1, self.far - 1).astype(self.kind)


class _Products:
    """Rough squared distances by a matrix product in single precision, around the mean of the labelled rows and in a unit
    (a power of two) that makes their entries about one.
    """

    far = np.float32(np.inf)

    def __init__(self, asked: np.ndarray, known: np.ndarray):
        width, centre = asked.shape[1], known.mean(axis=0)
        self.unit = 2.0 ** -np.clip(np.frexp(np.abs(known - centre).max())[1], -500, 500)
        asked, known, centre = asked * self.unit, known * self.unit, centre * self.unit
        a, b = asked - centre, known - centre
        a2, b2 = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
        self.asked = np.column_stack([a, a2, np.ones(len(a))]).astype("float32")
        self.known = np.ascontiguousarray(np.column_stack([-2 * b, np.ones(len(b)), b2]).astype("float32").T)
        both = a2 + b2.max()
        # Single precision in the product, double precision where the mean is taken away, numbers too small for it.
        entry = 2.0**-50 * (np.abs(asked).max(axis=1) + np.abs(known).max())
        self.error = 4 * (width + 16) * 2.0**-24 * both + 4 * np.sqrt(width * both) * entry + 4 * width * entry**2 + 1e-36 * width
        self.good = both < 1e30
        self.asked[~self.good] = 0

    def tile(self, rows: slice) -> np.ndarray:
        return self.asked[rows] @ self.known

    def limit(self, least: np.ndarray, kth: np.ndarray, rows: slice) -> np.ndarray:
        error = self.error[rows]
        most = np.minimum(least + 2 * error, np.square(kth * self.unit) * (1 + 1e-9) + error)
        return (most + np.abs(most) * 2.0**-20).astype("float32")


class _Kept:
    """The k nearest labelled rows of every asked row so far: distance, id and label, by distance, id and label."""

    def __init__(self, n: int, k: int):
        self.near, self.other = np.full((n, k), np.inf), np.zeros((n, k), "int64")
        self.label = np.zeros((n, k), "int64")

    def add(self, row: np.ndarray, near: np.ndarray, other: np.ndarray, label: np.ndarray) -> None:
        """More neighbours: ``row`` says which asked row each belongs to. Those without a finite distance don't count."""
        k = self.near.shape[1]
        last = self.near[row, -1]
        closer = np.isfinite(near) & ((near < last) | (near == last) & (other <= self.other[row, -1]))
        row, near, other, label = (x[closer] for x in (row, near, other, label))
        if not len(row):
            return
        met = np.unique(row)
        old_row, old = np.repeat(met, k), np.isfinite(self.near[met]).ravel()
        row = np.concatenate([old_row[old], row])
        near = np.concatenate([self.near[met].ravel()[old], near])
        other = np.concatenate([self.other[met].ravel()[old], other])
        label = np.concatenate([self.label[met].ravel()[old], label])
        order = np.lexsort((label, other, near, row))
        row, near, other, label = row[order], near[order], other[order], label[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        at = row[keep], place[keep]
        self.near[at], self.other[at], self.label[at] = near[keep], other[keep], label[keep]


def _search(kept: _Kept, asked: np.ndarray, known: np.ndarray, ids: np.ndarray, labels: np.ndarray, p: int, apart=None) -> None:
    """Put into ``kept`` what the rows of ``known`` have for it. ``apart``: folds of both; rows of one fold do not meet.

    Rough distances, with a bound for their error, screen the candidates; only those are measured, entry by entry, so the
    result is that of measuring all pairs. Vectors whose rough distances say nothing are measured with all others.
    """
    k = kept.near.shape[1]
    fine_a, fine_b = np.flatnonzero(np.isfinite(asked).all(axis=1)), np.flatnonzero(np.isfinite(known).all(axis=1))
    if apart is not None:
        # Labelled rows of one fold lie side by side.
        fine_b = fine_b[np.argsort(apart[1][fine_b], kind="stable")]
        folds, begin = np.unique(apart[1][fine_b], return_index=True)
        spans = dict(zip(folds.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(fine_b)])))
    if not len(fine_a) or not len(fine_b):
        return
    a, b = asked[fine_a], known[fine_b]
    most = max(1, MEASURED // max(1, a.shape[1]))

    def measure(row: np.ndarray, col: np.ndarray) -> None:
        if apart is not None:
            other = apart[0][fine_a[row]] != apart[1][fine_b[col]]
            row, col = row[other], col[other]
        for at in range(0, len(row), most):
            r, c = row[at : at + most], col[at : at + most]
            kept.add(fine_a[r], _measured(a[r], b[c], p), ids[fine_b[c]], labels[fine_b[c]])

    def pairs(rows: np.ndarray, cols: np.ndarray) -> None:
        for at in range(0, len(rows), step := max(1, most // max(1, len(cols)))):
            some = rows[at : at + step]
            measure(np.repeat(some, len(cols)), np.tile(cols, len(some)))

    usual, odd = np.arange(len(b)), np.zeros(0, "int64")
    if len(b) > 64 and a.shape[1]:
        # Few rows far from all others would make rough distances too rough; they are measured.
        low, high = np.quantile(b[:: max(1, len(b) // 512)], [0.02, 0.98], axis=0)
        off = ((b < low - 8 * (high - low)) | (b > high + 8 * (high - low))).any(axis=1)
        if off.sum() <= len(b) // 64:
            usual, odd = np.flatnonzero(~off), np.flatnonzero(off)
    pairs(np.arange(len(a)), odd)
    with np.errstate(over="ignore", invalid="ignore"):
        rough = (_Steps if p == 1 else _Products)(a, b[usual]) if a.shape[1] else None
    good = np.zeros(len(a), bool) if rough is None else rough.good
    pairs(np.flatnonzero(~good), usual)
    if not good.any():
        return
    # The least of every group of columns: the k-th of these is no less than the k-th of all.
    size = int(np.clip(len(usual) // (4 * k), 1, 32))
    groups = len(usual) // size
    rest, within = np.arange(groups * size, len(usual)), groups * np.arange(size)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(a), TILE_ROWS[p]):
        rows = slice(start, min(start + TILE_ROWS[p], len(a)))
        tile = rough.tile(rows)
        if apart is not None:
            for i, fold in enumerate(apart[0][fine_a[rows]].tolist()):
                if fold in spans:
                    first, last = np.searchsorted(usual, spans[fold])
                    tile[i, first:last] = rough.far
        least = tile[:, : groups * size].reshape(len(tile), size, groups).min(axis=1)
        bound = np.full(len(tile), np.inf)
        if groups >= k:
            bound = np.partition(least, k - 1, axis=1)[:, k - 1].astype("float64")
            bound[bound >= rough.far] = np.inf
        limit = rough.limit(bound, kept.near[fine_a[rows], -1], rows)
        asking = good[rows, None]  # the others have met all
        row, group = np.nonzero((least <= limit[:, None]) & asking)
        hit, place = np.nonzero(tile[row[:, None], group[:, None] + within] <= limit[row, None])
        row, col = row[hit], group[hit] + within[place]
        if len(rest):
            end_row, end = np.nonzero((tile[:, rest] <= limit[:, None]) & asking)
            row, col = np.concatenate([row, end_row]), np.concatenate([col, rest[end]])
        waiting.append((row + start, usual[col]))
        if sum(len(r) for r, _ in waiting) > most or rows.stop == len(a):
            measure(*(np.concatenate(x) for x in zip(*waiting)))
            waiting.clear()


def _packed(rows: DataFrame, name: str, parts: int, size: int) -> DataFrame:
    """One row for up to ``size`` rows, numbered and frozen: ids, labels and folds as lists, the vectors as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(part: pa.RecordBatch) -> pa.RecordBatch:
            vec, ends = part.column("vec"), pa.array([0, len(part)], pa.int32())
            matrix = vec.flatten().to_numpy(zero_copy_only=False)
            if (np.diff(vec.offsets.to_numpy()) * len(part) != len(matrix)).any():
                raise ValueError("vectors of different lengths")
            lists = [pa.ListArray.from_arrays(ends, part.column(c)) for c in ("id", "label", "fold")]
            return pa.RecordBatch.from_arrays([*lists, pa.array([matrix.tobytes()], pa.binary())], ["id", "label", "fold", "vec"])

        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            while len(rest) >= size:
                yield closed(rest.slice(0, size))
                rest = rest.slice(size)
        if rest is not None and len(rest):
            yield closed(rest)

    packs = rows.repartition(parts).mapInArrow(pack, "id array<bigint>, label array<int>, fold array<int>, vec binary")
    return freeze(packs.withColumn("pack", F.monotonically_increasing_id()), name)


def _numbers(cell: pa.ListScalar, missing: int) -> np.ndarray:
    return cell.values.cast(pa.int64()).fill_null(missing).to_numpy(zero_copy_only=False)


_KEPT = "pack bigint, p int, id array<bigint>, label array<int>, fold array<int>, near binary, other binary, nlabel binary"


def _searching(k: int, ps: Sequence[int], by_fold: bool, kind: str):
    """Kernel of a task: for each pack the k nearest in all blocks of its section, one row of ``_KEPT`` for every p."""

    def matrix(cell: pa.BinaryScalar, n: int) -> np.ndarray:
        return np.frombuffer(cell.as_buffer(), kind).reshape(n, -1).astype("float64")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, folds, kept, lists = None, None, None, {}, []

        def closed() -> pa.RecordBatch:
            found = [[now] * len(ps), list(ps), *([x] * len(ps) for x in lists)]
            found += [[getattr(kept[p], x).tobytes() for p in ps] for x in ("near", "other", "label")]
            kinds = [pa.int64(), pa.int32(), *(pa.list_(x) for x in (pa.int64(), pa.int32(), pa.int32())), *[pa.binary()] * 3]
            arrays = [pa.array([x.as_py() if isinstance(x, pa.Scalar) else x for x in c], t) for c, t in zip(found, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["pack", "p", "id", "label", "fold", "near", "other", "nlabel"])

        for batch in batches:
            cells = {c: batch.column(c) for c in batch.schema.names}
            for i in range(len(batch)):
                if cells["pack"][i].as_py() != now:
                    if now is not None:
                        yield closed()
                    now, lists = cells["pack"][i].as_py(), [cells[c][i] for c in ("id", "label", "fold")]
                    asked, folds = matrix(cells["vec"][i], len(lists[0])), _numbers(lists[2], MISSING)
                    kept = {p: _Kept(len(asked), k) for p in ps}
                ids = _numbers(cells["kid"][i], np.iinfo("int64").max)
                labels, known = _numbers(cells["klabel"][i], MISSING), matrix(cells["kvec"][i], len(ids))
                apart = (folds, _numbers(cells["kfold"][i], MISSING)) if by_fold else None
                for p in ps:
                    _search(kept[p], asked, known, ids, labels, p, apart)
        if now is not None:
            yield closed()

    return search


def _merging(k: int):
    """Kernel of a partition sorted by pack and p: what the sections have kept for a pack becomes one row."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, kept = None, None

        def closed() -> pa.RecordBatch:
            cells = {"near": kept.near, "other": kept.other, "nlabel": kept.label}
            return pa.RecordBatch.from_arrays(
                [pa.array([cells[c].tobytes()], pa.binary()) if c in cells else first.column(c) for c in first.schema.names],
                first.schema.names,
            )

        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                n = len(one.column("id")[0])
                near, other, label = (
                    np.frombuffer(one.column(c)[0].as_buffer(), t) for c, t in (("near", "float64"), ("other", "int64"), ("nlabel", "int64"))
                )
                if first is None or any(one.column(c)[0] != first.column(c)[0] for c in ("pack", "p")):
                    if first is not None:
                        yield closed()
                    first, kept = one, _Kept(n, k)
                kept.add(np.repeat(np.arange(n), k), near, other, label)
        if first is not None:
            yield closed()

    return merge


def _voting(ks: Sequence[int], smallest: int | None):
    """Kernel that reads ``_KEPT``: the vote of every asked row for every k; the smaller label wins a tie."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                cell = {c: batch.column(c)[i] for c in batch.schema.names}
                n = len(cell["id"])
                near = np.frombuffer(cell["near"].as_buffer()).reshape(n, -1)
                label = np.frombuffer(cell["nlabel"].as_buffer(), "int64").reshape(n, -1)
                finite = np.isfinite(near)
                same = (label[:, :, None] == label[:, None, :]) & finite[:, :, None] & finite[:, None, :]
                for k in ks:
                    votes = same[:, :k, :k].sum(axis=2)
                    most = votes.max(axis=1, keepdims=True)
                    chosen = np.where(votes == most, label[:, :k], np.iinfo("int64").max).min(axis=1)
                    # With no finite distance the vote falls to the smallest label of all fitted rows.
                    chosen = np.where(most[:, 0] > 0, chosen, MISSING if smallest is None else smallest)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(cell[c].values for c in ("id", "label", "fold")),
                            *(pa.array(np.full(n, x, "int32")) for x in (cell["p"].as_py(), k)),
                            pa.array(chosen.astype("int32")),
                        ],
                        ["id", "label", "fold", "p", "k", "predicted"],
                    )

    return vote


def _votes(rows: DataFrame, train: DataFrame, ks: Sequence[int], ps: Sequence[int], most: int | None, by_fold: bool) -> DataFrame:
    """``id, label, fold, p, k, predicted`` of each row for all k and p.

    Every asked row meets every fitted row: a task takes the packs of one partition through the blocks of one section,
    keeping the nearest ``max(ks)`` of each row. With more than one section a grouping by pack keeps the nearest of all.
    Nothing passes through the driver but the counts of rows, the width of the vectors and the smallest label.
    """
    ks, ps, spark = sorted(ks), tuple(ps), rows.sparkSession
    single = all(dict(d.dtypes)["vec"] == "array<float>" for d in (rows, train))
    vec = F.col("vec").cast("array<float>" if single else "array<double>").alias("vec")
    fold = F.col("fold").cast("int") if "fold" in train.columns else F.lit(-1)
    known = train.filter(F.col("vec").isNotNull()).select("id", F.col("label").cast("int").alias("label"), fold.alias("fold"), vec)
    if most is not None:
        known = known.orderBy(F.xxhash64("id"), "id").limit(most)
    afold = F.col("fold").cast("int") if by_fold else F.lit(-1)
    label = F.col("label").cast("int") if "label" in rows.columns else F.lit(0)
    asked = rows.filter(F.col("vec").isNotNull()).select("id", label.alias("label"), afold.alias("fold"), vec)
    n = asked.count()
    total = known.agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("smallest"), F.max(F.size("vec")).alias("width")).first()
    width = max(1, total.width or 0) * (4 if single else 8)
    size = max(1, min(BLOCK_ROWS, PACK_BYTES // width))
    # Not fewer packs than tasks are wanted, not more than there are rows; a section of blocks is bounded by its bytes.
    packs = max(1, -(-n // size), min(n, TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    blocks, sections = max(1, -(-total.n // size)), max(1, -(-total.n * width // SECTION_BYTES))
    asked = _packed(asked, "knn_asked", packs, size).repartitionByRange(packs, "pack")
    known = _packed(known, "knn_known", blocks, size).select(*(F.col(c).alias(f"k{c}") for c in ("id", "label", "fold", "vec")))
    known = known.coalesce(sections)
    pairs = asked.crossJoin(known.hint("shuffle_replicate_nl"))
    search, vote = _searching(max(ks), ps, by_fold, "float32" if single else "float64"), _voting(ks, total.smallest)
    out = "id bigint, label int, fold int, p int, k int, predicted int"
    if sections == 1:
        return pairs.mapInArrow(lambda batches: vote(search(batches)), out)
    merge = _merging(max(ks))
    kept = pairs.mapInArrow(search, _KEPT).repartition(packs, "pack").sortWithinPartitions("pack", "p")
    return kept.mapInArrow(lambda batches: vote(merge(batches)), out)


def classify(
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int] | None = None,
    ps: Sequence[int] = (1, 2),
    most: int | None = None,
) -> DataFrame:
    """``id, k, predicted, p``: majority label of every test row for each (p, k); the smaller label wins a tie.

    All labelled rows are fitted; ``most``, if given, bounds them to those first by the hash of their id.
    """
    return _votes(test, train, ks or range(1, 11), ps, most, by_fold=False).select("id", "k", "predicted", "p")


def cross_validate(
    rows: DataFrame, ks: Sequence[int] | None = None, ps: Sequence[int] = (1, 2), most: int | None = None
) -> DataFrame:
    """Mean accuracy over the folds for each (p, k), best first. ``rows``: id, label, vec and a fold number.

    One pass: a row is compared with the fitted rows of all other folds, for all k and p at once.
    """
    hit = (F.col("label") == F.col("predicted")).cast("double")
    per_fold = (
        _votes(rows, rows, ks or range(1, 11), ps, most, by_fold=True)
        .groupBy("p", "k", "fold")
        .agg(F.avg(hit).alias("score"))
    )
    return per_fold.groupBy("p", "k").agg(F.avg("score").alias("cv_accuracy")).orderBy(F.desc("cv_accuracy"), "p", "k")
