"""Mixing sources to target weights by Pfair scheduling.

A source is cut into blocks of rows. Block i (from 1) of a source of weight w may start at slot floor((i - 1) / w) and has
to be placed before slot ceil(i / w); each slot takes the released block with the earliest deadline. At every slot each
source is then less than one block from its share. Weights are taken as exact fractions, so the error does not add up.

The slots are worked out in segments, each by a task of its own. What a source has got before a border is its share rounded
down or up, and which sources are rounded up follows from the weights and the border alone: two tasks that meet at a border
come to the same numbers, and no state is handed on.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarind.llm.numbering import number_rows
from tamarind.session import freeze

#: The most sources a mix may have.
PERIOD = 16384
#: Rows in a block.
BLOCK_ROWS = 64
#: Blocks in a segment of the schedule; more where the smallest source gets less than one slot in that many.
SEGMENT = 1 << 16


def whole_shares(weights: Mapping[object, float], period: int = PERIOD) -> dict:
    """The weights as whole numbers in exactly their proportions."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources are more than {period}")
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights have to be above 0")
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    return {s: int(w * scale) for s, w in exact.items()}


def _ranked(shares: Mapping[object, int]) -> list:
    return sorted(shares, key=lambda s: (-shares[s], s is None, str(s)))


def _allotted(sizes: Sequence[int], at: int) -> list[int]:
    """Blocks of each source in the slots before ``at``: its share, rounded down or up, ``at`` in all.

    A source whose share is not whole has one loose block, released before ``at`` and due after it. Loose blocks are taken
    by deadline as long as all blocks due before ``at`` still fit in before it. For every slot from which on one counts,
    those released since then may be no more than the slots left (blocks of one slot fit if and only if no interval holds
    too many of them). These bounds are nested, so taking greedily leaves the least to do for every later slot as well.
    """
    total = sum(sizes)
    done = [n * at // total for n in sizes]
    missing = at - sum(done)
    if not missing:
        return done
    loose = [r for r, n in enumerate(sizes) if n * at % total]
    release = {r: done[r] * total // sizes[r] for r in loose}
    due = {r: -(-(done[r] + 1) * total // sizes[r]) for r in loose}
    starts = sorted(set(release.values()))
    low = starts[0]
    needed = np.zeros(at - low, np.int64)
    for r, n in enumerate(sizes):
        np.add.at(needed, np.array([i * total // n - low for i in range(-(-n * low // total), done[r])], np.int64), 1)
    room = np.arange(at - low, 0, -1) - needed[::-1].cumsum()[::-1]
    # Between two releases of loose blocks the tightest slot decides.
    room = np.minimum.reduceat(room[: starts[-1] - low + 1], [0] + [s - low + 1 for s in starts[:-1]])
    for r in sorted(loose, key=lambda r: (due[r], r)):
        upto = bisect_right(starts, release[r])
        if missing and room[:upto].min() > 0:
            room[:upto] -= 1
            done[r] += 1
            missing -= 1
    assert not missing
    return done


def _border(sizes: Sequence[int], counts: Sequence[int], k: int, length: int) -> int:
    """The slot where segment ``k`` begins: sources have some ``k * length`` blocks before it."""
    total = sum(sizes)
    horizon = max(-(-c * total // n) for n, c in zip(sizes, counts))
    if k * length >= sum(counts):
        return horizon
    return bisect_left(
        range(horizon), k * length, key=lambda t: sum(min(c, n * t // total) for n, c in zip(sizes, counts))
    )


def _segment(sizes: Sequence[int], counts: Sequence[int], start: int, stop: int) -> Iterator[tuple[int, int, int, bool]]:
    """(rank of the source, block, slot, whether the source has no such block) of the slots from ``start`` to ``stop``.

    Earliest deadline first among released blocks; ties go to the lower rank. The first block that a source lacks is
    reported with the slot it would get, and leaves that slot to the others.
    """
    total, upto = sum(sizes), _allotted(sizes, stop)
    waiting = [
        (max(start, i * total // sizes[rank]), rank, i)
        for rank, i in enumerate(_allotted(sizes, start))
        if i < upto[rank] and i <= counts[rank]
    ]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slot = start
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, rank, i = heapq.heappop(waiting)
            heapq.heappush(ready, (min(stop, -(-(i + 1) * total // sizes[rank])), rank, i))
        if not ready:
            slot = waiting[0][0]
            continue
        deadline, rank, i = heapq.heappop(ready)
        if i == counts[rank]:
            yield rank, i, slot, True
            continue
        assert deadline > slot
        yield rank, i, slot, False
        if i + 1 < upto[rank]:
            heapq.heappush(waiting, ((i + 1) * total // sizes[rank], rank, i + 1))
        slot += 1


def _segments(sizes: Sequence[int], counts: Sequence[int], length: int) -> tuple[int, int]:
    """Number of segments and blocks in each. A border costs as many steps as the rarest source has slots for a block."""
    if not sizes:
        return 0, length
    length = max(length, -(-sum(sizes) // min(sizes)))
    return -(-sum(counts) // length), length


def schedule(
    shares: Mapping[object, int], blocks: Mapping[object, int], length: int = SEGMENT
) -> tuple[list[tuple[int, int, int]], int]:
    """(rank of the source, block, slot) of every block in slot order, and the first slot that misses a block.

    Every block meets its deadline, since the shares sum to the total. Sources rank by share, then by name. A source that
    has run out takes no part any more; slots where no block of the others is released stay empty. All segments one after
    the other, for schedules of bounded length; ``mix`` has a task for each.
    """
    ranked = _ranked(shares)
    sizes, counts = [shares[s] for s in ranked], [blocks[s] for s in ranked]
    number, length = _segments(sizes, counts, length)
    borders = [_border(sizes, counts, k, length) for k in range(number + 1)] if number else []
    every = [row for a, b in zip(borders, borders[1:]) for row in _segment(sizes, counts, a, b)]
    out = [(rank, i, slot) for rank, i, slot, gone in every if not gone]
    return out, min([slot for _, _, slot, gone in every if gone], default=borders[-1] if borders else 0)


def _slots(spark: SparkSession, sizes: Sequence[int], counts: Sequence[int], length: int) -> DataFrame:
    """``_r, _nth, slot, _gone`` of all segments, a task for each."""
    number, length = _segments(sizes, counts, length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                ends = (_border(sizes, counts, k, length), _border(sizes, counts, k + 1, length))
                rows = _segment(sizes, counts, *ends)
                while part := list(islice(rows, SEGMENT)):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["_r", "_nth", "slot", "_gone"])

    ids = spark.range(0, number, 1, max(1, number))
    return ids.mapInArrow(work, "_r bigint, _nth bigint, slot bigint, _gone boolean")


def one_period(shares: Mapping[object, int]) -> list:
    """The source of every slot until all shares are used up and the schedule would repeat."""
    ranked = _ranked(shares)
    return [ranked[rank] for rank, _, _ in schedule(shares, shares)[0]]


def temperature_weights(sizes: Mapping[object, int], power: float) -> dict:
    """Weights in proportion to size to a power: 1 keeps the shares of the data, 0 makes all sources equal."""
    return {s: float(n) ** power for s, n in sizes.items()}


def mix(
    rows: DataFrame,
    weights: Mapping[object, float] | None = None,
    *,
    power: float = 0.5,
    id_cols: tuple[str, ...] = ("doc_id",),
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    segment: int = SEGMENT,
) -> DataFrame:
    """Place every row once: ``id_cols, source_col, block, slot, offset, weight`` and ``in_target``.

    ``block`` counts a source's blocks from 0, ``slot`` is its slot in the schedule and ``offset`` the row's place in the
    block; rows in the order of (slot, offset) are the mix. No row is dropped or repeated; a source that runs out takes
    no more slots. ``in_target`` is true up to the first slot that misses a block, where every prefix is less than one
    block off the exact weights. A last block may be short. One task works out the slots of some ``segment`` blocks; the
    driver holds the sizes of the sources only.

    Without ``weights`` they are the source sizes to ``power``. A source without a weight raises an error. A null source
    is a source. Rows that agree in ``id_cols`` and source are interchangeable. The order in a source is a hash of the
    ids. Number of sources: at most ``period``, checked. An empty table gives no rows. Other columns are not read; their
    names do not matter, but names starting with an underscore are reserved.
    """
    spark = rows.sparkSession
    slim = rows.select(*id_cols, F.col(source_col).alias("_source"))
    # Repeated rows are one row with a count until they are placed, so that none of them is a hot key.
    counted = freeze(slim.groupBy("_source", *id_cols).agg(F.count(F.lit(1)).alias("_copies")), "counted")
    sizes = {
        r["_source"]: r["n"]
        for r in counted.groupBy("_source").agg(F.sum("_copies").alias("n")).limit(period + 1).collect()
    }
    if weights is None:
        weights = temperature_weights(sizes, power)
    missing = [s for s in sizes if s not in weights]
    if missing:
        raise ValueError(f"no weight for {missing[:5]}")
    shares = whole_shares({s: w for s, w in weights.items() if s in sizes}, period) if sizes else {}
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    ranked = _ranked(shares)
    # Written once: the rows and the first missing block both read it.
    planned = freeze(_slots(spark, [shares[s] for s in ranked], [blocks[s] for s in ranked], segment), "slots")
    slots = planned.filter("not _gone").drop("_gone")
    end = planned.filter("_gone").agg(F.min("slot")).scalar()
    kind, total = dict(slim.dtypes)["_source"], sum(shares.values())
    named = [(s, rank, float(Fraction(shares[s], total))) for rank, s in enumerate(ranked)]
    sources = spark.createDataFrame(named, f"_s {kind}, _rank bigint, weight double")
    numbered = number_rows(counted, list(id_cols), group=["_source"], weight=F.col("_copies"), name="_first")
    single = numbered.select(
        "_source", *id_cols, F.explode(F.sequence("_first", F.col("_first") + F.col("_copies") - 1)).alias("_number")
    )
    # One row per source, ``period`` at most.
    cut = single.join(F.broadcast(sources), F.col("_source").eqNullSafe(F.col("_s"))).withColumn(
        "block", F.call_function("div", "_number", F.lit(block_rows))
    )
    # A (source, block) has ``block_rows`` rows at most, so no key is hot.
    placed = cut.join(slots, (F.col("_rank") == F.col("_r")) & (F.col("block") == F.col("_nth")))
    return placed.select(
        *id_cols,
        F.col("_source").alias(source_col),
        "block",
        "slot",
        F.pmod("_number", F.lit(block_rows)).alias("offset"),
        "weight",
        F.coalesce(F.col("slot") < end, F.lit(True)).alias("in_target"),
    )


def document_mix(documents: DataFrame) -> DataFrame:
    """All documents mixed with weights in proportion to the square root of the size of their source."""
    return mix(documents)


def _with_places(rows: DataFrame, weights: Mapping[object, float] | None = None, **options) -> DataFrame:
    """All rows as ``_row``, with ``mix_slot`` and ``mix_offset`` (see ``mix``)."""
    ids, source = options.get("id_cols", ("doc_id",)), options.get("source_col", "source")
    placed = mix(rows, weights, **options)
    keys = [*ids, source]
    hashed = F.xxhash64(*[c for c in rows.columns])
    left = rows.select(
        *[F.col(c).alias(f"_row_{c}") for c in keys],
        F.row_number().over(Window.partitionBy(*keys).orderBy(hashed)).alias("_nth"),
        F.struct(*rows.columns).alias("_row"),
    )
    right = placed.select(
        *[F.col(c).alias(f"_mix_{c}") for c in keys],
        F.row_number().over(Window.partitionBy(*keys).orderBy("slot", "offset")).alias("_mix_nth"),
        F.col("slot").alias("mix_slot"),
        F.col("offset").alias("mix_offset"),
    )
    match = F.col("_nth") == F.col("_mix_nth")
    for c in keys:
        match &= F.col(f"_row_{c}").eqNullSafe(F.col(f"_mix_{c}"))
    return left.join(right, match).select("_row", "mix_slot", "mix_offset")


def in_mix_order(rows: DataFrame, weights: Mapping[object, float] | None = None, **options) -> DataFrame:
    """All rows with their columns, dealt to partitions and sorted in the order of the mix (see ``mix``).

    Written out, the files read in the order of their names are the mix. Rows that share id and source take each other's
    places in the order of their hash.
    """
    met = _with_places(rows, weights, **options)
    order = [F.col("mix_slot"), F.col("mix_offset")]
    return met.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")


def stored_places(rows: DataFrame) -> DataFrame:
    """``doc_id, text_sha256, mix_place`` of the rows of a stored table: their place in its files, from 0, without a gap.

    Files count in the order of their names and rows in the order inside them, so for what ``in_mix_order`` has written
    this is the mix. The digest is that of the text in UTF-8, null as empty. ``rows`` has to be read from Parquet files as
    it is. What meets in one place is one row a file.
    """
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256")
    found = rows.select(
        "doc_id", digest, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.select(F.col("_metadata.file_path").alias("_of")).groupBy("_of").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.withColumnRenamed("_of", "_file").select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return found.join(F.broadcast(starts), "_file").select("doc_id", "text_sha256", (F.col("_start") + F.col("_at")).alias("mix_place"))
