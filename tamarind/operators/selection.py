"""Exact order statistics without sorting or moving rows: histograms that are refined around the ranks asked for.

A pass counts rows in bins of the values that may still be the answer, for all measures and ranks at once. What meets is a
bounded number of bins; each of them brings its smallest and largest value, so the next pass starts from values that exist,
and every pass tells at least two of them apart. Rows with one value are told apart by their key in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of one bracket. The driver sees so many rows a pass for every (measure, rank) that is still open.
BINS = 1024
#: A bracket with no more rows is read as it is, and its ranks are looked up.
FEW = 4096
_NUMBER = 2


@dataclass(frozen=True)
class Bracket:
    """Rows of a measure that can still hold a rank: one kind of value, and ranges of values and keys (ends included)."""

    measure: int
    kind: int
    low: float
    high: float
    first: int
    last: int
    rows: int

    def settled(self) -> bool:
        return self.low == self.high and self.first == self.last


def _ordered(column: Column, descending: bool) -> tuple[Column, Column]:
    """Kind and value of a measure in ascending order: missing lowest, then numbers with infinities at their ends, then NaN.

    Descending order is that of the negated value, with missing values last. The value is 0 where the kind says it all.
    """
    v = column.cast("double")
    v = (-v if descending else v) + F.lit(0.0)  # one zero only
    kind = (
        F.when(v.isNull(), 5 if descending else 0)
        .when(F.isnan(v), 4)
        .when(v == math.inf, 3)
        .when(v == -math.inf, 1)
        .otherwise(_NUMBER)
    )
    return kind, F.when(kind == _NUMBER, v).otherwise(0.0)


def _log(v: float) -> float:
    return math.copysign(math.log1p(abs(v)), v)


def _bin(value: Column, key: Column, b: Bracket) -> Column:
    """The bin of a row of the bracket: never decreasing, and not the same for both ends of the bracket."""
    if b.low == b.high:
        width = -(-(b.last - b.first + 1) // BINS)
        return F.floor((key.cast("decimal(38,0)") - F.lit(b.first).cast("decimal(38,0)")) / F.lit(width).cast("decimal(38,0)"))
    low, high, v = b.low, b.high, value
    steep = low <= 0 <= high or not 1 / 16 < low / high < 16
    if steep and _log(low) < _log(high):
        low, high, v = _log(low), _log(high), F.signum(value) * F.log1p(F.abs(value))
    share = (v - F.lit(low)) / F.lit(high - low)
    return F.greatest(F.least(F.floor(share * BINS), F.lit(BINS - 1)), F.lit(0))


def order_statistics(
    df: DataFrame, key: str, measures: Sequence[tuple[str, bool]], parts: int
) -> tuple[int, dict[tuple[int, int], Bracket]]:
    """Number of rows n, and for every measure (name, descending) the row at rank ``k * n // parts``, 0 < k < ``parts``.

    ``key`` is a whole number, unique and not null; it orders equal values. A rank of 0 has no row. ``df`` is read once a
    pass, some four to six times, and has to give the same values each time.
    """
    ordered = [_ordered(F.col(name), descending) for name, descending in measures]
    picked = df.select(
        F.col(key).cast("bigint").alias("key"),
        *[c.alias(f"{what}{i}") for i, pair in enumerate(ordered) for what, c in zip(("kind", "value"), pair)],
    )

    def spread(brackets: Sequence[tuple[int, Column, Column, Column]]) -> DataFrame:
        """``key, n, bin, value`` of the rows of each bracket: number, condition, bin, value."""
        hits = [
            F.when(inside, F.struct(F.lit(n).alias("n"), bin_.cast("bigint").alias("bin"), value.alias("value")))
            for n, inside, bin_, value in brackets
        ]
        return picked.select("key", F.inline(F.array(*hits))).filter(F.col("n").isNotNull())

    def count(brackets: Sequence[tuple[int, Column, Column, Column]]) -> dict[int, list]:
        """Per bracket its bins in order."""
        rows = spread(brackets)
        bins = rows.groupBy("n", "bin").agg(
            F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"),
            F.min("key").alias("first"), F.max("key").alias("last"),
        )
        out: dict[int, list] = {}
        for r in sorted(bins.collect(), key=lambda r: r.bin):
            out.setdefault(r.n, []).append(r)
        return out

    def columns(measure: int) -> tuple[Column, Column]:
        return F.col(f"kind{measure}"), F.col(f"value{measure}")

    kinds = count([(i, F.lit(True), columns(i)[0], columns(i)[1]) for i in range(len(measures))])
    n = sum(r.rows for r in kinds.get(0, []))
    ranks = {(i, k): k * n // parts for i in range(len(measures)) for k in range(1, parts)}
    places: dict[tuple[int, int], Bracket] = {}

    def narrow(target: tuple[int, int], bins: list, old: Bracket | None) -> None:
        for r in bins:
            if ranks[target] <= r.rows:
                break
            ranks[target] -= r.rows
        new = Bracket(target[0], r.bin if old is None else old.kind, r.low, r.high, r.first, r.last, r.rows)
        places[target] = new if old is None or old.low < old.high else replace(new, low=old.low, high=old.high)

    for target, rank in list(ranks.items()):
        if rank:
            narrow(target, kinds[target[0]], None)
    while open_ := sorted({b for b in places.values() if not b.settled()}, key=lambda b: (b.measure, b.kind, b.low, b.first)):
        few, many = [], []
        for i, b in enumerate(open_):
            kind, value = columns(b.measure)
            inside = (kind == b.kind) & value.between(b.low, b.high) & F.col("key").between(b.first, b.last)
            (few if b.rows <= FEW else many).append((i, inside, _bin(value, F.col("key"), b), value))
        found = count(many) if many else {}
        rows: dict[int, list] = {}
        for r in spread(few).collect() if few else []:
            rows.setdefault(r.n, []).append((r.value, r.key))
        for target, old in list(places.items()):
            if old.settled():
                continue
            i = open_.index(old)
            if i in found:
                narrow(target, found[i], old)
            else:
                value, at = sorted(rows[i])[ranks[target] - 1]
                places[target] = replace(old, low=value, high=value, first=at, last=at, rows=1)
    return n, places


def bucket_scores(df: DataFrame, key: str, measures: Sequence[tuple[str, bool]], buckets: int = 5) -> DataFrame:
    """``df`` with ``<measure>_score``: the first k with rank <= k / ``buckets`` of the rows. See ``bucket_of_rank``.

    ``measures`` are (name, descending); missing values rank lowest, equal values go by ``key``. The thresholds are learnt
    from counts, and each row is compared with them where it lies.
    """
    kept = df.persist()
    try:
        _, places = order_statistics(kept, key, measures, buckets)
    finally:
        kept.unpersist()
    scores = {}
    for i, (name, descending) in enumerate(measures):
        kind, value = _ordered(F.col(name), descending)
        score = F.lit(1)
        for k in range(1, buckets):
            t = places.get((i, k))
            above = F.lit(True)
            if t is not None:
                later = (value > t.low) | ((value == t.low) & (F.col(key).cast("bigint") > t.first))
                above = (kind > t.kind) | ((kind == t.kind) & later)
            score = score + above.cast("int")
        scores[f"{name}_score"] = score
    return df.withColumns(scores)
