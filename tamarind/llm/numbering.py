"""Gapless row numbers by value, with no task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash ranges a group is cut into. A hot group of n rows is sorted as n / BUCKETS rows a task.
BUCKETS = 4096


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    *,
    group: Sequence[str] = (),
    weight: Column | None = None,
    name: str = "number",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Number the rows of each group from 0, in an order fixed by a hash of the ``order`` columns and then by them.

    Rows are dealt by (group, hash bucket), numbered there, and shifted by the rows of the buckets before, so the work
    of one key is split and a lost task gives the same numbers again. With ``weight``, a row takes that many numbers and
    ``name`` holds the first. Rows that agree in all ``order`` columns take neighbouring numbers in any order; aggregate
    them into a weight first where they may be many. Nulls in ``group`` form a group of their own.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    placed = df.withColumns({"_bucket": F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"), "_weight": weight})
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    sizes = placed.groupBy(*keys).agg(F.sum("_weight").alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_start_{c}") for c in keys], F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    match = F.lit(True)
    for c in keys:
        match &= F.col(c).eqNullSafe(F.col(f"_start_{c}"))
    if not group:  # at most ``buckets`` rows
        starts = F.broadcast(starts)
    return (
        inside.join(starts, match)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_bucket", "_weight", "_inside", "_start", *[f"_start_{c}" for c in keys])
    )
