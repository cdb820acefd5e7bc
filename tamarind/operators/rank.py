"""Exact row numbers and scores without ever sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.session import freeze

# Bits that monotonically_increasing_id() leaves for the position inside a partition (documented layout).
_POSITION_BITS = 33


def _ascending(name: str) -> Column:
    return F.col(name).asc_nulls_first()


def global_row_number(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Number all rows 1..n in the given order. The order has to be total (end it with a unique key).

    One range shuffle sorts the rows across all tasks, so no task sees more than its share, whatever the ties. The
    sorted positions are frozen to storage because range boundaries come from sampling and may differ in a re-run. The
    only thing broadcast is one row per partition.
    """
    keys = [_ascending(k) if isinstance(k, str) else k for k in order_by]
    placed = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    )
    frozen = freeze(placed, "ranked")
    split = frozen.withColumns(
        {
            "_part": F.shiftright("_place", _POSITION_BITS),
            "_position": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        split.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_position") + 1)
        .drop("_part", "_place", "_position", "_start")
    )


def bucket_of_rank(rank: Column, total: Column, buckets: int = 5) -> Column:
    """Bucket k is the first one with rank <= k/buckets of the total. This is not ``ntile``: sizes round down, not up."""
    score = F.lit(buckets)
    for k in range(buckets - 1, 0, -1):
        score = F.when(rank * buckets <= total * k, F.lit(k)).otherwise(score)
    return score


def rank_measures(
    df: DataFrame, key: str, measures: Sequence[tuple[str, bool]], suffix: str = "_rank"
) -> DataFrame:
    """Global row number of every measure at once: ``(name, descending)``, nulls lowest, ties by ``key``.

    The measures are stacked into one long frame, so a single range shuffle ranks them all, and one grouping by key
    brings them back side by side. Returns key, measures, ranks and ``total`` (the number of keys).
    """
    # Descending order is ascending order of the negated value; a null has to come last then.
    stacked = df.select(
        F.col(key).alias("_key"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("m"),
                        (F.col(c).isNull() == F.lit(descending)).cast("int").alias("side"),
                        (-F.col(c).cast("double") if descending else F.col(c).cast("double")).alias("v"),
                    )
                    for i, (c, descending) in enumerate(measures)
                ]
            )
        ).alias("_e"),
    ).select("_key", "_e.*")
    ranked = global_row_number(stacked, ["m", "side", "v", "_key"], "_rank")
    total = ranked.filter(F.col("m") == 0).select(F.count(F.lit(1))).scalar()
    sides = ranked.withColumn("_total", total).withColumn("_rank", F.col("_rank") - F.col("m") * F.col("_total"))
    picks = []
    for i, (c, descending) in enumerate(measures):
        value = -F.col("v") if descending else F.col("v")
        picks.append(F.max(F.when(F.col("m") == i, value)).alias(c))
        picks.append(F.max(F.when(F.col("m") == i, F.col("_rank"))).alias(f"{c}{suffix}"))
    return sides.groupBy(F.col("_key").alias(key)).agg(*picks, F.first("_total").alias("total"))


def best_per_group(df: DataFrame, group: Sequence[str], order: Column, *, name: str = "_rank") -> DataFrame:
    """All rows tied for the first place of their group.

    Meant for rows that are already aggregated below the group: the filter on the rank lets every task drop its own
    losers before the shuffle, so that a hot group ships only a few rows per task.
    """
    window = Window.partitionBy(*group).orderBy(order)
    return df.withColumn(name, F.dense_rank().over(window)).filter(F.col(name) == 1).drop(name)
