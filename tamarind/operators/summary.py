"""Counts, shares and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.functions.numbers import percent
from tamarind.operators.rank import global_row_number


def value_counts(df: DataFrame, *columns: str, name: str = "total") -> DataFrame:
    """Frequency of each combination, nulls left out, most frequent first."""
    return (
        df.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *columns)
    )


def numbered_values(df: DataFrame, column: str) -> DataFrame:
    """Frequency table with zero-based positions, most frequent first and equal counts in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("total"))
    numbered = global_row_number(counts, [F.desc("total"), F.asc(column)], "position")
    return numbered.withColumn("position", F.col("position") - 1)


def counted_by(df: DataFrame, keys: Sequence[str], counted: str, name: str = "total_employees") -> DataFrame:
    """Number of non-null ``counted`` per key combination; rows with a null key are left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(counted).alias(name))


def add_share(groups: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Percentage of ``value`` in its total over all rows of an aggregated frame."""
    return groups.withColumn(name, percent(F.col(value), groups.agg(F.sum(value)).scalar()))


def headcount(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: number of rows, and number of rows per condition, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(cond).alias(name) for name, cond in conditions.items()]
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and null percentage of every column, from a single aggregate row turned on its side."""
    total = F.count(F.lit(1))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
            (F.try_divide(F.count_if(F.col(f"`{c}`").isNull()).cast("double"), total.cast("double")) * 100.0).alias("null_pct"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def columns_of_type(df: DataFrame, *, text: bool) -> list[str]:
    """Names of the text columns, or of all the others."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) == text]


def column_profile(df: DataFrame, list_below: int = 50) -> DataFrame:
    """Type, row count, number of distinct values (null counts as one) and, when there are few, the values themselves.

    Every (column, value) pair is grouped on its own, so wide columns spread over all tasks and a hot value is combined
    before the shuffle. Only lists shorter than ``list_below`` are ever put together.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
            )
        )
    )
    values = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = values.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
    )
    short = sizes.filter(F.col("n_distinct") < list_below).select("column_name")
    lists = (
        values.join(short, "column_name", "left_semi")
        .groupBy("column_name")
        .agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("value_list"))
    )
    type_of = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return sizes.join(lists, "column_name", "left").withColumn("data_type", type_of[F.col("column_name")])


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency tables of several columns in one pass, as ``column_name, value, total``; nulls left out."""
    cells = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    )
    return cells.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("total"))
