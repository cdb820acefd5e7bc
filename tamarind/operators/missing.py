"""Missing data: columns without any value, rows without required values, imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all. One aggregate over all columns decides; its result is one row."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if counts[c] == 0])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows that miss any of the columns (all columns when none is named)."""
    return df.na.drop(how="any", subset=list(columns) or None)


def fill(df: DataFrame, **values) -> DataFrame:
    """Replace nulls by constants, per column."""
    return df.na.fill(values)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls of numeric columns by the mean of the values present. The means are one scalar row."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    return df.withColumn("_means", means).withColumns(
        {c: F.coalesce(F.col(c), F.col("_means")[c]) for c in columns}
    ).drop("_means")
