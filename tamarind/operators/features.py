"""Feature matrices: one-hot columns, standardised vectors, repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.operators.rank import global_row_number


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Cast the columns (all when none is named) to double; true counts as 1."""
    picked = set(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def cast(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name not in picked:
            return value
        return (value.cast("int") if isinstance(types[name], T.BooleanType) else value).cast("double").alias(name)

    return df.select([cast(c) for c in df.columns])


def distinct_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct texts per column."""
    cells = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]))
    )
    found = cells.na.drop().distinct().collect()
    return {c: sorted(r.v for r in found if r.c == c) for c in columns}


def one_hot(df: DataFrame, columns: Sequence[str], values: dict[str, list[str]] | None = None) -> DataFrame:
    """Replace each column by one 0/1 double column per value, named ``column_value``; a null gives zeros only.

    Without ``values`` one pass collects the sorted distinct values: they become columns of the result, so they have to be
    known to the driver in any case. For columns without a sensible number of values there is ``one_hot_indexed``.
    """
    values = values or distinct_values(df, columns)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    dummies = [
        F.coalesce((F.col(f"`{c}`").cast("string") == F.lit(v)).cast("int"), F.lit(0)).cast("double").alias(f"{c}_{v}")
        for c in columns
        for v in values[c]
    ]
    return df.select(*rest, *dummies)


def one_hot_indexed(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Sparse form of one-hot for columns with very many values: the position of the hot entry, null for a null.

    Positions follow the sorted values. The value list is a distributed table and never reaches the driver.
    """
    name = name or f"{column}_index"
    positions = global_row_number(df.select(column).na.drop().distinct(), [column], name)
    return df.join(positions.withColumn(name, F.col(name) - 1), column, "left")


def vector_size(df: DataFrame, vector: str) -> int:
    """Entries of each vector of an array column. Raises where rows differ; missing vectors do not count."""
    least, most = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries in {vector!r}")
    return most or 0


def vector_statistics(df: DataFrame, vector: str) -> DataFrame:
    """One row: mean and population deviation of every entry of an array column; nulls count in neither."""
    entry = [F.get(F.col(vector), F.lit(i)).cast("double") for i in range(vector_size(df.filter(F.col(vector).isNotNull()), vector))]
    return df.agg(
        F.array(*[F.avg(e) for e in entry]).cast("array<double>").alias("means"),
        F.array(*[F.stddev_pop(e) for e in entry]).cast("array<double>").alias("deviations"),
    )


def standardize_vector(
    df: DataFrame, vector: str, name: str = "standardized", fit_on: DataFrame | None = None
) -> DataFrame:
    """Entries minus mean, divided by the population deviation; an entry without deviation becomes 0, a null stays null.

    Statistics come from ``fit_on`` (the training rows, usually) or from ``df`` itself. All vectors they are taken from
    must have one length; a longer vector in ``df`` has no statistics for its tail and raises an error.
    """
    stats = vector_statistics(fit_on if fit_on is not None else df, vector)
    both = stats.select(F.struct("means", "deviations")).scalar()

    def scaled(x: Column, i: Column) -> Column:
        mean, deviation = F.element_at(F.col("_s.means"), i + 1), F.element_at(F.col("_s.deviations"), i + 1)
        gap = x.cast("double") - mean
        return F.when(deviation == 0, gap * 0).otherwise(gap / F.nullif(deviation, F.lit(0.0)))

    known = F.size(F.col("_s.means"))
    checked = F.when(F.size(vector) > known, F.raise_error("vector longer than the fitted ones").cast("array<double>"))
    return df.withColumn("_s", both).withColumn(name, checked.otherwise(F.transform(vector, scaled))).drop("_s")


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """A bucket 0..buckets-1 that depends on the key and the seed only, not on partitions or engines."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 2) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by hash of the key, the same ones in every run."""
    is_test = hash_bucket(F.col(key), seed, 1000) < round(test_size * 1000)
    return df.filter(~is_test), df.filter(is_test)
