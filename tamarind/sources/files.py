"""Delimited files, nested JSON and table registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled inside quoted cells and cells may hold line breaks and outer blanks.
_CSV = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; an empty cell is null.

    Give a schema for anything large: without one the types are inferred by an extra pass.
    """
    reader = spark.read.options(**_CSV).option("encoding", encoding)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", rows_per_file: int = 1_000_000) -> None:
    """Write a folder of CSV files.

    A file with line breaks inside cells can only be read by one task, so the rows per file are bounded.
    """
    options = {k: v for k, v in _CSV.items() if k != "multiLine"}
    (
        df.write.mode("overwrite")
        .options(**options)
        .option("encoding", encoding)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with an explicit schema."""
    return spark.read.schema(schema).json(path)


def publish(df: DataFrame, name: str) -> DataFrame:
    """Make a frame known to SQL under ``name``, replacing an earlier one."""
    df.createOrReplaceTempView(name)
    return df


def save_table(df: DataFrame, name: str) -> None:
    """Store a frame as a managed table, replacing an earlier one."""
    df.write.mode("overwrite").saveAsTable(name)


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    paths: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*prefix, field.name)
        paths += _leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return paths


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """One column per leaf of nested structs, named by its path. Arrays stay arrays."""
    def quoted(path: tuple[str, ...]) -> str:
        return ".".join(f"`{step}`" for step in path)

    return df.select([F.col(quoted(path)).alias(sep.join(path)) for path in _leaves(df.schema)])


def parse_json(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Replace a JSON text column by the struct it holds."""
    return df.withColumn(column, F.from_json(column, schema))


def unwrap_singletons(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows whose listed arrays all hold exactly one element and replace each array by that element."""
    keep: Column = F.lit(True)
    for name in columns:
        keep = keep & (F.size(name) == 1)
    return df.filter(keep).withColumns({name: F.get(name, F.lit(0)) for name in columns})
