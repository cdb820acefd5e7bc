"""One large CSV file read by many tasks, line breaks inside cells included.

The text source cuts a file into byte ranges and hands every line to one of them. A line break belongs to a cell exactly
when an odd number of quotes stands before it in the file. So a first pass counts the quotes of each range, the parity of
all ranges before it says whether a range begins inside a cell, and a second pass puts the lines of each record together
where they lie. Only the pieces of records that cross a border between ranges meet by shuffle: two pieces a border.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_RANGE = "file string, start bigint, length bigint"
_PIECE = "file string, owner bigint, start bigint, first boolean, whole boolean, record string"
#: (file, start) -> (length, whether the range begins inside a cell, start of the range where that cell's record begins)
Borders = dict[tuple[str, int], tuple[int, bool, int]]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"),
        "value",
    )


def _survey() -> Callable:
    """Per range: whether its quotes are odd, and whether a record begins in it should the range begin inside a cell."""

    def survey(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, odd, opens = None, 0, False

        def row():
            names = ("file", "start", "length", "odd", "opens")
            return pa.RecordBatch.from_pylist([dict(zip(names, (*key, bool(odd), opens)))], pa.schema([
                ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("odd", pa.bool_()), ("opens", pa.bool_())
            ]))

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            quotes = batch.column(3).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(keys):
                upto = at + 1
                while upto < len(keys) and keys[upto] == keys[at]:
                    upto += 1
                if keys[at] != key:
                    if key is not None:
                        yield row()
                    key, odd, opens = keys[at], 0, False
                after = (odd + np.cumsum(quotes[at:upto])) & 1
                opens = bool(opens or odd or after[:-1].any())
                odd, at = int(after[-1]), upto
        if key is not None:
            yield row()

    return survey


def _borders(lines: DataFrame) -> Borders:
    """What every range has to know of those before it: one small row for each range, as many as Spark's own file list."""
    found = lines.select("file", "start", "length", "quotes").mapInArrow(_survey(), f"{_RANGE}, odd boolean, opens boolean")
    borders: Borders = {}
    file, inside, owner = None, False, 0
    for r in found.orderBy("file", "start").collect():
        if r.file != file:
            file, inside, owner = r.file, False, r.start
        borders[r.file, r.start] = (r.length, inside, owner)
        if not inside or r.opens:
            owner = r.start
        inside ^= r.odd
    return borders


def _pieces(borders, crossing: bool) -> Callable:
    """Records that lie in one range (``crossing`` false), or the pieces of those that cross a border."""

    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = borders.value
        schema = pa.schema([
            ("file", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("first", pa.bool_()),
            ("whole", pa.bool_()), ("record", pa.string()),
        ])
        key, odd, head, first, held, done = None, 0, False, False, [], []

        def finish(text: str, whole: bool) -> None:
            nonlocal head, first
            if head or not whole:
                # The piece of a record that began before this range, or that goes on after it.
                if crossing:
                    done.append((key[0], known[key[:2]][2] if head else key[1], key[1], first, False, text))
            elif not crossing:
                done.append((key[0], key[1], key[1], first, True, text))
            head = first = False

        def flush():
            nonlocal done
            out, done = done, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            quotes = batch.column(3).to_numpy(zero_copy_only=False)
            values = batch.column(4).to_pylist()
            at = 0
            while at < len(keys):
                upto = at + 1
                while upto < len(keys) and keys[upto] == keys[at]:
                    upto += 1
                if keys[at] != key:
                    if held:
                        finish("\n".join(held), False)
                    key, held = keys[at], []
                    length, inside, _ = known.get(key[:2], (None, False, 0))
                    if length != key[2]:
                        raise RuntimeError(f"{key[0]} was cut differently in the second pass; read it again")
                    odd, head, first = int(inside), inside, key[1] == 0
                after = (odd + np.cumsum(quotes[at:upto])) & 1
                begin = at
                for end in (np.flatnonzero(after == 0) + at).tolist():
                    text = values[end] if begin == end else "\n".join(values[begin : end + 1])
                    finish("\n".join([*held, text]) if held else text, True)
                    held, begin = [], end + 1
                held += values[begin:upto]
                odd, at = int(after[-1]), upto
            if done:
                yield flush()
        if held:
            finish("\n".join(held), False)
        if done:
            yield flush()

    return pieces


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """UTF-8 CSV with a header in every file, cut into byte ranges however its cells contain line breaks.

    Gives the rows of ``files.read_csv`` with that schema: doubled quotes inside quoted cells, empty cells are null, empty
    lines are no rows. Records end with a line feed, with or without a carriage return before it. Every record has at
    least one quote pair or none: a lone quote opens a cell. A range holds ``spark.sql.files.maxPartitionBytes``; a task
    keeps one record and one batch of lines. The file is read once to count, once for the records inside ranges, and once
    more only if a record crosses a border. Files without rows give none.
    """
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    lines = _lines(spark, path)
    borders = _borders(lines)
    known = spark.sparkContext.broadcast(borders)
    whole = lines.mapInArrow(_pieces(known, False), _PIECE).filter(~F.col("first")).select("record")
    if any(inside for _, inside, _ in borders.values()):
        crossing = lines.mapInArrow(_pieces(known, True), _PIECE).groupBy("file", "owner").agg(
            F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"), F.bool_or("first").alias("first")
        )
        joined = crossing.filter(~F.col("first")).select(
            F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")
        )
        whole = whole.unionByName(joined)
    record = F.regexp_replace("record", r"\r\z", "")
    return whole.select(record.alias("record")).filter("record <> ''").select(
        F.from_csv("record", ddl, _OPTIONS).alias("r")
    ).select("r.*")
