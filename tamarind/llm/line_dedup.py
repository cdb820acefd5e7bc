"""Lines that many documents share stay in one of them only.

Lines are exploded with their positions and reduced to a hash of their normalised form. One row for each (hash, document)
is counted by hash; the lines over the threshold are met again by hash, and each document is put together from the
positions that are left. Texts move once, to meet their dropped positions; everything else is hashes and numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.scratch import freeze, release
from tamarind.llm.texts import let, lower_ascii

#: White space that is stripped at both ends of a line.
BLANKS = " \t\n\u000b\f\r"
#: Shorter lines are never dropped, and longer ones only if so many documents hold them.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: A line that makes up 1/HOT_SHARE of all places where shared lines stand is hot. There are at most HOT_SHARE of them,
#: whatever the size of the data, so they may be broadcast; the others are met by shuffle, where none exceeds that share.
HOT_SHARE = 10_000


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _long_lines(rows: DataFrame, least_chars: int) -> DataFrame:
    """``_id, _of, _pos, _hash`` of the lines that are long enough. MD5, since 64 bits would let lines collide at size."""
    lines = rows.select("_id", "_of", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    long = lines.filter(F.length(F.btrim("_line", F.lit(BLANKS))) >= least_chars)
    return long.select("_id", "_of", "_pos", F.unhex(F.md5(line_key(F.col("_line")))).alias("_hash"))


def _dropped(lines: DataFrame, least_docs: int) -> DataFrame:
    """``_id, _of, _pos`` of the lines that go."""
    # Counted by (hash, document) first: what is dealt by hash alone has been reduced in each task.
    counted = lines.groupBy("_hash", "_id").agg(F.count(F.lit(1)).alias("_times"))
    shared = freeze(
        counted.groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keep"), F.sum("_times").alias("_places"))
        .filter(F.col("_docs") >= least_docs)
        .select("_hash", "_keep", "_places"),
        "shared_lines",
    )
    places = shared.agg(F.sum("_places")).first()[0] or 0
    hot = F.col("_places") > places // HOT_SHARE
    marked = lines.join(
        F.broadcast(shared.filter(hot).select("_hash", "_keep", F.lit(True).alias("_hot"))), "_hash", "left"
    )
    columns = ["_id", "_of", "_pos", "_keep"]
    few = marked.filter("_hot").select(*columns)
    rest = marked.filter("_hot is null").drop("_keep", "_hot")
    many = rest.join(shared.filter(~hot).select("_hash", "_keep"), "_hash").select(*columns)
    return few.unionByName(many).filter(~F.col("_id").eqNullSafe(F.col("_keep"))).drop("_keep")


def drop_shared_lines(
    rows: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """All rows with all columns, ``text_col`` without its shared lines, and ``n_lines`` (before) and ``n_dropped``.

    A line is shared if its key has ``least_chars`` code points and ``least_docs`` documents hold it; it stays, as often as
    it occurs, in the document with the largest id. A document is an id: rows that repeat an id count once, and are cleaned
    alike. A missing id is a document of its own that comes before all others. Null and empty texts are one empty line and
    come out empty; so does a text that loses every line. Columns of the rows called ``n_lines`` or ``n_dropped`` are
    replaced, other names do not matter. An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    # The hash of the text tells rows apart that share an id, as positions only hold for one text.
    named = packed.select("_row", F.col(f"_row.`{id_col}`").alias("_id"), F.xxhash64(text).alias("_of"))
    lines = freeze(
        _long_lines(packed.select(F.col(f"_row.`{id_col}`").alias("_id"), F.xxhash64(text).alias("_of"), text.alias("_text")),
                    least_chars),
        "lines",
    )
    drops = freeze(
        _dropped(lines, least_docs).groupBy("_id", "_of").agg(F.collect_set("_pos").alias("_drop")), "dropped_lines"
    )
    release(lines)
    met = named.join(
        drops.select(F.col("_id").alias("_id2"), F.col("_of").alias("_of2"), "_drop"),
        F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_of") == F.col("_of2")),
        "left",
    )

    def left(parts: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_drop"))
        return F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")

    kept = F.when(F.col("_drop").isNull(), text).otherwise(let(F.split(text, "\n"), left))
    others = [
        kept.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)
        for c in rows.columns
        if c not in ("n_lines", "n_dropped")
    ]
    return met.select(
        *others,
        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def document_lines(documents: DataFrame) -> DataFrame:
    """All documents without shared lines; what is left as SHA-256 of its UTF-8."""
    cleaned = drop_shared_lines(documents.select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
