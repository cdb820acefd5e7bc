"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest: one row per distinct text with the id of the row that stays. New data
is reduced to one row per digest, dropped where the index knows the digest by a sort-merge anti-join that does not move
the index, and the rest is appended in the same buckets.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.llm.scratch import freeze, release
from tamarind.llm.texts import spaced

#: A digest held by at least 1/HOT_SHARE of the rows of a batch is hot. There are at most 2 * HOT_SHARE of them, whatever
#: the size of the data, so they may be broadcast; all others are joined by shuffle, where no key can exceed that share.
HOT_SHARE = 10_000


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null as empty text."""
    return F.regexp_replace(spaced(text), " {2,}", " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lower-case hex."""
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """A table ``digest, keep_id`` bucketed and sorted by ``digest``, kept in the session's warehouse.

    ``keep_id`` is the smallest id of its text in the batch that brought the text first; later batches never change it.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.name, self.id_type = spark, name, id_type
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        if self.exists():
            return self.spark.table(self.name)
        return self.spark.createDataFrame([], f"digest string, keep_id {self.id_type}")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, classes: DataFrame) -> None:
        """Add ``digest, keep_id`` rows whose digests the index does not hold yet and that are distinct."""
        known = self.read()
        fresh = classes.join(known.select("digest").hint("merge"), "digest", "left_anti") if self.exists() else classes
        (
            fresh.select("digest", F.col("keep_id").cast(self.id_type))
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def deduplicate(rows: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's ``id_col, keep_id, group_size, kept, text_sha256``; new texts are appended to the index.

    Of equal texts in a batch the smallest id stays (a null id only if all are null); a text the index knew before keeps
    the id stored then, and no row of the batch stays. ``group_size`` counts the rows of the batch with the text. Null
    and empty texts are equal, and equal to nothing but themselves; text of blanks only is a single space. If the kept
    row's id occurs on several rows with the text, one of them is kept. An empty table gives no rows and adds nothing.
    Other columns of ``rows``, whatever their names, are not read.
    """
    # Repeated rows become one row with a count before anything is dealt by digest.
    counted = freeze(
        rows.select(F.col(id_col).alias("_id"), text_digest(F.col(text_col)).alias("digest"))
        .groupBy("digest", "_id")
        .agg(F.count(F.lit(1)).alias("_copies")),
        "digests",
    )
    sized = _new_classes(counted, index)
    return _answered(counted, sized, id_col)


def _new_classes(counted: DataFrame, index: DigestIndex) -> DataFrame:
    """Append what the index does not know, and say of every digest of the batch what the index says then."""
    classes = counted.groupBy("digest").agg(F.min("_id").alias("_first"), F.sum("_copies").alias("group_size"))
    had = freeze(index.read(), "known") if index.exists() else None
    index.append(classes.select("digest", F.col("_first").alias("keep_id")))
    sized = classes.drop("_first").join(index.read().hint("merge"), "digest")
    if had is None:
        return freeze(sized.withColumn("_new", F.lit(True)), "classes")
    old = had.select("digest", F.lit(True).alias("_old"))
    sized = sized.join(old.hint("merge"), "digest", "left").withColumn("_new", F.col("_old").isNull()).drop("_old")
    sized = freeze(sized, "classes")
    release(had)
    return sized


def _answered(counted: DataFrame, sized: DataFrame, id_col: str) -> DataFrame:
    """One row for each row of the batch, with what is known of its digest."""
    n = sized.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") >= F.lit(max(2, n // HOT_SHARE))
    # Exact way for both: the few hot digests by broadcast, all others by sort-merge join.
    marked = counted.join(
        F.broadcast(sized.filter(hot).select("digest", "keep_id", "group_size", "_new", F.lit(True).alias("_hot"))),
        "digest",
        "left",
    )
    few = marked.filter("_hot")
    many = marked.filter("_hot is null").select("digest", "_id", "_copies").join(
        sized.filter(~hot).hint("merge"), "digest"
    )
    columns = ["digest", "_id", "_copies", "keep_id", "group_size", "_new"]
    every = few.select(*columns).unionByName(many.select(*columns))
    return every.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_new") & F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate_batches(
    batches: list[DataFrame], index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Batches in order through one index, as ``deduplicate``; ``group_size`` counts the rows of all batches.

    Each batch meets what those before it have left in the index. For the smallest id of a text to stay, lower ids have to
    come in earlier batches, null ids in the last. Everything between is deleted at the end; the index stays.
    """
    counted, classes = [], []
    for rows in batches:
        counted.append(
            freeze(
                rows.select(F.col(id_col).alias("_id"), text_digest(F.col(text_col)).alias("digest"))
                .groupBy("digest", "_id")
                .agg(F.count(F.lit(1)).alias("_copies")),
                "digests",
            )
        )
        classes.append(_new_classes(counted[-1], index))
    # A digest has one row for each batch that holds it, all with one keep_id, and is new in one of them at most.
    sized = freeze(
        reduce(DataFrame.unionByName, classes).groupBy("digest").agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").cast("bigint").alias("group_size"),
            F.bool_or("_new").alias("_new"),
        ),
        "classes",
    )
    # An id that occurs in several batches with one text is still one row with a count.
    rows = reduce(DataFrame.unionByName, counted).groupBy("digest", "_id").agg(F.sum("_copies").alias("_copies"))
    out = freeze(_answered(rows, sized, id_col), "answers")
    release(*counted, *classes, sized)
    return out


def document_duplicates(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """All documents through an index of their own, in two batches: lower ids first, null ids with the second.

    The second batch meets the filled index: the anti-join leaves what the first did not bring, and this is appended. The
    index is dropped at the end; whoever wants to keep it calls ``deduplicate`` with a name.
    """
    middle = documents.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("bigint")).first()[0]
    low = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("bigint"), F.lit(False))
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    out = deduplicate_batches([documents.filter(low), documents.filter(~low)], index)
    index.drop()
    return out


def without_duplicates(
    rows: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns; of rows equal in id and text one stays. See ``deduplicate``."""
    kept = (
        deduplicate(rows, index, id_col=id_col, text_col=text_col)
        .filter("kept")
        .select(F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_keep_digest"))
    )
    named = rows.withColumn("_digest", text_digest(F.col(text_col)))
    met = named.join(
        kept, F.col(id_col).eqNullSafe(F.col("_keep")) & (F.col("_digest") == F.col("_keep_digest")), "left_semi"
    )
    return met.dropDuplicates([id_col, "_digest"]).drop("_digest")
