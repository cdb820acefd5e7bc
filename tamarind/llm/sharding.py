"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

The permutation is a bijection of 0..n-1 that anybody can compute from (n, seed), so shard and slot of a row number need
no table and no sort by a random key. ``shard = place mod shards`` and ``slot = place div shards`` make shard sizes differ
by one row at most and slots gapless.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.numbering import number_rows

ROUNDS = 6
#: Steps of one walk. A walk leaves 0..n-1 for at most as many steps as there are places beyond n, which are fewer than
#: sqrt(n) + 1; beyond n = 4096 the chance of WALK steps outside is below (1/64)^64, and it would raise, not misplace.
WALK = 64


def _round_key(seed: int, k: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:8], "big", signed=True)


def _div(x: Column, by: int) -> Column:
    """Whole division without a detour through doubles."""
    return F.call_function("div", x, F.lit(by))


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    left, right = _div(x, b), F.pmod(x, F.lit(b))
    for k in range(ROUNDS):
        key = F.lit(_round_key(seed, k))
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, key), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, key), F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def permuted(df: DataFrame, number: str, n: int, seed: int = 0, name: str = "place") -> DataFrame:
    """Add the place of each row number of 0..n-1 under the permutation that (n, seed) names.

    The network works on a grid of a x b >= n places, a = ceil(sqrt n), whose surplus is below a. A place beyond n - 1 is
    sent through the network again until it falls inside, which keeps the map a bijection. ``n <= 1`` is the identity.
    """
    if n <= 1:
        return df.withColumn(name, F.col(number).cast("bigint"))
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    first = df.withColumn("_first", _once(F.col(number).cast("bigint"), a, b, seed))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        F.col("_first"),
        lambda place, _: F.when(place < n, place).otherwise(_once(place, a, b, seed)),
    )
    inside = F.when(F.col("_first") < n, F.col("_first")).otherwise(walked)
    checked = F.when(F.col(name) < n, F.col(name)).otherwise(F.raise_error("walk left the range").cast("bigint"))
    return first.withColumn(name, inside).withColumn(name, checked).drop("_first")


def shard_rows(df: DataFrame, order: list[str], n_shards: int, seed: int = 0) -> DataFrame:
    """The ``order`` columns of every row with ``shard`` (0..n_shards-1) and ``slot`` (gapless from 0 in its shard).

    Law: row counts of any two shards differ by one at most. Rows equal in all ``order`` columns are counted before the
    shuffle, numbered as one and expanded afterwards, so a third of all rows being one row costs nothing. Nulls are values
    like any other. An empty table gives no rows. Names starting with an underscore are reserved; columns beside ``order``
    are not carried, join them by the key.
    """
    n = df.count()
    grouped = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    numbered = number_rows(grouped, order, weight=F.col("_copies"), name="_start_no")
    single = numbered.select(
        *order, F.explode(F.sequence("_start_no", F.col("_start_no") + F.col("_copies") - 1)).alias("_number")
    )
    placed = permuted(single, "_number", n, seed, "_place")
    return placed.select(
        *order,
        F.pmod("_place", F.lit(n_shards)).cast("int").alias("shard"),
        _div(F.col("_place"), n_shards).alias("slot"),
    )


def document_shards(documents: DataFrame, n_shards: int = 40, seed: int = 20) -> DataFrame:
    """Shards of documents: size is the UTF-8 bytes of the text (null: none) plus 16; law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = documents.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(slim, ["doc_id", "size", "text_crc32"], n_shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
