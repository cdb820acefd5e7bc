"""URL rules and a blocked Bloom filter in front of an exact join with a list of canonical URLs.

The filter is a table of blocks of eight 64-bit words. Each listed URL sets one bit in every word of the one block its hash
names, so a test touches a single row. What passes is checked by an exact join on the URL, which removes false positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.texts import lower_ascii

#: Blocks of a filter. 64 bytes each, 8 MB in all, so that broadcasting it is bounded however long the list is; a longer
#: list only lets more rows through to the exact join. At 16 bits a URL this size serves four million URLs.
BLOCKS = 1 << 17
WORDS = 8

#: The rules of the registered query: (host, path prefix, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Words in a host name that put its pages on the list of the registered query.
LISTED_WORDS = ("casino", "bets", "pills")
#: A URL held by at least 1/HOT_SHARE of the rows that the filter lets through is hot; there are at most HOT_SHARE of them.
HOT_SHARE = 10_000

def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path from there up to ``? #``.

    A null URL or one without ``://`` has neither (both empty).
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    # Without "/" the rest after the host starts with ? or #, so that the path is empty.
    return lower_ascii(host), path


def canonical_url(host: Column, path: Column) -> Column:
    """One spelling of a page: no scheme, port, ``www.`` or ``m.``, final ``.html`` or slashes; query and fragment gone."""
    bare = F.regexp_replace(F.regexp_replace(host, r":[0-9]*$", ""), r"^(?:www|m)\.(?=[^.]+\.)", "")
    return F.concat(bare, F.regexp_replace(path, r"(?:/index)?(?:\.html?)?/*$", ""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits host (or a parent of it) and path; null where none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, prefix, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        chosen = F.when(
            fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(chosen)
    return chosen


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _bits(url: Column) -> list[Column]:
    """One bit for each word, six hash bits apiece."""
    h = F.xxhash64(url, F.lit("bits"))
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        )
        for i in range(WORDS)
    ]


def bloom_filter(listed: DataFrame, url: str = "url", blocks: int = BLOCKS) -> DataFrame:
    """The filter of the URLs in ``listed``: ``block`` and the words ``w0 .. w7``; at most ``blocks`` rows."""
    rows = listed.filter(F.col(url).isNotNull()).select(
        _block(F.col(url), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(url)))]
    )
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def in_list(rows: DataFrame, listed: DataFrame, url: str, *, blocks: int = BLOCKS, name: str = "listed") -> DataFrame:
    """Add ``name``: whether the row's ``url`` is one of ``listed.url``. Exact; nulls are never listed.

    Rows that the filter rules out never leave their task. Of the rest every URL is counted, so that one row for each URL
    meets the distinct list. The answer goes back by broadcast for hot URLs, few by arithmetic, and by a join for the
    others, none of which many rows share.
    """
    filter_rows = F.broadcast(bloom_filter(listed, "url", blocks))
    tested = rows.withColumn("_block", _block(F.col(url), blocks)).join(
        filter_rows.withColumnRenamed("block", "_block"), "_block", "left"
    )
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col(url))):
        hit &= F.col(f"w{i}").bitwiseAND(bit) != 0
    tested = tested.withColumn("_hit", F.coalesce(hit & F.col(url).isNotNull(), F.lit(False))).drop(
        "_block", *[f"w{i}" for i in range(WORDS)]
    )
    possible = tested.filter("_hit").drop("_hit")
    known = listed.filter(F.col("url").isNotNull()).select(F.col("url").alias("_url"), F.lit(True).alias("_known")).distinct()
    counted = possible.groupBy(F.col(url).alias("_url")).agg(F.count(F.lit(1)).alias("_n"))
    answers = counted.join(known, "_url", "left").select("_url", "_n", F.col("_known").isNotNull().alias("_in"))
    hot = F.col("_n") * HOT_SHARE >= counted.agg(F.sum("_n")).scalar()
    few = F.broadcast(answers.filter(hot).select("_url", F.col("_in").alias("_hot_in")))
    met = possible.join(few, F.col(url) == F.col("_url"), "left").drop("_url")
    rest = answers.filter(~hot & F.col("_in")).select("_url", F.lit(True).alias("_in"))
    confirmed = met.filter("_hot_in is null").join(rest, F.col(url) == F.col("_url"), "left")
    return (
        tested.filter(~F.col("_hit"))
        .drop("_hit")
        .withColumn(name, F.lit(False))
        .unionByName(met.filter("_hot_in is not null").withColumn(name, F.col("_hot_in")).drop("_hot_in"))
        .unionByName(confirmed.withColumn(name, F.col("_in").isNotNull()).drop("_hot_in", "_url", "_in"))
    )


def parsed(pages: DataFrame) -> DataFrame:
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    return parts.withColumn("canonical", F.when(F.col("host") != "", canonical_url(F.col("host"), F.col("path"))))


def listed_urls(pages: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """``url``: canonical URLs of all pages whose host name holds one of the words; the list of the registered query."""
    found = F.lit(False)
    for word in words:
        found |= F.contains(F.col("host"), F.lit(word))
    return parsed(pages).filter(found).select(F.col("canonical").alias("url"))


def judge_pages(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, blocks: int = BLOCKS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and ``listed`` for every page.

    The longest fitting rule decides; where none fits, pages whose canonical URL is on the list are blocked and all
    others allowed. Pages without a host are allowed. Repeated rows stay repeated; other columns are not read.
    """
    judged = in_list(parsed(pages), listed, "canonical", blocks=blocks).withColumn(
        "_rule", rule_of(F.col("host"), F.col("path"), rules)
    )
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_list).alias("verdict"),
        "listed",
    )
