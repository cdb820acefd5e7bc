"""Exact similarity join on word shingles: documents linked by a Jaccard similarity of at least 0.8, as components.

1. A document of n shingles whose partner exists has at most n // 5 shingles that no other document holds. A sample of its
   shingles, chosen by hash and therefore alike in all documents, shows most documents to have more: they have no partner.
   The bound is exact; nothing is estimated. Shingles known to be common count as held by others without being looked up.
2. Documents left with the same set form a class; one stands for it. Shingles are counted over the classes, and each class
   takes its rarest ``n - ceil(0.8 n) + 1``, those known to be common last. Two similar sets share one of these, so classes
   that do form a cluster and no link crosses two. Common passages rank last and bring nobody together.
3. Each cluster is searched by a signature tree. A cluster too large for a task is cut into blocks that also hold the same
   few seeds; what this leaves outside the largest group of its cluster meets all blocks again, in pairs of blocks.
4. Links are closed to components, and members follow their class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.components import components
from tamarind.llm.shingles import Powers, set_digest, shingle_set
from tamarind.llm.signature_tree import link_groups
from tamarind.llm.scratch import freeze, release

WORDS = 5
#: Counters for the order of shingles; the table has this many rows at most and is sent to every task (2 MB).
COUNTERS = 1 << 18
#: Share of a document's shingles by which it is judged, and the size below which all are used.
SAMPLE = 0.3
SMALL = 64
#: Classes in a block of a cluster, and seeds that all blocks of a cluster share.
BLOCK = 2048
SEEDS = 32
#: Bits of the filter that keeps texts without a candidate from moving: a table of fixed size.
FILTER_BITS = 1 << 25


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, powers = np.zeros(COUNTERS, np.int64), Powers()
    for batch in batches:
        for text in _texts(batch):
            s = shingle_set(text, WORDS, powers)
            np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(counts[slots])], ["slot", "n"])


def shingle_levels(rows: DataFrame) -> np.ndarray:
    """How far each counter lies above the mean, in steps that double; 0 for all within the noise of hashing."""
    summed = rows.select("text").mapInArrow(_counters, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNTERS)
    for r in summed.collect():  # COUNTERS rows at most
        counts[r.slot] = r.n
    mean = counts.sum() / COUNTERS
    over = np.maximum(0.0, counts - mean) / (8 * np.sqrt(mean) + 8)
    return np.floor(np.log2(1 + over)).astype(np.uint8)


def prefix_length(n: int) -> int:
    """Shingles of a set of n of which a similar set holds at least one, in any common order."""
    return n - (4 * n + 4) // 5 + 1


def _short(shingles: np.ndarray) -> np.ndarray:
    """The upper 40 bits. Shuffled rows carry these; two shingles that agree in them only bring more candidates."""
    return (shingles >> np.uint64(24)).view(np.int64)


def _samples(levels):
    """One row per document: size, digest, and the sampled shingles that have to be looked up.

    ``own`` are those by which the document is judged, ``other`` those that only a smaller partner may ask for. A document
    of ``n`` is judged by all its shingles if n < SMALL, else by those below a hash threshold; since a partner is at least
    0.8 n large, what it asks for is sampled here as well. ``need`` of ``own`` have to be held by others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, level = Powers(), levels.value
        for batch in batches:
            sizes, first, second, needs = [], [], [], []
            parts: tuple[list, list] = ([], [])
            for text in _texts(batch):
                s = shingle_set(text, WORDS, powers)
                n = len(s)
                d = set_digest(s)
                low = int(np.searchsorted(s, np.uint64(int(SAMPLE * 2**64))))
                mine = n if n < SMALL else low
                sent = n if 4 * n < 5 * SMALL else low
                cold = level[(s[:sent] & np.uint64(COUNTERS - 1)).astype(np.int64)] == 0
                kept = s[:mine][cold[:mine]]
                sizes.append(n)
                first.append(d[0])
                second.append(d[1])
                needs.append(len(kept) - n // 5)
                parts[0].append(_short(kept))
                parts[1].append(_short(s[mine:sent][cold[mine:]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), pa.array(needs, pa.int64()), _lists(parts[0]), _lists(parts[1]),
                ],
                ["doc_id", "n", "d1", "d2", "need", "own", "other"],
            )

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))


def _prefixes(levels):
    """``doc_id, quota, cold, hot`` of each text, for prefixes in the order: cold before hot, rare before frequent.

    ``cold`` are all shingles not known to be common. ``hot`` are those common ones that stand in the prefix whatever the
    frequencies of the others, by level. Of the cold ones that others hold too, ``quota`` plus their number stand in it,
    because those that nobody else holds come first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, level = Powers(), levels.value
        for batch in batches:
            quotas, cold, hot = [], [], []
            for text in _texts(batch):
                s = shingle_set(text, WORDS, powers)
                at = level[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                rare, common = s[at == 0], s[at > 0]
                left = prefix_length(len(s)) - len(rare)
                quotas.append(left)
                cold.append(_short(rare))
                hot.append(_short(common[np.argsort(at[at > 0], kind="stable")[: max(0, left)]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(quotas, pa.int32()), _lists(cold), _lists(hot)],
                ["doc_id", "quota", "cold", "hot"],
            )

    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with the same (cluster, block): every row's id and the first id of its group."""
    powers = Powers()
    key, ids, sets, known = None, [], [], []
    out_a: list[int] = []
    out_b: list[int] = []

    def close() -> None:
        if len(ids) > 1:
            numbered = {}
            groups = link_groups(sets, [numbered.setdefault(g, len(numbered)) for g in known])
            out_a.extend(ids)
            out_b.extend(ids[g] for g in groups)

    for batch in batches:
        texts = _texts(batch)
        columns = [batch.column(c).to_pylist() for c in ("cluster", "block", "doc_id", "known")]
        for cluster, block, doc_id, group, text in zip(*columns, texts):
            if (cluster, block) != key:
                close()
                key, ids, sets, known = (cluster, block), [], [], []
            ids.append(doc_id)
            known.append(group)
            sets.append(shingle_set(text, WORDS, powers))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
        out_a.clear()
        out_b.clear()
    close()
    yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def _links(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links found in ``placed`` (cluster, block, doc_id, known) with the texts of the classes."""
    rows = placed.join(texts, "doc_id").select("cluster", "block", "doc_id", "known", "text")
    dealt = rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "doc_id")
    return dealt.mapInArrow(_search, "a bigint, b bigint")


def _bit_table(ids: DataFrame) -> DataFrame:
    """A bit table of the hashes of the ids: FILTER_BITS / 64 rows at most, whatever their number."""
    word = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    bits = ids.select(
        F.shiftright(word, 6).alias("w"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(word, F.lit(64))).alias("bit"),
    )
    return bits.groupBy("w").agg(F.bit_or("bit").alias("bits"))


def similar_documents(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``documents`` (``doc_id`` bigint, ``text`` string).

    ``component_id`` is the smallest id reachable by links, the row's own included. A null or empty text, or one of blanks
    only, has no shingles and is linked with nothing. Texts of fewer than five words are one shingle. Repeated rows get
    the same result each; rows that share an id count as one document of several texts. A row without an id takes part in
    no link and has a null component. Columns beside ``doc_id`` and ``text`` are not read.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text")
    levels = spark.sparkContext.broadcast(shingle_levels(rows))
    seen = freeze(
        rows.mapInArrow(
            _samples(levels),
            "doc_id bigint, n bigint, d1 bigint, d2 bigint, need bigint, own array<bigint>, other array<bigint>",
        ),
        "samples",
    )
    members = freeze(seen.select("doc_id", "n", "d1", "d2"), "members")
    named = seen.filter("doc_id is not null and n > 0")
    asked = named.select("doc_id", F.explode("own").alias("t"), F.lit(True).alias("own")).unionByName(
        named.select("doc_id", F.explode("other").alias("t"), F.lit(False).alias("own"))
    )
    holders = Window.partitionBy("t")  # common shingles are not among these, so that no group is large
    held = (
        asked.withColumns({"lo": F.min("doc_id").over(holders), "hi": F.max("doc_id").over(holders)})
        .filter("own and lo < hi")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("held"))
    )
    open_rows = named.select("doc_id", "n", "d1", "d2", "need").join(held, "doc_id", "left")
    classes = freeze(
        open_rows.filter(F.coalesce("held", F.lit(0)) >= F.col("need"))
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n")),
        "classes",
    )
    release(seen)
    texts = _class_texts(rows, classes)
    clusters = _clusters(texts, levels)
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    sized = clusters.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    placed = sized.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn(
        "known", F.col("doc_id")
    )
    large = freeze(placed.filter("blocks > 1"), "large")
    links = _links(placed.select("cluster", "block", "doc_id", "known"), texts)
    if not large.isEmpty():
        links = _large_links(links, large, texts, block)
    found = freeze(links.filter("a <> b"), "links")
    release(texts, clusters, large)
    joined = components(found)
    known = classes.join(joined.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "d1", "d2", F.coalesce("component", "class_id").alias("component")
    )
    return members.join(known, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), "doc_id")).alias(
            "component_id"
        ),
    )


def _class_texts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Texts of the rows that stand for classes. The bit table keeps most others from moving; the join is exact."""
    word = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    ids = classes.select(F.col("class_id").alias("doc_id")).distinct()
    possible = (
        rows.withColumns({"w": F.shiftright(word, 6), "i": F.pmod(word, F.lit(64))})
        .join(F.broadcast(_bit_table(ids)), "w")
        .filter(F.getbit("bits", F.col("i")) == 1)
        .select("doc_id", "text")
    )
    # An inner join: the optimiser would move a semi-join in front of the filter, and all texts with it.
    return freeze(possible.join(ids, "doc_id").distinct(), "texts")


def _clusters(texts: DataFrame, levels) -> DataFrame:
    """``doc_id, cluster`` of the classes that share a shingle of their prefixes with another class, frozen."""
    prefixes = freeze(
        texts.mapInArrow(_prefixes(levels), "doc_id bigint, quota int, cold array<bigint>, hot array<bigint>"), "prefixes"
    )
    # Common shingles are not among these, so that no key is large.
    cold = prefixes.select("doc_id", "quota", F.explode("cold").alias("t"))
    shared = cold.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("t"))).filter("df > 1")
    own = Window.partitionBy("doc_id", "quota")  # texts that share an id only take a few more
    ranked = shared.withColumns(
        {"held": F.count(F.lit(1)).over(own), "rank": F.row_number().over(own.orderBy("df", "t"))}
    )
    heads = freeze(
        ranked.filter(F.col("rank") <= F.col("quota") + F.col("held"))
        .select("doc_id", "t")
        .unionByName(prefixes.select("doc_id", F.explode("hot").alias("t"))),
        "heads",
    )
    hubs = heads.groupBy("t").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).filter("hub < last")
    near = heads.join(hubs.select("t", "hub"), "t").filter("doc_id <> hub").select("doc_id", "hub").distinct()
    labels = components(near, "doc_id", "hub")
    release(prefixes, heads)
    clusters = freeze(labels.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "clusters")
    release(labels)
    return clusters


def _large_links(links: DataFrame, large: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """All links, with those between different blocks of large clusters.

    Seeds stand in every block, so most blocks end up in one group. What is not in the largest group of its cluster is
    added to every block and searched again with the groups known so far.
    """
    least = large.groupBy("cluster").agg(F.array_sort(F.collect_set(F.when(F.col("block") == 0, F.col("doc_id")))).alias("s"))
    seeds = least.select("cluster", F.explode(F.slice("s", 1, SEEDS)).alias("doc_id"))
    blocks = large.select("cluster", "block").distinct()
    everywhere = seeds.join(blocks, "cluster").withColumn("known", F.col("doc_id"))
    own = large.select("cluster", "block", "doc_id", "known")
    first = freeze(links.unionByName(_links(own.unionByName(everywhere.select(*own.columns)).distinct(), texts)), "links")
    so_far = components(first.filter("a <> b"))
    grouped = freeze(
        large.join(so_far.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
            "cluster", "block", "doc_id", F.coalesce("component", "doc_id").alias("known")
        ),
        "grouped",
    )
    counts = grouped.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("m"))
    main = counts.groupBy("cluster").agg(F.max_by("known", F.struct("m", "known")).alias("main"))
    left = freeze(grouped.join(main, "cluster").filter("known <> main").drop("main"), "left")
    if left.isEmpty():
        return first
    # Chunks of what is left, each against every block of its cluster: two blocks of rows in a task at most.
    counted = left.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    chunked = left.join(counted, "cluster").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("m") / block)).cast("int")
    )
    chunks = chunked.select("cluster", "chunk").distinct()
    pair = F.struct("chunk", "block")
    hosts = grouped.join(chunks, "cluster").select("cluster", pair.alias("block"), "doc_id", "known")
    visitors = (
        chunked.select("cluster", "chunk", "doc_id", "known")
        .join(blocks, "cluster")
        .select("cluster", pair.alias("block"), "doc_id", "known")
    )
    met = hosts.unionByName(visitors).distinct().withColumn("block", F.xxhash64("block.chunk", "block.block"))
    return first.unionByName(_links(met, texts))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows without an id are linked with nothing and all stay. Of rows that share an id the one with the least text stays.
    """
    heads = (
        similar_documents(documents)
        .filter("doc_id = component_id")
        .select(F.col("doc_id").alias("_head"))
        .distinct()
    )
    of_id = Window.partitionBy("doc_id").orderBy("text")
    kept = (
        documents.join(heads, F.col("doc_id") == F.col("_head"), "left_semi")
        .withColumn("_nth", F.row_number().over(of_id))
        .filter("_nth = 1")
        .drop("_nth")
    )
    return kept.unionByName(documents.filter("doc_id is null"))
