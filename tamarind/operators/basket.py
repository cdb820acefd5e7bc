"""Market-basket metrics on a long (transaction, item) frame."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.numbers import ratio_or_null
from tamarind.session import freeze

#: Baskets up to this many items list their pairs in place; larger ones are cut into blocks over many tasks.
BLOCK = 512
#: Hashed pair counters of the first pass. This bounds what is broadcast, whatever the number of pairs.
COUNTERS = 1 << 18


def distinct_items(lines: DataFrame, transaction: str = "transaction_id", item: str = "item") -> DataFrame:
    """One row per (basket, item), frozen because totals, item counts and pairs all read it."""
    return freeze(lines.select(F.col(transaction).alias("t"), F.col(item).alias("i")).na.drop().distinct(), "baskets")


def _basket_sizes(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("t").agg(F.count(F.lit(1)).alias("n"))


def _pairs_in_place(baskets: DataFrame) -> DataFrame:
    """Pairs of baskets of bounded size, out of one sorted array per basket."""
    arrays = baskets.groupBy("t").agg(F.sort_array(F.collect_list("i")).alias("items"))
    heads = arrays.filter(F.size("items") > 1).select("items", F.posexplode("items").alias("pos", "item_a"))
    return heads.select(
        "item_a", F.explode(F.slice("items", F.col("pos") + 2, F.size("items"))).alias("item_b")
    )


def _pairs_in_blocks(baskets: DataFrame, block: int) -> DataFrame:
    """Pairs of large baskets. Items fall into hash blocks of about ``block`` items, and each pair of blocks meets once.

    The join key is (basket, block of a, block of b), so one huge basket is spread over (size / block)^2 keys.
    """
    blocked = baskets.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("i"), F.col("blocks")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = blocked.select("t", F.col("i").alias("item_a"), F.col("block").alias("ba"), others.alias("bb"))
    right = blocked.select("t", F.col("i").alias("item_b"), others.alias("ba"), F.col("block").alias("bb"))
    return left.join(right, ["t", "ba", "bb"]).filter(F.col("item_a") < F.col("item_b")).select("item_a", "item_b")


def _in_full_counters(pairs: DataFrame, total: Column, min_support: float, counters: int) -> DataFrame:
    """Pairs whose hashed counter reaches the support; a pair is never more frequent than its counter, so none is lost.

    The pairs are listed once more for that, where they lie; what is shuffled is one number for each counter and task.
    """
    counter = F.pmod(F.xxhash64("item_a", "item_b"), F.lit(counters)).alias("_counter")
    full = (
        pairs.groupBy(counter)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_baskets", total)
        .filter(ratio_or_null(F.col("_n"), F.col("_baskets")) >= min_support)
        .select("_counter")
    )
    # ``counters`` rows of one number at most.
    return pairs.select("*", counter).join(F.broadcast(full), "_counter", "left_semi").drop("_counter")


def pair_metrics(
    lines: DataFrame,
    transaction: str = "transaction_id",
    item: str = "item",
    min_support: float = 0.0,
    block: int = BLOCK,
    counters: int = COUNTERS,
) -> DataFrame:
    """Pair count, support, confidence in both directions and lift of every item pair that shares a basket.

    ``min_support`` is a share of all baskets. Items below it are left out before pairs are formed, and pairs whose hashed
    counter stays below it before they are counted one by one. Both are exact: neither an item nor a counter is less
    frequent than its pairs. Without a support every pair is counted.
    """
    baskets = distinct_items(lines, transaction, item)
    total = _basket_sizes(baskets).agg(F.count(F.lit(1))).scalar()
    items = baskets.groupBy("i").agg(F.count(F.lit(1)).alias("n_item"))
    if min_support > 0:
        items = items.withColumn("total", total).filter(F.col("n_item") >= F.col("total") * min_support)
        baskets = baskets.join(items.select("i"), "i", "left_semi")
    # Usually no basket is that large; the branch for large ones then costs nothing.
    large = _basket_sizes(baskets).filter(F.col("n") > block)
    pairs = _pairs_in_place(baskets.join(large, "t", "left_anti")).unionByName(
        _pairs_in_blocks(baskets.join(large, "t"), block)
    )
    if min_support > 0:
        pairs = _in_full_counters(pairs, total, min_support, counters)
    counted = pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("pair_count"))
    a = items.select(F.col("i").alias("item_a"), F.col("n_item").alias("count_a"))
    b = items.select(F.col("i").alias("item_b"), F.col("n_item").alias("count_b"))
    n = F.col("pair_count")
    metrics = (
        counted.join(a, "item_a")
        .join(b, "item_b")
        .withColumn("baskets", total)
        .select(
            "item_a",
            "item_b",
            "pair_count",
            ratio_or_null(n, F.col("baskets")).alias("support"),
            ratio_or_null(n, F.col("count_a")).alias("confidence_ab"),
            ratio_or_null(n, F.col("count_b")).alias("confidence_ba"),
            ratio_or_null(n * F.col("baskets"), F.col("count_a") * F.col("count_b")).alias("lift"),
        )
    )
    return metrics.filter(F.col("support") >= min_support) if min_support > 0 else metrics


def _frequent_sets(arrays: DataFrame, min_count: Column) -> DataFrame:
    """All itemsets in at least ``min_count`` baskets, level by level, as (sorted items ``s``, ``freq``).

    A set grows only by items after its last one in the basket's sorted array, and only frequent sets grow, since every
    prefix of a frequent set is frequent. Each level is a narrow explode of the basket arrays, counted with partial
    aggregation; what is broadcast to the next level is the frequent sets of this one, which do not grow with the baskets.
    """
    rows = arrays.select("items", F.posexplode("items").alias("p", "i")).select("items", "p", F.array("i").alias("s"))
    levels = []
    while True:
        counted = rows.groupBy("s").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= min_count)
        frequent = freeze(counted, "itemsets")
        if frequent.isEmpty():
            break
        levels.append(frequent)
        grown = rows.join(F.broadcast(frequent.select("s")), "s", "left_semi").select(
            "items", "p", "s", F.posexplode(F.slice("items", F.col("p") + 2, F.size("items"))).alias("q", "i")
        )
        rows = grown.select("items", (F.col("p") + 1 + F.col("q")).alias("p"), F.concat("s", F.array("i")).alias("s"))
    return functools.reduce(DataFrame.unionByName, levels, frequent)


def growth_rules(
    lines: DataFrame,
    transaction: str = "transaction_id",
    item: str = "item",
    min_support: float = 0.01,
    min_confidence: float = 0.05,
) -> DataFrame:
    """Rules with any number of antecedents and one consequent, as FP-growth gives them, from all frequent itemsets.

    Items below the support are left out first; the baskets' arrays of the rest are frozen once. Frequent itemsets are
    then counted level by level (``_frequent_sets``), every basket in its own task, so no tree or group holds many
    baskets. Baskets that lose all their items still count in the total.
    """
    baskets = distinct_items(lines, transaction, item)
    total = _basket_sizes(baskets).agg(F.count(F.lit(1))).scalar()
    min_count = total * min_support
    frequent = baskets.groupBy("i").agg(F.count(F.lit(1)).alias("n_item")).filter(F.col("n_item") >= min_count)
    arrays = freeze(
        baskets.join(frequent.select("i"), "i", "left_semi").groupBy("t").agg(F.sort_array(F.collect_list("i")).alias("items")),
        "basket_arrays",
    )
    sets = _frequent_sets(arrays, min_count)
    whole = sets.filter(F.size("s") > 1).select("s", "freq", F.explode("s").alias("consequent"))
    parts = whole.select(
        F.filter("s", lambda x: x != F.col("consequent")).alias("antecedent"), "consequent", F.col("freq").alias("n_union")
    )
    antecedents = sets.select(F.col("s").alias("antecedent"), F.col("freq").alias("n_antecedent"))
    consequents = sets.filter(F.size("s") == 1).select(F.col("s")[0].alias("consequent"), F.col("freq").alias("n_consequent"))
    confidence = F.col("n_union").cast("double") / F.col("n_antecedent")
    rules = (
        parts.join(antecedents, "antecedent")
        .join(consequents, "consequent")
        .withColumn("confidence", confidence)
        .filter(F.col("confidence") >= min_confidence)
        .withColumn("baskets", total.cast("double"))
    )
    return rules.select(
        F.array_join(F.sort_array("antecedent"), " + ").alias("antecedent"),
        F.col("consequent"),
        "confidence",
        (F.col("confidence") / (F.col("n_consequent").cast("double") / F.col("baskets"))).alias("lift"),
        (F.col("n_union").cast("double") / F.col("baskets")).alias("support"),
    )
