"""Trie of conversation prefixes, with totals of every node and its subtree.

Every conversation is a row of turn ids. Equal rows are merged and the others dealt by range, so that each task holds
neighbours of the trie. A task pads its rows to a matrix of turn ids, sorts it (``lexsort``), and marks where a column or
one before it changes: these marks are the starts of the nodes of that depth, and ``reduceat`` adds up each node.

Nodes on the path of a task's first or last row may go on in the next task. Their parts are added up afterwards: two paths
a task, whatever the number of conversations. All other nodes are finished where they are found.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import freeze

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

#: Conversations of one block of ids begin alike: with up to SHARED - 1 turns of the first id of the block.
BLOCK, SHARED = 100, 6
#: Turns that decide the range a conversation is dealt to; also what a sampled row can bring to the driver at most.
RANGE_TURNS = 64
#: Ids of members are joined in runs of so many consecutive numbers before they are dealt by their conversation.
RUN_BITS = 10
#: Columns of turn ids in one padded matrix. Only rows that are still equal to a neighbour get the next columns.
WIDTH = 64
#: Nodes in one batch of results.
BATCH = 65_536

#: ``conv_id`` is the smallest member, ``ends`` the digest of the members that end here (null: none), ``chars`` the length
#: of the last text. ``key`` is null for finished nodes; ``parent_key`` names a parent that is not.
NODES = (
    "depth bigint, conv_id bigint, parent_conv_id bigint, parent_key binary, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string, chars bigint, key binary"
)
#: Finished nodes of the paths; ``hangs`` tells whether nodes finished elsewhere hang on them.
PATHS = (
    "depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends string, key binary, hangs boolean"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, id, chars`` of every turn: two numbers of 60 bits that stand for role and text, and its length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    half = [F.conv(F.substring("_d", at, 15), 16, 10).cast("bigint") for at in (1, 16)]
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("_d"), F.length(text).alias("chars")
    )
    return rows.select("conv_id", "turn", half[0].alias("a"), half[1].alias("b"), "chars")


def sequences(turns: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """``conv_id, turns``: the rebuilt conversations, each an array of ``struct<a, b, chars>``.

    Turns are ordered by their number, missing ones first, equal ones by their ids. With h = crc32(conv_id) % ``shared``,
    the first h turns are those of the conversation at the start of the block of ids, or all it has; the rest are the
    conversation's own after its first h.
    """
    base = F.col("conv_id") - F.col("conv_id") % block
    # Dealt by block once: neither the grouping nor the join below moves a turn again.
    dealt = turns.withColumn("_base", base).repartition("_base")
    told = dealt.groupBy("_base", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "a", "b", "chars"))).alias("_t")
    )
    bare = F.transform("_t", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["chars"].alias("chars")))
    own = told.select("_base", "conv_id", bare.alias("_t"))
    heads = own.filter(F.col("conv_id") == F.col("_base")).select(
        "_base", F.slice("_t", 1, max(1, shared - 1)).alias("_head")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("int")
    rest = F.slice(F.col("_t"), h + 1, F.greatest(F.size("_t"), F.lit(1)))
    begun = F.when(F.col("_head").isNull(), rest).otherwise(F.concat(F.slice(F.col("_head"), F.lit(1), h), rest))
    return own.join(heads, "_base", "left").select("conv_id", begun.alias("turns"))


# --- one range of rows ------------------------------------------------------------------------------------------------
def sorted_rows(ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct rows of ids, a shorter row before its extensions, and the columns each shares with the one before.

    ``ids`` holds the pairs of all rows one after the other; row i has ``length[i]`` of them from ``start[i]`` on. The first
    row shares -1 columns: it starts every node on its path, the root as well.
    """
    n = len(length)
    rank, common = np.zeros(n, "int64"), np.full(n + 1, -1, "int64")
    tied, at = np.arange(n if n > 1 else 0), 0
    while len(tied):
        width = int(min(WIDTH, length[tied].max() - at))
        column = at + np.arange(width)
        there = column < length[tied][:, None]
        place = np.where(there, start[tied][:, None] + column, 0)
        matrix = np.where(there[:, :, None], ids[place], -1)  # padding sorts before every id
        keys = [matrix[:, c, half] for c in range(width - 1, -1, -1) for half in (1, 0)]
        order = np.lexsort([*keys, rank[tied]])
        tied, matrix = tied[order], matrix[order]
        groups = rank[tied]
        changed = np.logical_or.accumulate((matrix[1:] != matrix[:-1]).any(axis=2), axis=1)
        new_group = np.concatenate(([True], groups[1:] != groups[:-1]))
        differs = np.concatenate(([False], changed[:, -1]))
        shared = np.concatenate(([0], width - changed.sum(axis=1)))
        first = np.maximum.accumulate(np.where(new_group, np.arange(len(tied)), 0))
        position = groups + np.arange(len(tied)) - first
        split = differs & ~new_group
        common[position[split]] = at + shared[split]
        run = np.maximum.accumulate(np.where(new_group | differs, np.arange(len(tied)), 0))
        rank[tied] = position[run]
        size = np.bincount(run, minlength=len(tied))[run]
        tied, at = tied[size > 1], at + width
    return np.argsort(rank, kind="stable"), common[:-1]


def path_keys(pairs: np.ndarray) -> list[bytes]:
    """A key for every prefix of a row of ids, from the empty one to the whole row."""
    digest, keys = hashlib.md5(), []
    for pair in [b"", *(p.tobytes() for p in pairs)]:
        digest.update(pair)
        keys.append(digest.copy().digest())
    return keys


def range_nodes(ids, chars, start, length, weight, first, ends) -> Iterator[pd.DataFrame]:
    """The nodes of distinct rows, deepest first, as tables with the columns of ``NODES``.

    Nodes on the path of the first or last row have a key; their children, leaves and saved tokens are those of finished
    nodes in their subtree only, and they are not leaves here. All other nodes are finished.
    """
    order, common = sorted_rows(ids, start, length)
    start, length, weight, first, ends = start[order], length[order], weight[order], first[order], ends[order]
    n, by_length = len(order), np.argsort(-length, kind="stable")
    leaf = (np.append(common[1:], -1) < length).astype("int64")
    leaf[[0, -1]] = 0  # the paths decide
    paths = [path_keys(ids[start[i] : start[i] + length[i]]) for i in (0, n - 1)]
    shared_by_all = common[1:].min(initial=length[0])
    total = np.zeros(n, "int64")  # saved by finished nodes of this depth and below, at the row where they start
    below = None
    for depth in range(length.max(), -1, -1):
        active = np.sort(by_length[: np.searchsorted(-length[by_length], -depth, "right")])
        heads = np.flatnonzero(common[active] < depth)
        at = active[heads]
        on_first, on_last = np.zeros(len(at), bool), np.zeros(len(at), bool)
        on_first[0], on_last[-1] = length[0] >= depth, length[-1] >= depth
        open_ = on_first | on_last
        members = np.add.reduceat(weight[active], heads)
        size = chars[start[at] + depth - 1] if depth else np.zeros(1, "int64")
        total[at] += np.where(open_, 0, (members - 1) * size)
        children = np.add.reduceat(((length[active] > depth) & (common[active] <= depth)).astype("int64"), heads)
        children -= on_first & (length[0] > depth)
        children -= on_last & (length[-1] > depth) & (shared_by_all <= depth)
        nodes = pd.DataFrame(
            {
                "depth": np.full(len(at), depth, "int64"),
                "conv_id": np.minimum.reduceat(first[active], heads),
                "n_convs": members,
                "n_children": children,
                "n_leaves": np.add.reduceat(leaf[active], heads),
                "saved_tokens": np.add.reduceat(total[active], heads),
                "ends": np.where(length[at] == depth, ends[at], None),
                "chars": size,
                "key": np.where(on_first, paths[0][depth] if length[0] >= depth else None,
                                np.where(on_last, paths[1][depth] if length[-1] >= depth else None, None)),
            }
        )
        if below is not None:
            yield _under(below, nodes, np.searchsorted(at, below_at, "right") - 1)
        below, below_at = nodes, at
    yield below.assign(parent_conv_id=None, parent_key=None)


def _under(nodes: pd.DataFrame, parents: pd.DataFrame, which: np.ndarray) -> pd.DataFrame:
    """``nodes`` with the smallest member of their parent, or its key if it is not finished."""
    key = parents["key"].to_numpy()[which]
    missing = pd.isna(key)
    conv = pd.array(parents["conv_id"].to_numpy()[which], "Int64")
    conv[~missing] = pd.NA
    return nodes.assign(parent_conv_id=conv, parent_key=key)


def _nodes_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task: rows ``run, ids, chars, members, n, first`` ordered by run; equal ids are one row from here on."""
    seen: dict[bytes, int] = {}
    sizes, digests, weight, first = [], [], [], []
    for batch in batches:
        ids, chars = batch.column("ids"), batch.column("chars")
        id_at, id_values = ids.offsets.to_numpy(), ids.values.to_numpy()
        char_at, char_values = chars.offsets.to_numpy(), chars.values.to_numpy()
        rows = zip(*(batch.column(c).to_pylist() for c in ("members", "n", "first")))
        for i, (members, n, smallest) in enumerate(rows):
            raw = id_values[id_at[i] : id_at[i + 1]].tobytes()
            k = seen.setdefault(raw, len(seen))
            if k == len(weight):
                sizes.append(char_values[char_at[i] : char_at[i + 1]].astype("int64"))
                digests.append(hashlib.sha256())
                weight.append(0)
                first.append(smallest)
            else:
                digests[k].update(b",")
            digests[k].update(members.encode())
            weight[k] += n
            first[k] = min(first[k], smallest)
    if not seen:
        return
    length = np.array([len(raw) // 16 for raw in seen], "int64")
    ids = np.frombuffer(b"".join(seen), "int64").reshape(-1, 2)
    seen.clear()
    ends = np.array([d.hexdigest() for d in digests], object)
    columns = [c.split() for c in NODES.split(", ")]
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in columns])
    waiting, n = [], 0
    found = range_nodes(
        ids, np.concatenate(sizes), length.cumsum() - length, length, np.array(weight, "int64"), np.array(first, "int64"), ends
    )
    for nodes in found:
        table = pa.Table.from_pandas(nodes[schema.names], schema, preserve_index=False)
        waiting.append(table)
        n += len(table)
        if n >= BATCH:
            yield from pa.concat_tables(waiting).combine_chunks().to_batches(BATCH)
            waiting, n = [], 0
    if n:
        yield from pa.concat_tables(waiting).combine_chunks().to_batches(BATCH)


def _finish_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals of the nodes on the paths, deepest first: each hands children, leaves and savings on to its parent."""
    nodes = pd.concat([pd.DataFrame(columns=[c.split()[0] for c in NODES.split(", ")]), *batches])
    if not len(nodes):
        return
    nodes = nodes.sort_values("depth", ascending=False, kind="stable")
    smallest = dict(zip(nodes["key"], nodes["conv_id"]))
    handed: dict[bytes, list[int]] = {}
    rows = []
    for node in nodes.itertuples(index=False):
        children, leaves, saved = handed.pop(node.key, (0, 0, 0))
        n_children = node.n_children + children
        leaves += n_children == 0
        saved += (node.n_convs - 1) * node.chars
        up = handed.setdefault(node.parent_key, [0, 0, 0]) if node.depth else [0, 0, 0]
        up[0], up[1], up[2] = up[0] + 1, up[1] + leaves, up[2] + saved
        rows.append(
            (node.depth, node.conv_id, smallest[node.parent_key] if node.depth else None, node.n_convs, n_children,
             node.n_leaves + leaves, node.saved_tokens + saved, node.ends, node.key, node.n_children > 0)
        )
    table = pd.DataFrame(rows, columns=[c.split()[0] for c in PATHS.split(", ")])
    yield table.assign(parent_conv_id=table["parent_conv_id"].astype("Int64"))


def prefix_trie(told: DataFrame, ranges: int | None = None) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    ``told``: conv_id long (distinct) and ``turns array<struct<a, b, chars>>``, as ``sequences`` gives them. A node is a
    distinct sequence of first turns; it is named by its smallest member. An empty sequence is a member of the root alone,
    and no sequences give no nodes. ``ranges`` is the number of tasks, otherwise Spark settles it by size.
    """
    run = F.shiftright("conv_id", RUN_BITS)
    rows = told.select(
        "conv_id",
        run.alias("run"),
        F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )
    # Copies of one conversation become a row for each run of ids before they meet; a run has 2 ** RUN_BITS ids at most.
    merged = rows.groupBy("ids", "chars", "run").agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("members"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("first"),
    )
    near = F.slice("ids", 1, 2 * RANGE_TURNS)
    dealt = merged.repartitionByRange(*([ranges] if ranges else []), near).sortWithinPartitions("run")
    nodes = freeze(dealt.mapInArrow(_nodes_of_range, NODES), "trie_nodes")
    parts = nodes.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"),
        F.first("chars").alias("chars"),
    )
    # Two paths a task: this grows with the number of tasks and the length of a conversation, not with the table.
    paths = freeze(parts.repartition(1).mapInPandas(_finish_paths, PATHS), "trie_paths")
    parents = F.broadcast(
        paths.filter("hangs").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    inner = (
        nodes.filter(F.col("key").isNull())
        .join(parents, "parent_key", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    )
    every = inner.select(*columns).unionByName(paths.select(*columns))
    return every.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations.

    Null roles and texts count as empty, rows without a conv_id belong to no conversation, repeated turns all count. Columns
    other than conv_id, turn, role and text are not read. An empty table gives no nodes.
    """
    return prefix_trie(sequences(turn_ids(conversations)))
