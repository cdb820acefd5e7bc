"""Byte-level BPE with a file of ranked tokens: encoding and decoding.

A text is cut by the tokenizer's pattern; each piece is merged by itself, so equal pieces have equal ids. Pieces are counted
over the corpus. Those that make up at least 1 / FREQUENT of all pieces, of which there can be no more than FREQUENT, are
merged once by Spark: a higher-order function folds the merges over an array of byte strings, with the ranks as a literal
map. Their ids travel to the encoding tasks. All other pieces are merged there by the same rule, each once per task as long
as a bounded memo holds it. Decoding looks up the byte string of each id and concatenates.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from tamarind.llm.texts import let
from tamarind.llm.scratch import freeze, release

#: Most pieces that are merged by Spark and sent to every task.
FREQUENT = 32768
#: Pieces a worker remembers beside those.
MEMO = 800_000
#: Distinct pieces a counting task keeps before it hands them on.
FLUSH = 500_000
#: Rows a task works on at a time.
ROWS = 256
#: Buckets of the literal map, which is searched entry by entry inside a bucket.
BUCKETS = 16384
#: Pieces of more bytes are merged by a heap, which takes n log n steps instead of n * n.
LONG = 64


def default_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file of the driver: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: while any two neighbours form a token, the pair of lowest rank is merged, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG:
        return _merge_long(piece, ranks)
    rank, none = ranks.get, 1 << 62
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at < len(pairs):
            pairs[at] = rank(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n

    def offer(start: int) -> None:
        if end[start] < n:
            rank = ranks.get(piece[start : end[end[start]]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[start], end[end[start]]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n):
        offer(i)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if not (alive[start] and end[start] == middle and alive[middle] and end[middle] == stop):
            continue
        alive[middle] = False
        end[start] = stop
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of BUCKETS maps from upper-case hex to rank, by CRC-32 of the token."""
    maps: list[dict] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % BUCKETS][token.hex().upper()] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def folded(piece: Column, table: Column) -> Column:
    """Ids of one piece (binary), folded by higher-order functions over the array of its bytes. An empty piece has none."""

    def rank(token: Column) -> Column:
        return F.element_at(table, F.pmod(F.crc32(token), F.lit(BUCKETS)).cast("int") + 1)[F.hex(token)]

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.concat(parts[i - 1], parts[i])
        )

        def choose(ranked: Column) -> Column:
            at = F.array_position(ranked, F.array_min(ranked)).cast("int")
            merged = F.concat(
                F.slice(parts, F.lit(1), at - 1),
                F.array(F.concat(parts[at - 1], parts[at])),
                F.slice(parts, at + 2, F.size(parts)),
            )
            return F.when(F.array_min(ranked).isNull(), parts).otherwise(merged)

        return F.when(F.size(parts) < 2, parts).otherwise(let(F.transform(pairs, rank), choose))

    def all_merges(parts: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), parts, step)

    length = F.octet_length(piece)
    singles = F.transform(F.sequence(F.lit(1), length), lambda i: F.substring(piece, i, F.lit(1)))
    return F.when(length > 0, F.transform(let(singles, all_merges), rank)).otherwise(F.array().cast("array<int>"))


def _count(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = regex.compile(pattern).findall, Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["piece", "n"]
            )
            counts.clear()
            return batch

        for batch in _pieces_of(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(cut(text))
            if len(counts) > FLUSH:
                yield flush()
        yield flush()

    return run


def frequent_pieces(
    documents: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", most: int = FREQUENT
) -> dict[str, list[int]]:
    """Ids of all pieces that make up at least 1 / most of the pieces of the corpus: ``most`` at most."""
    texts = documents.select(F.col(text_col).alias("text"))
    counts = freeze(
        texts.mapInArrow(_count(pattern), "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n")), "pieces"
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.filter(F.col("n") >= max(1, -(-total // most)))
    table = rank_literal(ranks)
    # One literal for all pieces, found by name inside the fold.
    ids = top.select("piece", let(table, lambda t: folded(F.col("piece").cast("binary"), t)).alias("ids")).toArrow()
    release(counts)
    return dict(zip(ids.column("piece").to_pylist(), ids.column("ids").to_pylist()))


class _Memo(dict):
    """Pieces to the bytes of their ids, little-endian and four a piece; merged when first asked for.

    Two halves: when the younger one is full it becomes the older one, and what is asked for again comes back from there.
    """

    def __init__(self, ranks: dict[bytes, int], known: dict[str, list[int]]):
        super().__init__()
        self.ranks, self.older = ranks, {}
        self.known = {p: np.array(ids, "<u4").tobytes() for p, ids in known.items()}

    def __missing__(self, piece: str) -> bytes:
        ids = self.known.get(piece) or self.older.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(self) >= MEMO // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


#: Memos of this process by the key of their query, so that the tasks a worker runs one after the other share one.
_MEMOS: dict[str, _Memo] = {}


def _memo(key: str, ranks: dict[bytes, int], known: dict[str, list[int]]) -> _Memo:
    if key not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[key] = _Memo(ranks, known)
    return _MEMOS[key]


class _Tokens:
    """Token bytes by id, laid end to end, so that whole batches are decoded by array operations."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.length = np.full(size, -1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.start = np.cumsum(np.maximum(self.length, 0)) - np.maximum(self.length, 0)
        by_rank = sorted(ranks, key=ranks.__getitem__)
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The concatenated bytes of all ids, and the length of each."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or (self.length[ids] < 0).any()):
            raise ValueError("an id has no token")
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.start[ids] - (ends - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))], lengths


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough that a task holds little at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _encoded(batches, key: str, ranks: dict, known: dict, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches with ``_ids`` in place of ``_text``."""
    memo, cut = _memo(key, ranks, known), regex.compile(pattern).findall
    for batch in _pieces_of(batches):
        ids = [b"".join(map(memo.__getitem__, cut(t))) if t else b"" for t in batch.column("_text").to_pylist()]
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        ends = np.cumsum([0] + [len(i) // 4 for i in ids]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        rest = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], tokens], [*rest, "_ids"])


def _decoded(batches, ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Batches with ``_bytes`` beside ``_ids``."""
    tokens = _Tokens(ranks)
    for batch in _pieces_of(batches):
        ids = batch.column("_ids")
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        flat, lengths = tokens.decode(ids.flatten().to_numpy())
        at = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))]
        raw = flat.tobytes()
        decoded = [raw[a:b] if known else None for a, b, known in zip(at, at[1:], ids.is_valid().to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "_bytes"])


def encode(
    documents: DataFrame,
    text_col: str = "text",
    ids_col: str = "token_ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """All rows with ``ids_col`` (array of int) in place of the text: the tokens of the whole text, no special ones.

    Null and empty texts have no ids. Repeated rows are encoded alike. Other columns are kept; one named like ``ids_col``
    is replaced.
    """
    ranks = read_ranks(path or default_file())
    known = frequent_pieces(documents, ranks, pattern, text_col)
    shared = documents.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, ranks, known))
    rest = [c for c in documents.columns if c not in (text_col, ids_col)]
    source = documents.select(*rest, F.col(text_col).alias("_text"))
    schema = documents.select(*rest).schema.add("_ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, *shared.value, pattern)

    return source.mapInArrow(run, schema).withColumnRenamed("_ids", ids_col)


def decode(encoded: DataFrame, ids_col: str = "token_ids", bytes_col: str = "bytes", path: str | None = None) -> DataFrame:
    """All rows with ``bytes_col`` (binary) in place of the ids. Null ids give null; an id without a token is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path or default_file()))
    rest = [c for c in encoded.columns if c not in (ids_col, bytes_col)]
    source = encoded.select(*rest, F.col(ids_col).alias("_ids"))
    schema = encoded.select(*rest).schema.add("_bytes", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _decoded(batches, shared.value):
            yield batch.select([*rest, "_bytes"])

    return source.mapInArrow(run, schema).withColumnRenamed("_bytes", bytes_col)


def document_tokens(
    documents: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, from its ids and from decoding them again.

    The same steps as ``encode`` and ``decode``, one after the other in one task, so that ids and decoded texts are not
    carried back and forth.
    """
    ranks = read_ranks(path or default_file())
    shared = documents.sparkSession.sparkContext.broadcast(
        (uuid.uuid4().hex, ranks, frequent_pieces(documents, ranks, pattern))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _decoded(_encoded(batches, *shared.value, pattern), shared.value[1]):
            ids = batch.column("_ids")
            flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            hashes = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])]
            decoded = [hashlib.sha256(d).hexdigest() for d in batch.column("_bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(hashes), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = documents.select("doc_id", F.col("text").alias("_text"))
    return source.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
