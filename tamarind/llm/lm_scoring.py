"""Language-model scores of whole texts: context-tree weighting over bytes, beside a word-unigram base.

Counting and scoring are one pass each over the texts. Words are counted in each task before they are shuffled. Words that
make up at least 1 / FREQUENT of all tokens, of which there can be no more than FREQUENT, travel to the scoring tasks. It is
the same with the scores of grams, a context and its byte each: those that make up at least 1 / CONTEXTS of all places travel.
The other words and grams of a few documents, a slice, are dealt as one array for each part of all words and grams; where
the counts and scores of a part lie, they are looked up and added up by document, so that nothing but sums comes back.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.context_tree import DEPTH, TOP, Top, grams, reduced
from tamarind.llm.shingles import LOWER_BYTES
from tamarind.session import freeze

#: Most words whose counts are sent to every task.
FREQUENT = 65536
#: Most contexts, with their byte, whose scores are sent to every task: 32 MB. No bound on the model.
CONTEXTS = 1 << 21
#: Additive smoothing of the base.
ALPHA = 0.1
#: A document is held out of training if crc32 of its id as text leaves this remainder by FOLDS.
FOLDS, HELD_OUT = 10, 0
#: The end of a text is counted as a token; no word holds a line feed.
END = b"\n"
#: Distinct words or grams a counting task keeps before it hands them on.
FLUSH = 1_000_000
#: Places whose grams are brought together at a time, and documents that are read at a time.
PLACES, READ = 2_000_000, 256
#: Distinct grams in a part of them, on average; a task that looks up holds the scores of one part.
PART_GRAMS = 100_000
#: Sums a task keeps before it hands them on.
SUMS = 2_000_000
#: Most bytes that Spark hands to a task at a time; its rows are arrays here, and a number of rows bounds nothing.
BATCH_BYTES = 16 << 20


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept out of training; a missing id counts as the empty text and is."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _lowered(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or b"").translate(LOWER_BYTES) for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _read(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of a few documents at a time, however many a batch has."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            yield part.column("doc_id").to_pylist(), _lowered(part)


def _count(depth: int):
    def rows(words: Counter, merged: list) -> pa.RecordBatch:
        keys, ns, places = _merge(merged)
        names = list(words)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None] * len(names) + keys.tolist(), pa.int64()),
                pa.array(names + [None] * len(keys), pa.binary()),
                pa.array(list(words.values()) + ns.tolist(), pa.int64()),
                pa.array([None] * len(names) + places.tolist(), pa.int64()),
            ],
            ["gram", "word", "n", "places"],
        )

    def distinct(waiting: list, trained: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, places = np.unique(np.concatenate(waiting), return_counts=True)
        return keys, places if trained else np.zeros_like(places), places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, merged = Counter(), []
        for ids, texts in _read(batches, READ):
            waiting, size = {True: [], False: []}, {True: 0, False: 0}
            for d, t in zip(ids, texts):
                trained = not held_out(d)
                if trained:
                    words.update(t.split())
                    words[END] += 1
                waiting[trained].append(grams(t, depth))
                size[trained] += len(t)
                if size[trained] > PLACES:
                    merged.append(distinct(waiting[trained], trained))
                    waiting[trained], size[trained] = [], 0
            merged += [distinct(w, trained) for trained, w in waiting.items() if w]
            merged = [_merge(merged)] if merged else []
            if len(words) > FLUSH or (merged and len(merged[0][0]) > FLUSH):
                yield rows(words, merged)
                words, merged = Counter(), []
        yield rows(words, merged)

    return run


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *[
        np.bincount(at, weights=np.concatenate([p[k] for p in parts])).astype(np.int64) for k in (1, 2)
    ]


def count(documents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Counts, frozen: ``word, n`` (the end as a line feed) and ``gram, n, places`` in one table.

    ``n`` counts in the training documents, ``places`` in all. Grams of other documents only are there with an n of 0.
    """
    rows = documents.select("doc_id", "text").mapInArrow(_count(depth), "gram bigint, word binary, n bigint, places bigint")
    return freeze(
        rows.groupBy("gram", "word").agg(F.sum("n").alias("n"), F.sum("places").alias("places")), "counts"
    )


def _columns(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column("gram").to_numpy(), b.column("n").to_numpy()) for b in batches]
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram, logp`` of all grams of frozen counts, by the context tree with a node for every context seen.

    Grams are dealt by the last ``TOP + 1`` bytes of their context, so the longer contexts of each lie in one task. The
    driver sees the sums of the contexts of up to ``TOP`` bytes only.
    """
    spark = counts.sparkSession
    last = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * min(depth, TOP + 1)) - 1))
    dealt = counts.filter("gram is not null").select("gram", "n").repartition(last)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = reduced(*_columns(batches), depth)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "zeros", "ones", "longer"])

    sums = (
        dealt.mapInArrow(reduce, "key bigint, zeros double, ones double, longer double")
        .groupBy("key")
        .agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "longer")])
        .toArrow()
    )
    shared = spark.sparkContext.broadcast(Top.of(depth, *[sums.column(c).to_numpy() for c in sums.column_names]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, logp = shared.value.scores(*_columns(batches))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(logp)], ["gram", "logp"])

    return freeze(dealt.mapInArrow(score, "gram bigint, logp double"), "grams")


_HEAD = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint"
)
#: ``kind`` says what a row is: the scores of a part (grams in ``x``, scores in ``y``), its counts (words, counts), a slice's
#: grams in a part and a slice's words in a part (with places and numbers in ``y``), sums by document of a slice (``x``), or
#: a document that is handed through.
_DEALT = "part bigint, kind int, slice bigint, x binary, y binary, place bigint, " + _HEAD
SCORES, COUNTS, GRAMS, WORDS, SUMS_OF, HEAD = range(6)


def _table(kind: int, size: int, **columns) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are null."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [c.split() for c in _DEALT.split(", ")]
    columns["kind"] = np.full(size, kind, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kinds[t]) if c in columns else pa.nulls(size, kinds[t]) for c, t in fields],
        [c for c, _ in fields],
    )


def _part(found: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram: a multiplicative hash, so that parts are of one size."""
    return ((found.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _runs(part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by part that keeps the order inside, and (part, start, end) of each in it."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    return order, list(zip(part[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(part)]))


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, all lowest bytes first: sorted ones compress well this way."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _slice_bits(depth: int) -> int:
    """Bits for the place in a slice that a gram of ``depth + 1`` bytes leaves free, 8 at most."""
    return min(8, 63 - 8 * (depth + 1))


def _deal_scores(parts: int):
    """Sorted grams and their scores, one row for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, logp = (batch.column(c).to_numpy() for c in ("gram", "logp"))
            order, runs = _runs(_part(found, parts))
            found, logp = found[order], logp[order]
            yield _table(
                SCORES, len(runs), part=[p for p, _, _ in runs], x=[found[a:b].tobytes() for _, a, b in runs],
                y=[logp[a:b].tobytes() for _, a, b in runs],
            )

    return run


def _deal_counts(parts: int):
    """Words and their counts, one row for each part. No word holds a line feed but the end, which is a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, tuple[list, list]] = {}
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if word != END:
                    names, counts = found.setdefault(zlib.crc32(word) % parts, ([], []))
                    names.append(word)
                    counts.append(n)
            yield _table(
                COUNTS, len(found), part=list(found), x=[END.join(names) for names, _ in found.values()],
                y=[np.array(counts, np.int64).tobytes() for _, counts in found.values()],
            )

    return run


def _score(shared, depth: int, parts: int):
    bits = _slice_bits(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logps, frequent = shared.value
        # Numbers of slices are those of a task and its rows, which are the same when it runs again.
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _read(batches, 1 << bits):
            number += 1
            heads, rest = [], [np.zeros(0, np.int64)]
            words: dict[int, tuple[list, list]] = {}
            for place, (doc_id, text) in enumerate(zip(ids, texts)):
                tokens = text.split()
                tokens.append(END)
                known, base = 0, 0.0
                for word, n in Counter(tokens).items():
                    value = frequent.get(word)
                    if value is not None:
                        known += n
                        base += n * value
                    else:
                        # The end that no training document has is counted as a word that nobody knows.
                        names, numbers = words.setdefault(zlib.crc32(word) % parts, ([], []))
                        names.append(word if word != END else b"")
                        numbers.append(n << bits | place)
                score = 0.0
                found = grams(text, depth)
                for start in range(0, len(found), PLACES):
                    some = found[start : start + PLACES]
                    at = np.searchsorted(keys, some)
                    hit = keys[at] == some
                    score += float(logps[at[hit]].sum())
                    rest.append(some[~hit] << bits | place)
                heads.append((doc_id, held_out(doc_id), len(tokens), known, base, score, len(text) + 1))
            names = ("doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes")
            yield _table(
                HEAD, len(heads), part=[number % parts] * len(heads), slice=[number] * len(heads), place=range(len(heads)),
                **dict(zip(names, zip(*heads))),
            )
            yield _table(
                WORDS, len(words), part=list(words), slice=[number] * len(words),
                x=[END.join(asked) for asked, _ in words.values()],
                y=[_planes(np.array(numbers, np.int64)) for _, numbers in words.values()],
            )
            others, n = np.unique(np.concatenate(rest), return_counts=True)
            order, runs = _runs(_part(others >> bits, parts))
            others, n = others[order], n[order]
            yield _table(
                GRAMS, len(runs), part=[p for p, _, _ in runs], slice=[number] * len(runs),
                x=[_planes(others[a:b]) for _, a, b in runs], y=[_planes(n[a:b]) for _, a, b in runs],
            )

    return run


def _look_up(depth: int, floor: float):
    """Rows of a part in the order of their kinds: its scores and counts first, then the slices that ask for them.

    Sums are three numbers a document: score, known tokens, base.
    """
    bits = _slice_bits(depth)
    room, unknown = 1 << bits, math.log10(ALPHA) - floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        part, keys, logps, counts = None, [], [], {}

        def summed() -> pa.RecordBatch:
            return _table(SUMS_OF, len(sums), slice=list(sums), x=[v.tobytes() for v in sums.values()])

        for batch in batches:
            through = pa.compute.equal(batch.column("kind"), HEAD)
            yield batch.filter(through)
            asked = batch.filter(pa.compute.invert(through))
            rows = zip(asked.column("kind").to_pylist(), asked.column("part").to_pylist(), asked.column("slice").to_pylist())
            for i, (kind, here, number) in enumerate(rows):
                x, y = asked.column("x")[i].as_py(), asked.column("y")[i].as_py()
                if here != part:
                    part, keys, logps, counts = here, [], [], {}
                if kind == SCORES:
                    keys.append(np.frombuffer(x, np.int64))
                    logps.append(np.frombuffer(y))
                    continue
                if kind == COUNTS:
                    counts.update(zip(x.split(END), np.frombuffer(y, np.int64).tolist()))
                    continue
                if number not in sums:
                    sums[number] = np.zeros((3, room))
                total = sums[number]
                if kind == GRAMS:
                    if isinstance(keys, list):
                        keys, logps = np.concatenate(keys), np.concatenate(logps)
                        order = np.argsort(keys)
                        keys, logps = keys[order], logps[order]
                    asks = _values(x)
                    found = logps[np.searchsorted(keys, asks >> bits)] * _values(y)
                    total[0] += np.bincount(asks & (room - 1), weights=found, minlength=room)
                    continue
                numbers, c = _values(y), np.array([counts.get(w, 0) for w in x.split(END)], np.float64)
                n, place = numbers >> bits, numbers & (room - 1)
                total[1] += np.bincount(place, weights=n * (c > 0), minlength=room)
                total[2] += np.bincount(place, weights=n * np.where(c > 0, np.log10(c + ALPHA) - floor, unknown), minlength=room)
            if 3 * room * len(sums) > SUMS:
                yield summed()
                sums = {}
        yield summed()

    return run


def _bring_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a slice in the order of their kinds: sums first, then the documents they belong to."""
    names = [c.split()[0] for c in _HEAD.split(", ")]
    number, total = None, None
    for batch in batches:
        own = {c: batch.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in ("score", "n_known", "base")}
        heads = []
        for i, (kind, here, x, place) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("kind", "slice", "x", "place")))):
            if here != number:
                number, total = here, None
            if kind == SUMS_OF:
                sums = np.frombuffer(x).reshape(3, -1)
                total = sums if total is None else total + sums
                continue
            heads.append(i)
            if total is not None:
                for k, c in enumerate(("score", "n_known", "base")):
                    own[c][i] += total[k, place]
        for c, values in own.items():
            field = batch.schema.get_field_index(c)
            whole = values if c != "n_known" else np.nan_to_num(values).astype("int64")
            batch = batch.set_column(field, c, pa.array(whole))
        yield batch.take(pa.array(heads, pa.int64())).select(names)


def score_documents(
    documents: DataFrame, depth: int = DEPTH, contexts: int = CONTEXTS, frequent: int = FREQUENT
) -> DataFrame:
    """Scores of every row of ``documents`` (``doc_id`` bigint, ``text`` string).

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``. The score is the log10
    probability that the context tree gives the text and its end; ``bits_per_byte`` is its code length by the bytes of
    the text and the end. A null text counts as empty: one token, the end. Without training documents the base knows no token and all bytes are
    equally likely. Repeated rows get the same scores each. Columns beside ``doc_id`` and ``text`` are not read. The rows are
    read twice and numbered as they come, so they have to lie in storage or be frozen there.
    """
    spark = documents.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = documents.select("doc_id", "text")
    counts = count(rows, depth)
    words = counts.filter("word is not null").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = math.log10(total + ALPHA * (distinct + 1))
    least = max(1, -(-total // frequent))
    top = words.filter((F.col("n") >= least) | (F.col("word") == F.lit(bytes(END)))).toArrow()  # the end always travels
    known = {
        w: math.log10(n + ALPHA) - floor for w, n in zip(top.column("word").to_pylist(), top.column("n").to_pylist())
    }
    scores = gram_scores(counts, depth)
    seen = counts.filter("gram is not null")
    places = seen.agg(F.sum("places")).first()[0] or 0
    often = seen.filter(F.col("places") >= max(1, -(-places // contexts))).select("gram")
    sent = scores.join(often, "gram").toArrow()
    order = np.argsort(sent.column("gram").to_numpy())
    # A last key above all grams, so that every search ends at a key.
    keys = np.append(sent.column("gram").to_numpy()[order], np.iinfo(np.int64).max)
    shared = spark.sparkContext.broadcast((keys, sent.column("logp").to_numpy()[order], known))
    parts = max(1, -(-max(seen.count(), distinct) // PART_GRAMS))
    dealt = (
        scores.mapInArrow(_deal_scores(parts), _DEALT)
        .unionByName(words.filter(F.col("n") < least).mapInArrow(_deal_counts(parts), _DEALT))
        .unionByName(rows.mapInArrow(_score(shared, depth, parts), _DEALT))
    )
    scored = freeze(
        dealt.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(_look_up(depth, floor), _DEALT), "scored"
    )
    heads = scored.repartition("slice").sortWithinPartitions("slice", "kind").mapInArrow(_bring_back, _HEAD)
    score = F.col("score")
    return heads.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        (-score / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
