"""Deduplication, sharding, mixing, shingle join, tokens and scores: brute force and odd rows."""

import hashlib
import math
import os
import random
import re
import struct
import uuid
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tamarind.session import freeze
from tamarind.llm import bpe, context_tree, digests, lm_scoring, mixing, ngram_join, sharding
from tamarind.llm.components import components
from tamarind.llm.signature_tree import link_groups

FOLDER = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def index(spark):
    return digests.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", 4)


# --- exact dedup --------------------------------------------------------------------------------------------------
def test_dedup_over_batches(spark):
    known = index(spark)
    first = spark.createDataFrame(
        [(5, "a  b", "x"), (2, "a\tb", "y"), (2, "a\tb", "y"), (9, None, "z"), (8, "", None), (7, " ", "q"), (None, "n", "q")],
        "doc_id bigint, text string, digest string",
    )
    rows = digests.deduplicate(first, known).collect()
    got = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in rows)
    assert got == [
        (-1, None, 1, True), (2, 2, 3, False), (2, 2, 3, True), (5, 2, 3, False), (7, 7, 1, True), (8, 8, 2, True),
        (9, 8, 2, False),
    ]
    second = spark.createDataFrame([(1, "a b"), (3, "new"), (4, "new ")], DOCS)
    rows = digests.deduplicate(second, known).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in rows) == [(1, 2, False), (3, 3, True), (4, 4, True)]
    assert known.read().count() == 6
    assert digests.deduplicate(second.limit(0), known).count() == 0
    plan = known.read().join(spark.createDataFrame([("d",)], "digest string").hint("merge"), "digest")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("hashpartitioning") == 1  # the index itself is not moved


def test_two_batches_through_one_index(spark, monkeypatch):
    monkeypatch.setattr(digests, "HOT_SHARE", 10)
    rng = random.Random(5)
    texts = [rng.choice(["hot", "hot", None, "", f"t{rng.randrange(60)}", f"a \t{rng.randrange(9)}"]) for _ in range(400)]
    rows = [(i - 150, t) for i, t in enumerate(texts)] + [(None, "hot"), (None, "only null"), (3, texts[153]), (-150, "late")]
    df = spark.createDataFrame(rows, DOCS)
    normal = lambda t: re.sub(r"[ \t]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(
        ((i if i is not None else -999, keep[normal(t)], len(groups[normal(t)]), sha(normal(t))) for i, t in rows),
        key=repr,
    )
    before = {t.name for t in spark.catalog.listTables()}
    out = digests.document_duplicates(spark, df).collect()
    got = [(r.doc_id if r.doc_id is not None else -999, r.keep_id, r.group_size, r.text_sha256) for r in out]
    assert sorted(got, key=repr) == want
    assert sorted(r.text_sha256 for r in out if r.kept) == sorted(sha(t) for t in groups)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    assert {t.name for t in spark.catalog.listTables()} == before  # the index is gone
    assert digests.document_duplicates(spark, df.limit(0)).collect() == []


def test_the_second_batch_meets_the_index(spark, monkeypatch):
    known, plans = index(spark), []
    append = digests.DigestIndex.append

    def seen(self, classes):
        if self.exists():
            fresh = classes.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
            plans.append((fresh._jdf.queryExecution().executedPlan().toString(), fresh.count(), classes.count()))
        append(self, classes)

    monkeypatch.setattr(digests.DigestIndex, "append", seen)
    df = documents(spark, [f"t{i % 40}" for i in range(60)])
    digests.deduplicate_batches([df.filter("doc_id < 30"), df.filter("doc_id >= 30")], known)
    (plan, fresh, classes), = plans
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and (fresh, classes) == (10, 30)
    assert known.read().count() == 40


def test_without_duplicates_keeps_columns(spark):
    df = spark.createDataFrame(
        [(1, "a b", 1, "k"), (1, "a b", 1, "k"), (2, "a  b", 2, "k"), (None, "c", 3, None)],
        "doc_id bigint, text string, kept int, keep_id string",
    )
    out = digests.without_duplicates(df, index(spark))
    assert out.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text, r.kept) for r in out.collect()) == [(0, "c", 3), (1, "a b", 1)]


def test_hot_digest_is_joined_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(digests, "HOT_SHARE", 10)
    texts = ["hot"] * 300 + [f"t{i // 2}" for i in range(400)]
    rows = digests.deduplicate(documents(spark, texts), index(spark)).collect()
    assert len(rows) == 700 and sum(r.kept for r in rows) == 201
    assert {r.group_size for r in rows} == {300, 2}


# --- sharding -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 101, 1000])
def test_permutation_is_a_bijection(spark, n):
    placed = sharding.permuted(spark.range(n).toDF("i"), "i", n, seed=n).collect()
    assert sorted(r.place for r in placed) == list(range(n))
    again = sharding.permuted(spark.range(n).toDF("i").repartition(3), "i", n, seed=n).collect()
    assert sorted(placed) == sorted(again)


def test_shards(spark):
    texts = [None, "", "é", "x" * 100_000] + ["copy"] * 90
    df = documents(spark, texts).withColumn("shard", F.lit("clash"))
    df = df.union(spark.createDataFrame([(3, "same", "c")] * 50, df.schema)).union(
        spark.createDataFrame([(None, "n", "c")] * 3, df.schema)
    )
    rows = sharding.document_shards(df, 7).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == 147 and set(slots) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    expected = Counter(
        (r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect()
    )
    assert sizes == expected
    assert sharding.document_shards(df.limit(0)).count() == 0


# --- mixing -------------------------------------------------------------------------------------------------------
def check_mix(rows, weights, total):
    assert len(rows) == total
    places = sorted((r.slot, r.offset) for r in rows)
    assert len(set(places)) == total
    done, target = Counter(), [r for r in rows if r.in_target]
    slots = sorted({(r.slot, r.source) for r in target})
    assert [s for s, _ in slots] == list(range(len(slots)))  # one block in each slot and no gap before the end
    for k, (_, source) in enumerate(slots, 1):
        done[source] += 1
        assert all(abs(done[s] - w * k) < 1 for s, w in weights.items())


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 1.0, "c": 0.01, None: 2.0}])
def test_mix(spark, weights):
    rows = [(i, "a" if i % 3 else ("b" if i % 2 else "c"), "x") for i in range(900)] + [(5, None, "y")] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, source string, slot string")
    out = mixing.mix(df, weights, block_rows=8, period=512).collect()
    check_mix(out, {r.source: r.weight for r in out}, 940)
    assert sum({r.source: r.weight for r in out}.values()) == pytest.approx(1)
    assert mixing.mix(df.limit(0)).count() == 0
    ordered = mixing.in_mix_order(df, weights, block_rows=8, period=512)
    assert ordered.columns == df.columns
    assert sorted(ordered.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 1.0})


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 3, "b": 5}, {"a": 97, "b": 1, "c": 30}, dict.fromkeys(range(16), 1)])
def test_period_meets_all_deadlines(shares):
    period, order = sum(shares.values()), mixing.one_period(shares)
    done = Counter()
    for t, s in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[x] - n * t / period) < 1 for x, n in shares.items())
    assert done == Counter(shares)


def test_mix_follows_the_asked_weights(spark):
    """Weights that are no multiples of 1 / PERIOD: each prefix is less than a block off them, also after many slots."""
    rng = random.Random(3)
    weights = {f"s{i:03d}": math.sqrt(rng.randint(100, 9000)) for i in range(300)} | {"hot": 3000.0, None: 0.7}
    total = sum(map(Fraction, weights.values()))
    blocks = {s: 1 + int(Fraction(w) / total * 40_000) for s, w in weights.items()}
    order, end = mixing.schedule(mixing.whole_shares(weights), blocks)
    names = mixing._ranked(mixing.whole_shares(weights))
    assert Counter(names[rank] for rank, _, _ in order) == blocks and end > 35_000
    shares = [float(Fraction(weights[s]) / total) for s in names]
    done = np.zeros(len(names))
    for k, (rank, block, slot) in enumerate(order[:end]):
        assert slot == k and block == done[rank]
        done[rank] += 1
        if k % 97 == 0 or k == end - 1:
            assert np.abs(done - np.array(shares) * (k + 1)).max() < 1
    rows = [(i, "a" if i % 3 else "b") for i in range(1500)]
    asked = {"a": 2.0**0.5, "b": 0.5}
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), asked, block_rows=2, period=4, segment=40).collect()
    check_mix(out, {s: w / sum(asked.values()) for s, w in asked.items()}, 1500)


@pytest.mark.parametrize("seed", range(6))
def test_segments_meet_without_handing_on_state(seed):
    """Every source is less than one block off at every slot, across the borders of short segments as well."""
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(rng.choice([2, 3, 7, 40]))]
    weights = {n: rng.choice([1.0, rng.random() + 0.01, math.sqrt(rng.randint(1, 900)), 0.25]) for n in names}
    shares = mixing.whole_shares(weights)
    ranked, total = mixing._ranked(shares), sum(shares.values())
    sizes = [shares[n] for n in ranked]
    counts = [3 + n * 3000 // total for n in sizes]
    at, done, every = 0, [0] * len(sizes), []
    for stop in sorted(rng.sample(range(1, 2500), 60)):  # any borders, also one slot apart
        rows = list(mixing._segment(sizes, [10**9] * len(sizes), at, stop))
        assert [slot for _, _, slot, _ in rows] == list(range(at, stop))
        for rank, block, slot, gone in rows:
            assert block == done[rank] and not gone
            done[rank] += 1
            assert all(abs(d * total - n * (slot + 1)) < total for d, n in zip(done, sizes))
        assert done == mixing._allotted(sizes, stop)
        at = stop
    for length in (1, 50, 1000):
        number, length = mixing._segments(sizes, counts, length)
        every, end = mixing.schedule(shares, dict(zip(ranked, counts)), length)
        assert Counter(r for r, _, _ in every) == Counter(dict(enumerate(counts)))
        assert [s for _, _, s in every][:end] == list(range(end)) and len({s for _, _, s in every}) == len(every)
        assert all(i * total // sizes[r] <= s < -(-(i + 1) * total // sizes[r]) for r, i, s in every)
        assert end >= min(c * total // n for n, c in zip(sizes, counts)) and number >= 1


# --- shingle join -------------------------------------------------------------------------------------------------
def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(rng, groups, copies, words):
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, words // 25))):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(text[: len(text) - rng.randrange(0, max(1, words // 8))]))
    return out


@pytest.mark.parametrize("block", [6, 2048])
def test_components_against_brute_force(spark, block):
    rng = random.Random(block)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [None, "", " \n", "a b", "A  b", "a b c d e", "A B C D E f"]
    texts += near_copies(rng, 6, 12, 120) + near_copies(rng, 1, 40, 60) + near_copies(rng, 4, 3, 9)
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))) for _ in range(60)]
    texts += [texts[10]] * 5 + ["z " * 3000, "z " * 2999 + "y"]
    rng.shuffle(texts)
    rows = ngram_join.similar_documents(documents(spark, texts).withColumn("cluster", F.lit(1)), block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [
        (i, n, c) for i, (n, c) in enumerate(brute_components(texts))
    ]


def test_odd_rows_of_the_join(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (1, "q r s"), (7, "Q R S"), (8, None)], DOCS)
    rows = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_join.similar_documents(df).collect())
    assert rows == [(-1, -1), (1, 1), (1, 1), (1, 1), (7, 1), (8, 8)]
    assert ngram_join.similar_documents(df.limit(0)).count() == 0
    kept = ngram_join.keep_one(df).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == [(-1, "a b c"), (1, "a b c"), (8, "")]


def test_tree_finds_all_groups():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
        for _ in range(rng.integers(1, 12)):
            keep = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])]
            sets.append(np.unique(np.concatenate((keep, rng.integers(0, 2**63, 4).astype(np.uint64)))))
    sets += [np.zeros(0, np.uint64)] * 2
    order = rng.permutation(len(sets))
    sets = [sets[i] for i in order]
    parent = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert link_groups(sets) == parent


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.union(spark.sql("select cast(null as bigint), 5L")).union(spark.sql("select 900L, 900L"))
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 0 for i in range(201)} | {900: 900}


# --- tokens -------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference_tokens():
    ranks = bpe.read_ranks(bpe.default_file())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_against_the_library(spark, reference_tokens):
    _, library = reference_tokens
    rng = random.Random(8)
    texts = [None, "", " ", "\n\n  x", "it's I'll", "<|endoftext|>", "日本語 é😀" * 20, "a" * 5000, "ab" * 3000 + "!" * 999]
    texts += ["".join(rng.choice("ab éß'1 \n.日😀tion") for _ in range(rng.randint(1, 200))) for _ in range(60)]
    rows = bpe.document_tokens(documents(spark, texts).withColumn("ids", F.lit(1))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids), text[:60]
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.document_tokens(documents(spark, texts).limit(0)).count() == 0


def test_other_columns_stay(spark):
    df = spark.createDataFrame([("k", "ab cd", 1), ("k", "ab cd", 1), (None, None, None)], "piece string, text string, n int")
    out = bpe.decode(bpe.encode(df))
    assert out.columns == ["piece", "n", "bytes"]
    assert sorted(str((r.piece, r.n, bytes(r["bytes"]))) for r in out.collect()) == sorted(
        str(x) for x in [("k", 1, b"ab cd"), ("k", 1, b"ab cd"), (None, None, b"")]
    )


def test_the_fold_merges_like_the_task(spark, reference_tokens):
    ranks, library = reference_tokens
    rng = random.Random(2)
    pieces = ["", "a", " the", "tionation", "éßü", "日本語", "xyzzyq" * 9]
    pieces += ["".join(rng.choice("aeionstrhé") for _ in range(rng.randint(1, 14))) for _ in range(80)]
    df = spark.createDataFrame([(p,) for p in pieces], "piece string")
    table = bpe.rank_literal(ranks)
    rows = df.select("piece", bpe.let(table, lambda t: bpe.folded(F.col("piece").cast("binary"), t)).alias("ids")).collect()
    for r in rows:
        assert r.ids == (bpe.merge(r.piece.encode(), ranks) if r.piece else [])
        assert bpe._merge_long(r.piece.encode(), ranks) == r.ids


# --- scores -------------------------------------------------------------------------------------------------------
def test_model_gives_probabilities_and_follows_the_formula():
    """One-bit world: bytes 0 and 255 only differ in their first decision, so the mixture can be worked out by hand."""
    depth = np.array([0, 0, 1, 1, 1])
    context = np.array([0, 0, 97, 97, 98])
    symbol = np.array([97, 98, 97, 98, 97])
    n = np.array([3, 2, 1, 2, 2])
    model = context_tree.build(1, depth, context, symbol, n)
    assert np.allclose((10.0 ** model.table[1:].astype(float)).sum(axis=1), 1, atol=1e-5)

    def kt(a, b):
        return math.exp(math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1)) / math.pi

    # Decision nodes on the way to "a" (0x61 = 01100001) and "b" (0x62 = 01100010): alike for six decisions, then they part.
    def chance(counts_root, counts_here, rest, goal):
        p = 1.0
        for k in range(8):
            def split(c, k=k):
                zero = sum(m for s, m in c.items() if f"{s:08b}"[:k] == goal[:k] and f"{s:08b}"[k] == "0")
                return zero, sum(m for s, m in c.items() if f"{s:08b}"[:k] == goal[:k] and f"{s:08b}"[k] == "1")
            root, kids = split(counts_root), [split({97: 1, 98: 2}), split({97: 2}), split(rest)]
            deep = math.prod(kt(*x) for x in kids)
            leaf = 0.5 * kt(*root) / (0.5 * kt(*root) + 0.5 * deep)
            here = split(counts_here)
            bit = int(goal[k])
            p *= leaf * (root[bit] + 0.5) / (sum(root) + 1) + (1 - leaf) * (here[bit] + 0.5) / (sum(here) + 1)
        return p

    root, node = {97: 3, 98: 2}, model.child[1, 97]
    assert 10 ** model.table[node, 98] == pytest.approx(chance(root, {97: 1, 98: 2}, {}, f"{98:08b}"), rel=1e-4)
    assert 10 ** model.table[1, 97] == pytest.approx(chance(root, {}, {}, f"{97:08b}"), rel=1e-4)  # context not seen


def test_scores_against_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "  ", "É A\x0bb"] + [" ".join(rng.choice("Aa b cc d\te é".split(" ")) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9, texts[9]), (9, "other text"), (None, "a a zz")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n int")
    out = lm_scoring.score_documents(df, depth=2, contexts=64, frequent=4).collect()

    def tokens(t):
        return (t or "").encode().translate(LOWER).split() + [None]

    def out_of_training(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0

    counts = Counter(w for i, t in rows if not out_of_training(i) for w in tokens(t))
    total, floor = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    expected = Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.1) / floor) for w in tokens(t))
        expected[(i, out_of_training(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_scores_without_training_rows(spark):
    df = spark.createDataFrame([(None, "ab")], DOCS)
    row = lm_scoring.score_documents(df).first()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(3 * math.log10(1 / 256))
    assert lm_scoring.score_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("depth, contexts", [(0, 8), (2, 8), (4, 8), (5, 64), (5, 1 << 21)])
def test_every_context_counts_at_any_size(spark, monkeypatch, depth, contexts):
    """A filler text must not take rare contexts out of the model: scores equal those of the whole tree in memory."""
    monkeypatch.setattr(context_tree, "CHUNK", 50)
    rng = random.Random(7)
    texts = [" ".join(rng.choice("a bb abc cab é".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["zz " * 40_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    out = lm_scoring.score_documents(spark.createDataFrame(rows, DOCS), depth=depth, contexts=contexts).collect()
    assert len(out) == len(rows)
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            for g in context_tree.grams(t.encode(), depth).tolist():
                counts.update((d, (g >> 8) & ((1 << 8 * d) - 1), g & 255) for d in range(depth + 1))
    model = context_tree.build(depth, *(np.array(c) for c in zip(*counts)), np.array(list(counts.values())))
    for r in out:
        expected = model.score(texts[r.doc_id].encode())
        assert r.score == pytest.approx(expected, rel=1e-5)
        assert r.bits_per_byte == pytest.approx(-expected / math.log10(2) / (len(texts[r.doc_id].encode()) + 1), rel=1e-5)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")
def test_held_out_texts_are_coded_well(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [r for r in lm_scoring.score_documents(df).collect() if r.held_out]
    assert rows and sum(r.bits_per_byte for r in rows) / len(rows) < 4.0
    order_0 = [r for r in lm_scoring.score_documents(df, depth=0).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.score for r in order_0)


def check_places(docs, tokens):
    """Places of the last stage against blocks of documents scheduled by brute force, slot by slot."""
    sizes = Counter(d.source for d in docs)
    root = {s: Fraction(float(n) ** 0.5) for s, n in sizes.items()}
    total, source = sum(root.values()), {d.doc_id: d.source for d in docs}
    blocks = {s: -(-n // mixing.BLOCK_ROWS) for s, n in sizes.items()}
    done, slots, slot = Counter(), {}, 0
    while sum(done.values()) < sum(blocks.values()):
        free = [s for s in root if done[s] < blocks[s] and math.floor(done[s] * total / root[s]) <= slot]
        if free:
            s = min(free, key=lambda s: (math.ceil((done[s] + 1) * total / root[s]), -root[s], s is None, str(s)))
            slots[slot] = s
            done[s] += 1
        slot += 1
    got = sorted((r.mix_place, source[r.doc_id]) for r in tokens)
    assert [p for p, _ in got] == list(range(len(docs)))
    # Up to the first source that runs out the schedules are the same, block for block.
    expected, left, rows = [], Counter(blocks), Counter(sizes)
    for _, s in sorted(slots.items()):
        n = min(rows[s], mixing.BLOCK_ROWS)
        expected += [s] * n
        rows[s] -= n
        left[s] -= 1
        if not left[s]:
            break
    assert [s for _, s in got][: len(expected)] == expected


def test_the_mix_reaches_the_result(spark):
    import corpus_pipeline

    rows = [(i, f"Text {i}.", "a" if i % 3 else ("b" if i % 2 else None)) for i in range(1500)] + [(None, "x", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")

    def placed(df):
        mixed = freeze(corpus_pipeline.source_mixing(spark, df, ""), "mixed")
        return corpus_pipeline.byte_bpe(spark, mixed, "").collect()

    got, again = placed(docs.repartition(5)), placed(docs.orderBy(F.desc("doc_id")))
    assert sorted((r.mix_place, r.doc_id or -1) for r in got) == sorted((r.mix_place, r.doc_id or -1) for r in again)
    check_places(docs.collect(), got)
    # Without the stage before, the places are those of the table as it was.
    unmixed = corpus_pipeline.byte_bpe(spark, freeze(docs.coalesce(1), "unmixed"), "").collect()
    assert sorted(r.mix_place for r in unmixed) == list(range(1501))
    assert {r.doc_id: r.mix_place for r in unmixed} != {r.doc_id: r.mix_place for r in got}


# --- pipeline -----------------------------------------------------------------------------------------------------
@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")
def test_pipeline_against_brute_force(spark, reference_tokens):
    import corpus_pipeline

    _, library = reference_tokens
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, seen = table, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = freeze(stage(spark, docs, FOLDER), "stage")
        rows = docs.collect()
        seen.append(name)
        if name != "byte-level BPE":
            assert docs.columns == table.columns
        old = {r.doc_id: r.text for r in before.collect()}
        if name == "exact dedup":
            first = {}
            for i in sorted(old):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", old[i]), i)
            assert {r.doc_id for r in rows} == set(first.values())
        elif name == "n-gram Jaccard join":
            ids = sorted(old)
            groups = brute_components([old[i] for i in ids])
            assert {r.doc_id for r in rows} == {ids[c] for _, c in groups}
        elif name == "source mixing":
            assert {r.doc_id for r in rows} == set(old) and len(rows) == len(old)
        elif name == "byte-level BPE":
            assert len(rows) == len(old)
            assert all(r.n_tokens == len(library.encode_ordinary(old[r.doc_id])) for r in rows)
    assert len(seen) == 5
    check_places(before.collect(), rows)
    final = sorted(corpus_pipeline.run(spark, FOLDER).collect())
    assert final == sorted(docs.collect())
    # Every stage matters: without it the result is another one. (Exact copies are near copies too; their stage only spares
    # the next one work, and is tested above.)
    for left_out in (0, 2, 3):
        some = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            if i != left_out:
                some = freeze(stage(spark, some, FOLDER), "stage")
        assert sorted(some.collect()) != final, corpus_pipeline.STAGES[left_out][0]
