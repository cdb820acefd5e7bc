"""Line deduplication, fill-in-middle and the conversation trie against plain Python on small and odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarind.llm import fill_in_middle, line_dedup, turn_trie

DOCS = "doc_id long, text string"
TALK = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\u000b\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines ------------------------------------------------------------------------------------------------------------
def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def lines_left(docs, least_chars=40, least_docs=5):
    """Distinct ids only."""
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(doc_id)
    keep = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_docs}
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        left = [x for x in lines if keep.get(key_of(x), doc_id) == doc_id]
        out[doc_id] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def cleaned(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in df.collect()}


@pytest.mark.parametrize("share", [1, 20, 10**9])
def test_lines_on_a_skewed_table(spark, monkeypatch, share):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    pick = random.Random(5)
    pool = [f"Line {i} " + "äbC" * pick.randint(8, 16) for i in range(60)]
    docs = []
    for i in range(400):
        lines = [pick.choice(BLANK) * pick.randint(0, 2) * (c != "\n") + c for c in pick.choices(pool, k=pick.randint(0, 6))]
        lines = [x.replace("\n", "") for x in lines]
        if i % 3 == 0:
            lines.insert(pick.randint(0, len(lines)), "  THE line that a third of all documents hold, up to case and ends \r")
        if i % 5 == 0:
            lines += ["short", ""]
        docs.append((i, "\n".join(lines)))
    assert cleaned(line_dedup.drop_shared_lines(spark.createDataFrame(docs, DOCS))) == lines_left(docs)


def test_lines_of_odd_tables(spark):
    shared = "x" * 40
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, shared), (5, shared.upper() + "\n" + shared), (6, shared[:39]),
        (7, f"a\n\t{shared} \nb\n"), (8, shared), (9, "y" * 300_000 + "\n" + shared),
    ]
    assert cleaned(line_dedup.drop_shared_lines(spark.createDataFrame(rows, DOCS))) == lines_left(rows)
    # four documents with it are not enough
    few = rows[:-1]
    assert cleaned(line_dedup.drop_shared_lines(spark.createDataFrame(few, DOCS))) == lines_left(few)
    assert cleaned(line_dedup.drop_shared_lines(spark.createDataFrame(few, DOCS), least_docs=4)) == lines_left(few, least_docs=4)
    assert line_dedup.document_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_lines_of_repeated_and_missing_ids(spark):
    shared = "z" * 50
    rows = [(1, shared)] * 4 + [(None, shared + "\nown"), (2, shared), (3, shared), (None, "other\n" + shared)]
    out = [tuple(r) for r in line_dedup.drop_shared_lines(spark.createDataFrame(rows, DOCS)).collect()]
    # ids 1, 2, 3 and the missing one are four documents
    assert Counter(out) == Counter((i, t, len(t.split("\n")), 0) for i, t in rows)
    out = line_dedup.drop_shared_lines(spark.createDataFrame(rows + [(4, shared)], DOCS)).collect()
    assert Counter((r.doc_id, r.text, r.n_dropped) for r in out) == Counter(
        [(1, "", 1)] * 4 + [(None, "own", 1), (2, "", 1), (3, "", 1), (None, "other", 1), (4, shared, 0)]
    )


def test_lines_keep_other_columns_whatever_their_names(spark):
    shared = "w" * 45
    rows = [(i, shared + f"\n{i}", 7, "r", i, 1.5) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _row string, _pos long, n_lines double")
    out = line_dedup.drop_shared_lines(df)
    assert out.columns == ["doc_id", "text", "_id", "_row", "_pos", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect())) == [
        (i, f"{i}" if i < 4 else shared + "\n4", 7, "r", i, 2, int(i < 4)) for i in range(5)
    ]


# --- fill-in-middle -----------------------------------------------------------------------------------------------------
def transformed(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, h = len(units), sha(f"42:{doc_id}")
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", " ", "\n\t \r", "word", " word", "word ", "a <P> b", "<S>", "x<M", "a<P", "<<", ">", "<P", "   wide\u0085",
    "\U0001f600 \U0001f600\U0001f600", "0 1 2 3 4 5 6 7 8 9 " * 40, "word " * 60_000, "x" * 300_000, " " * 100_000,
    "a\x00b c", "\x1c \x1d",
]


def test_every_form_against_plain_python(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(-40, 200)]
    made = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, DOCS))
    out = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()}
    assert out == {i: transformed(i, t) for i, t in rows}
    assert Counter(v[1] for v in out.values()).keys() == {"plain", "psm", "spm"}


def test_outputs_give_the_texts_back(spark):
    rows = [(i, "<".join(random.Random(i).choices(["a ", "<", ">", "P", "S>", "M", "\n"], k=12))) for i in range(300)]
    made = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, DOCS), fim_percent=100)
    back = made.select("doc_id", "form", fill_in_middle.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert {r.doc_id: r.text for r in back} == dict(rows)
    assert sum(r.form != "plain" for r in back) > 30


def test_fill_in_middle_of_odd_tables(spark):
    assert fill_in_middle.document_fim(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(None, "a b c d e f g")] * 2 + [(5, "a b")] * 3
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("_text", "_id", "_cut", "n", "form", "output")})
    out = fill_in_middle.fill_in_middle(df).collect()
    assert Counter((r.doc_id, r.output) for r in out) == Counter(
        (i, transformed("" if i is None else i, t)[4]) for i, t in rows
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\u000b\f\rab é\U0001f600", max_size=40), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_one_match_keeps_every_unit(text, first, second):
    ends = [m.end() for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)]
    n, low, high = fill_in_middle.cut_offsets(text, first, second)
    cuts = sorted(([0] + ends)[h % (len(ends) + 1)] for h in (first, second))
    assert (n, low, high) == (len(ends), *cuts)


# --- trie -------------------------------------------------------------------------------------------------------------
def trie_of(told):
    """``told``: conv_id -> list of (role, text). The nodes as the operator names them."""
    members = defaultdict(list)
    for conv, turns in told.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            min(convs), len(path), min(members[path[:-1]]) if path else -1, len(convs), children[path], leaves[path],
            saved[path], sha(",".join(str(c) for c in sorted(convs) if len(told[c]) == len(path))),
        )
        for path, convs in members.items()
    )


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def nodes(df):
    return sorted(
        (r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
         r.saved_tokens, r.ends_sha256)
        for r in df.collect()
    )


def talk(seed, n):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(n * 2), n):
        for t in range(pick.randint(1, 9)):
            rows.append((c, pick.choice([t, None, 3]), pick.choice(["user", "assistant", None]), pick.choice(["a", "bb", "", None, "cccé"])))
    return rows


@pytest.mark.parametrize("ranges", [None, 1, 2, 7, 40])
def test_trie_in_any_number_of_ranges(spark, ranges):
    rows = talk(3, 260) + [(None, 0, "user", "lost")]
    told = turn_trie.sequences(turn_trie.turn_ids(spark.createDataFrame(rows, TALK)))
    assert nodes(turn_trie.prefix_trie(told, ranges)) == trie_of(rebuilt(rows))


@pytest.mark.parametrize("ranges", [1, 5])
def test_trie_of_copies_and_long_conversations(spark, ranges):
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 99) for t in range(6)]  # copies
    rows += [(c, t, "user", f"turn {t}" if t < 190 + c % 3 else f"{c}") for c in range(300, 306) for t in range(200)]
    rows += [(5000 + c, 0, "user", "same start") for c in range(100)] + [(7777, 0, "user", "alone")]
    rows += [(7801, 0, "a", "x"), (7802, 0, "ax", "")]  # equal when role and text are run together
    told = turn_trie.sequences(turn_trie.turn_ids(spark.createDataFrame(rows, TALK)))
    expected = rebuilt(rows)
    assert any(not t for t in expected.values())  # turnless ones are members of the root
    assert nodes(turn_trie.prefix_trie(told, ranges)) == trie_of(expected)


def test_trie_of_empty_and_odd_tables(spark):
    assert turn_trie.conversation_trie(spark.createDataFrame([], TALK)).collect() == []
    assert turn_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], TALK)).collect() == []
    rows = [(0, 0, "user", "x" * 300_000)] * 3 + [(3, None, None, None), (200, 1, "user", "y"), (-150, 1, "user", "n")]
    df = spark.createDataFrame(rows, TALK).withColumns({c: F.lit(1) for c in ("_t", "_base", "key", "ids", "chars", "a")})
    out = nodes(turn_trie.conversation_trie(df))
    expected = rebuilt([r for r in rows if r[0] >= 0])
    expected[-150] = [("user", "n")][zlib.crc32(b"-150") % 6 :]  # its block starts at -100, which is absent
    assert out == trie_of(expected)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1)), max_size=9).map(tuple), min_size=1, max_size=30),
       st.integers(1, 5))
def test_rows_sorted_by_padded_matrices(rows, width):
    rows = sorted(rows, key=hash)
    length = np.array([len(r) for r in rows])
    ids = np.array([p for r in rows for p in r], "int64").reshape(-1, 2)
    before, turn_trie.WIDTH = turn_trie.WIDTH, width
    try:
        order, common = turn_trie.sorted_rows(ids, length.cumsum() - length, length)
    finally:
        turn_trie.WIDTH = before
    ordered = [rows[i] for i in order]
    assert ordered == sorted(rows)
    shared = [next((d for d, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(ordered, ordered[1:])]
    assert common.tolist() == [-1, *shared]


def test_hot_conversations_meet_as_runs(spark):
    """Copies of one conversation come to a task as one row for each run of ids."""
    told = spark.range(100_000).select(
        F.col("id").alias("conv_id"),
        F.array(F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(2).cast("bigint").alias("b"), F.lit(3).alias("chars"))).alias("turns"),
    )
    out = nodes(turn_trie.prefix_trie(told, 3))
    joined = sha(",".join(map(str, range(100_000))))
    assert out == [
        (0, 0, -1, 100_000, 1, 1, 99_999 * 3, sha("")), (0, 1, 0, 100_000, 0, 1, 99_999 * 3, joined)
    ]
