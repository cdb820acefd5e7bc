"""Quality rules, personal data, chat formatting, URL filters: brute force and odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tamarind.llm import chat, personal, quality, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS)


# --- quality ------------------------------------------------------------------------------------------------------
def base_figures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


ODD_TEXTS = [
    None, "", " \n\t\r\x0b\x0c ", "one", "a b c d e a b c d e", "a a a a a a a", "x\n\n x\nx\n x", "é ß\u00a0ü | # <>\u2003z",
    "a b c d e f " * 40, "no blank " + "y" * 50_000, "\n".join(["Same line here."] * 30), "a\rb\x0bc\x0cd e f g",
]


def test_base_figures(spark):
    rng = random.Random(3)
    texts = ODD_TEXTS + [
        " ".join(rng.choice("a b c dd é. |".split()) + rng.choice(["", "", "\n", "\t"]) for _ in range(rng.randint(0, 90)))
        for _ in range(80)
    ]
    rows = quality.document_quality(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == base_figures(texts[r.doc_id]), texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_lines_and_verdict(spark):
    good = "This is a plain sentence about nothing much, and it ends here."
    texts = [
        f"{good}\nHome | News | Sport | About",  # one line goes, the document stays
        f"Home | News | Sport | About | Contact | Terms | Help | Jobs\nx.\n{good[:20]}",
        f"{good}\nAll rights reserved.",
        "THIS WHOLE TEXT IS SHOUTED AT THE READER! IT NEVER STOPS AND NEVER WILL!",
        "word### word&&& word*** word### word&&& word$$$ word### word%%% word&&& end.",
        "so so so so so the the the the the end end end end end of of of of of.",
    ]
    rows = {r.doc_id: r for r in quality.judge(documents(spark, texts)).collect()}
    assert rows[0].kept and rows[0].cleaned_text == good
    assert not rows[1].kept
    assert rows[2].kept and rows[2].cleaned_text == good
    assert not any(rows[i].kept for i in (3, 4, 5))


def test_clean_keeps_other_columns(spark):
    good = "This is a plain sentence about nothing much, and it ends here."
    df = spark.createDataFrame(
        [(1, good + "\nHome | a | b | c", "mine", 5, None), (2, None, None, None, 1)],
        "doc_id bigint, text string, kept string, n_chars bigint, N_WORDS int",
    )
    out = quality.clean(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert out.collect() == [Row(doc_id=1, text=good, kept="mine", n_chars=len(good), N_WORDS=None)]
    assert quality.clean(df.limit(0)).collect() == []


def test_clean_lines_stay(spark):
    """Words that hold a phrase, and sentences that end in the marks of other scripts."""
    lines = [
        "We design in the open and resign in time, as the catalog in the hall and the dialog in the book say.",
        "A blog in the sun, an unsubscribed reader, more than she had read moreover.",
        "यह एक साफ वाक्य है जो यहाँ समाप्त होता है।", "یہ ایک صاف جملہ ہے جو یہاں ختم ہوتا ہے۔", "Սա մաքուր նախադասություն է որ ավարտվում է։",
        "这是一个干净的句子。", "هل هذا سطر نظيف؟",
    ]
    judged = spark.createDataFrame([(x,) for x in lines], "x string").select("x", quality.line_fails(F.col("x")).alias("failed"))
    assert not [r.x for r in judged.collect() if r.failed]
    bad = ["Please sign in.", "Log in now.", "(c) All rights reserved.", "sign up", "Read more."]
    judged = spark.createDataFrame([(x,) for x in bad], "x string").select(quality.line_fails(F.col("x")).alias("failed"))
    assert all(r.failed for r in judged.collect())


def test_cleaning_judges_a_row_once(spark):
    df = spark.createDataFrame([(1, "Some text. " * 20, "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = quality.clean(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lorem ipsum") == 1


def test_repeated_rows_are_all_judged(spark):
    df = documents(spark, ["a b"]).union(documents(spark, ["a b"]))
    assert len(quality.document_quality(df).collect()) == 2


# --- personal data ------------------------------------------------------------------------------------------------
def passes_luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans(spark):
    rng = random.Random(5)
    texts = [
        None, "", "a@b.co_x@c.de", "a@b@c.d", "é😀 x.y@z-1.example.com, é", "1.2.3.4.5 256.1.1.1 01.002.3.255 1.1.1.1.1.1.1.1",
        "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "+1 (017) 555-7713 +12 +1-2-3-4-5-6-7-8 +49.30.1234567",
        "1" * 20_000, "a." * 5_000 + "b@" + "c." * 5_000 + "d", "+" + "1 " * 3_000, "@" * 1000, "9" * 16 + " " + "0" * 16,
    ]
    texts += ["".join(rng.choice("a1@.+- 4(0)_é\n") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    for r in personal.document_personal(documents(spark, texts)).collect():
        spans = base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone")
        ], texts[r.doc_id][:200]
        assert r.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()


def test_added_kinds_and_scores(spark):
    texts = ["my iban is GB82 WEST 1234 5698 7654 32 ok", "GB82 WEST 1234 5698 7654 33", "ssn: 123-45-6789", "no 123-45-6789",
             "ssn 000-45-6789", "card 4111 1111 1111 1111"]
    rows = {r.doc_id: r for r in personal.find_personal(documents(spark, texts)).collect()}
    assert [(s.kind, s.start, s.end) for s in rows[0].personal] == [("iban", 11, 38)]
    assert rows[1].personal == [] and rows[3].personal == [] and rows[4].personal == []
    assert [s.kind for s in rows[2].personal] == ["ssn"]
    assert rows[5].personal[0].score == pytest.approx(1.0)


# --- chat ---------------------------------------------------------------------------------------------------------
TURNS = "conv_id bigint, turn bigint, role string, text string, transcript int"


def chat_rows(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], TURNS)


def test_round_trip_and_examples(spark):
    rows = [
        (1, 0, "user", "<|turn|>\\<|end|>\n\\"), (1, 1, "assistant", "\\### a </turn> <|text|>x<\\|"), (1, 2, "user", None),
        (1, 3, "assistant", "é😀"), (2, 5, None, "only"), (3, 1, "assistant", None), (3, 1, "assistant", None),
        (None, None, "assistant", "z"), (4, 2, "a<|end|>\nb", "\n\n"), (4, None, "user", "first"),
    ]
    formatted = chat.transcripts(chat.format_turns(chat_rows(spark, rows))).cache()
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for r in chat.read_back(formatted).collect():
        turns = sorted(by[r.conv_id])
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    transcripts = {r.conv_id: r.transcript for r in formatted.collect()}
    examples = [r for r in chat.example_texts(formatted).orderBy("turn").collect() if r.conv_id == 1]
    assert [transcripts[1].startswith(e.text) for e in examples] == [True, True]
    assert [e.text[e.loss_start : e.loss_end] for e in examples] == ["\\\\### a </turn> <\\|text|>x<\\\\|", "é😀"]
    assert examples[1].text.startswith(examples[0].text) and examples[1].text.endswith("é😀<|end|>\n")
    assert chat.transcripts(chat.format_turns(chat_rows(spark, rows).limit(0))).count() == 0


# --- URLs ---------------------------------------------------------------------------------------------------------
def test_rules_and_parts(spark):
    cases = {
        "https://A.Example.ORG/es/x?q=/fr/": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org/en/12#f": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com?/de/": ("x.com", "", None, "allow"),
        "http://org": ("org", "", None, "allow"),
        "http://a://b/c": ("a:", "//b/c", None, "allow"),
        "no scheme/de/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://m.casino.example.net/p.html": ("m.casino.example.net", "/p.html", None, "block"),
    }
    urls_in = list(cases)
    pages = spark.createDataFrame([(i, u, 0) for i, u in enumerate(urls_in)], "page_id bigint, url string, host int")
    for blocks in (1, urls.BLOCKS):  # with one block the filter lets nearly everything through; the join settles it
        rows = urls.judge_pages(pages, urls.listed_urls(pages), blocks=blocks).collect()
        assert {urls_in[r.page_id]: (r.host, r.path, r.rule, r.verdict) for r in rows} == cases
    assert urls.judge_pages(pages.limit(0), urls.listed_urls(pages.limit(0))).count() == 0


def test_list_membership_is_exact(spark):
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("h"), "id").alias("url"))
    listed = listed.union(listed).union(spark.sql("select cast(null as string)"))
    rows = spark.range(3000).select("id", F.concat(F.lit("h"), "id").alias("u")).union(
        spark.sql("select -1L, cast(null as string)")
    )
    for blocks in (1, 64):
        out = urls.in_list(rows, listed, "u", blocks=blocks).collect()
        assert len(out) == 3001 and all(r.listed == (r.id >= 0 and r.id % 3 == 0) for r in out)


def test_one_row_for_each_assistant_turn(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"<|turn|>{i}\\") for i in range(40)] + [(2, 0, "user", "alone")]
    formatted = chat.transcripts(chat.format_turns(chat_rows(spark, rows)))
    transcripts = {r.conv_id: r.transcript for r in formatted.collect()}
    out = chat.expanded(formatted).orderBy("turn").collect()
    assert [(r.conv_id, r.turn) for r in out] == [(1, i + 1) for i in range(1, 40, 2)]
    assert all(transcripts[1][r.loss_start : r.loss_end] == r.reply for r in out)
    assert [r.turn for r in chat.expanded(formatted, outer=True).collect() if r.conv_id == 2] == [None]
    plan = chat.read_back(formatted)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in chat.with_planted(chat_rows(spark, rows))._jdf.queryExecution().executedPlan().toString()


def test_every_page_of_a_listed_host_is_listed(spark):
    # Three ids share a page, each with another spelling; the host is on no rule. Every page of it is on the list,
    # whatever its id, a missing one included.
    spellings = ("http://www.casino.net:80/{}/index.html", "https://casino.net/{}.htm?x=1", "http://m.Casino.net/{}/#top")
    pages = [(i, spellings[i % 3].format(i // 3)) for i in range(300)] + [(1000 + i, f"http://clean.net/{i}") for i in range(50)]
    pages += [(5000 + i, "http://casino.net/hot") for i in range(600)] + [(None, "http://casino.net/no-id")]
    df = spark.createDataFrame(pages, "page_id bigint, url string")
    assert urls.listed_urls(df).count() == 300 + 600 + 1
    for blocks in (1, urls.BLOCKS):
        out = urls.judge_pages(df, urls.listed_urls(df), blocks=blocks).collect()
        assert len(out) == len(pages)
        verdicts = {r.page_id: r.verdict == "block" for r in out}
        assert all(verdicts[i] for i in range(300)) and verdicts[None]
        assert not any(verdicts[1000 + i] for i in range(50))
        assert all(verdicts[5000 + i] for i in range(600))


def test_context_across_many_small_matches(spark):
    rng = random.Random(3)
    words = ["server", "1.2.3.4", "a@b.c", "+1 2345678", "078-05-1120", "ssn", "999.1.1.1", "x" * 50, "é", "mail "]
    texts = ["".join(rng.choice(words) + rng.choice(["", " ", "  "]) for _ in range(60)) for _ in range(150)]
    texts += ["1.1.1.1 " * 600, "1." * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in personal.find_personal(df).collect():
        text = texts[r.doc_id]
        for s in r.personal:
            kind = next(k for k in personal.KINDS if k.name == s.kind)
            around = text[max(0, s.start - personal.NEARBY) : s.start] + " " + text[s.end : s.end + personal.NEARBY]
            near = re.search(kind.context, around.lower()) is not None
            assert s.score == pytest.approx(min(kind.score + 0.3 * near, 1.0)), (s, around)
    assert personal.document_personal(df.limit(0)).collect() == []
