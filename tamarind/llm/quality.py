"""Line-first quality rules: judge lines, drop those that fail, reject documents that lose too much text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.texts import let, spaced, words

WINDOW = 5
#: Share of a document's line characters that has to survive.
LEAST_KEPT = 0.5
#: Characters of ``SYMBOLS`` a line may have for each word.
MOST_SYMBOLS = 0.3
SYMBOLS = r"#*$%&|<>"
#: Share of capital letters among a line's word characters, for lines of SHOUT_WORDS words or more.
MOST_CAPITALS = 0.6
SHOUT_WORDS = 4
#: Share of words equal to the word before, for lines of STUTTER_WORDS words or more.
MOST_STUTTER = 0.3
STUTTER_WORDS = 10
#: Separators that make a line a navigation line, if there is one for every NAVIGATION_WORDS words.
SEPARATORS = "|›»·•"
NAVIGATION_WORDS = 6
#: Phrases of boilerplate, as a pattern on the lower-cased line, for lines of at most BOILERPLATE_WORDS words. No letter
#: may touch them: "design in" does not hold "sign in".
BOILERPLATE = (
    r"(?:^|[^\p{L}])(?:all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|licensed under|enable javascript"
    r"|click here|sign (?:in|up)|log ?in|subscribe|share (?:this|on)|read more|skip to (?:main )?content|lorem ipsum)(?:[^\p{L}]|$)"
)
BOILERPLATE_WORDS = 30
#: Marks that end a sentence: Latin, CJK, Arabic and Urdu, Armenian, Devanagari, Ethiopic, Myanmar, Khmer, Tibetan.
SENTENCE_MARK = r"[.!?…。｡！？؟۔։।॥።፧၊။។៕།]"


def symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))


def repeated_words(tokens: Column) -> Column:
    """Words of an array of words that lie in a five-word window found twice or more in it.

    Windows are compared by 64-bit hashes. Where all differ (most texts) that is the end; else windows are sorted with
    their positions, and neighbours that are equal give the repeated positions. O(n log n) in the words of a text.
    """

    def covered(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, i: F.when(i + 1 < F.size(at), F.least(at[i + 1] - p, F.lit(WINDOW))).otherwise(WINDOW)
        )
        return F.aggregate(gaps, F.lit(0), lambda total, g: total + g)

    def repeated_positions(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda w, i: F.when(
                ((i > 0) & (ordered[F.greatest(i - 1, F.lit(0))]["h"] == w["h"]))
                | ((i + 1 < F.size(ordered)) & (ordered[F.least(i + 1, F.size(ordered) - 1)]["h"] == w["h"])),
                w["i"],
            ),
        )
        return F.sort_array(F.array_compact(marked))

    def of_hashes(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        sorted_out = let(ordered, lambda o: let(repeated_positions(o), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(sorted_out)

    def of_ids(ids: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(ids) - WINDOW), lambda i: F.xxhash64(*[ids[i + k] for k in range(WINDOW)])
        )
        return F.when(F.size(ids) < WINDOW, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of_ids).cast("bigint")


def line_fails(line: Column) -> Column:
    """Whether a line with at least one word fails a rule: punctuation, navigation, boilerplate, symbols, capitals, stutter."""

    unseparated = line
    for mark in SEPARATORS:
        unseparated = F.replace(unseparated, F.lit(mark), F.lit(""))

    def rules(here: Column) -> Column:
        n = F.size(here)
        separators = F.length(line) - F.length(unseparated)
        capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
        letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
        stutter = F.size(F.filter(here, lambda w, i: w == F.get(here, i - 1)))
        return (
            ~F.rlike(line, F.lit(SENTENCE_MARK))
            | ((separators >= 2) & (separators * NAVIGATION_WORDS >= n))
            | (symbol_count(line) > n * MOST_SYMBOLS)
            | ((n >= SHOUT_WORDS) & (capitals > letters * MOST_CAPITALS))
            | ((n >= STUTTER_WORDS) & (stutter > n * MOST_STUTTER))
            | ((n <= BOILERPLATE_WORDS) & F.rlike(F.lower(line), F.lit(BOILERPLATE)))
        )

    return let(words(line), rules)


def judge(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the base figures, the cleaned text and the verdict to every row.

    New columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long), ``base_failed``,
    ``cleaned_text`` (the lines that passed, and lines without a word between them), ``kept_share`` (characters of passed
    lines among those of lines with a word) and ``kept``. Columns of these names are replaced. A null or empty text has
    no words, fails the base rules and is not kept. Repeated rows get the same verdict each. One narrow pass, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = words(text)
    with_lines = documents.withColumns(
        {
            "_tokens": tokens,
            "_lines": F.transform(
                F.split(text, "\n"),
                lambda line: F.struct(
                    line.alias("line"), F.rlike(line, F.lit(r"[^ \t\n\x0B\f\r]")).alias("worded")
                ),
            ),
        }
    )
    judged = F.transform(
        "_lines",
        lambda x: F.struct(
            x["line"].alias("line"),
            x["worded"].alias("worded"),
            (x["worded"] & line_fails(x["line"])).alias("failed"),
        ),
    )
    worded = F.transform(F.filter("_lines", lambda x: x["worded"]), lambda x: x["line"])
    measured = with_lines.withColumns(
        {
            "_judged": judged,
            "n_words": F.size("_tokens").cast("bigint"),
            "word_chars": F.length(F.replace(spaced(text), F.lit(" "), F.lit(""))).cast("bigint"),
            "n_symbols": symbol_count(text).cast("bigint"),
            "n_dup_lines": let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint"),
            "n_repeat_words": repeated_words(F.col("_tokens")),
        }
    )

    def chars(keep):
        return F.aggregate(
            F.filter("_judged", keep), F.lit(0).cast("bigint"), lambda total, x: total + F.length(x["line"])
        )

    total = chars(lambda x: x["worded"])
    passed = chars(lambda x: x["worded"] & ~x["failed"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumns(
        {
            "base_failed": failed,
            "cleaned_text": F.array_join(
                F.transform(F.filter("_judged", lambda x: ~x["failed"]), lambda x: x["line"]), "\n"
            ),
            "kept_share": let(total, lambda t: F.when(t > 0, passed / t).otherwise(F.lit(0.0))),
        }
    ).withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= LEAST_KEPT)).drop(
        "_tokens", "_lines", "_judged"
    )


def document_quality(documents: DataFrame) -> DataFrame:
    """Figures and verdict of every document, without its text."""
    return judge(documents.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_share"
    )


def clean(documents: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents that are kept, with the lines that failed cut out of their text; columns as before.

    ``length_col``, where the table has it, becomes the code points of the new text. Columns of the names that ``judge``
    adds keep their values.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    inside = documents.select(F.struct(*documents.columns).alias("_row"), text.alias("_text"))
    judged = judge(inside, "_text")
    # A filter would be pushed below and judge every row once more; rows that are exploded from their verdict are not.
    one = F.array(F.struct(F.col("_row"), F.col("cleaned_text")))
    kept = judged.select(F.inline(F.when(F.col("kept"), one)))
    columns = []
    for name in documents.columns:
        if name == text_col:
            columns.append(F.col("cleaned_text").alias(name))
        elif name == length_col:
            kind = dict(documents.dtypes)[name]
            columns.append(F.length("cleaned_text").cast(kind).alias(name))
        else:
            columns.append(F.col("_row")[name].alias(name))
    return kept.select(*columns)
