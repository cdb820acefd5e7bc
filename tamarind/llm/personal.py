"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Positions come from two passes of one pattern: the pieces between the matches and the matches themselves alternate, so
their lengths add up to the places. All in code points from 0, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.vectors import running_sums
from tamarind.llm.texts import let

_LOCAL = r"A-Za-z0-9._%+\-"
#: A part of an address of at most 255, leading zeros allowed.
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Code points before and after a span in which context words count.
NEARBY = 40
#: No pattern matches fewer than four code points, so that many matches on one side fill the reach.
NEIGHBOURS = NEARBY // 4
#: Score from which a proposed span counts.
LEAST_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``guard`` is a cheap test of the whole text; ``base`` spans count whatever the score."""

    name: str
    pattern: str
    guard: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def total(backwards: Column) -> Column:
        def add(sum_so_far: Column, i: Column) -> Column:
            d = F.substring(backwards, i, F.lit(1)).cast("int")
            return sum_so_far + F.when(i % 2 == 1, d).when(d >= 5, d * 2 - 9).otherwise(d * 2)

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0

    return let(F.reverse(number), total)


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes the mod-97 check."""

    def rest(turned: Column) -> Column:
        def add(r: Column, i: Column) -> Column:
            d = F.call_function(
                "locate", F.substring(turned, i, F.lit(1)), F.lit(_ALPHABET)
            ) - 1
            return (r * F.when(d < 10, 10).otherwise(100) + d) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1

    return let(
        F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)), rest
    )


def _long(least: int, most: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(digits(hit)).between(least, most)


def _has_digit(text: Column) -> Column:
    return F.rlike(text, F.lit("[0-9]"))


# Each base pattern finds the same spans as the plain form beside it. The look-behind starts a match only where a run of
# its first class starts or where the match before ended, and possessive loops never go back, so that long runs cost
# linear time and no stack.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda hit: F.lit(True),
        0.9,
        r"mail|contact|write|kontakt|correo|courriel",
        True,
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _has_digit,
        lambda hit: F.rlike(hit, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        0.6,
        r"\bip\b|address|server|host",
        True,
    ),
    # [0-9]([\x20-]?[0-9])+, 16 to 19 digits passing Luhn; chains of fewer than 16 digits would be dropped anyway
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9]){15,}+",
        _has_digit,
        lambda hit: _long(16, 19)(hit) & luhn(digits(hit)),
        0.8,
        r"card|visa|master|credit|karte|carte|tarjeta",
        True,
    ),
    # \+[0-9][\x20().0-9-]+[0-9], 8 to 15 digits
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        _long(8, 15),
        0.6,
        r"phone|tel|call|fax|mobil|anruf|llam|appel",
        True,
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        _has_digit,
        lambda hit: let(
            F.replace(hit, F.lit(" "), F.lit("")), lambda a: F.length(a).between(15, 34) & mod97(a)
        ),
        0.8,
        r"iban|account|bank|konto|compte|cuenta",
    ),
    # Without a checksum of its own, this one needs a word nearby to count.
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        _has_digit,
        lambda hit: ~F.rlike(hit, F.lit(r"^(?:000|666|9)|-00-|-0000$")),
        0.3,
        r"\bssn\b|social security|tax id",
    ),
)
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def find(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, as an array of ``struct<kind, start, end, score>``."""

    def placed(pieces: Column, hits: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(hits) - 1)
        ends = running_sums(F.transform(every, lambda i: F.length(pieces[i]) + F.length(hits[i])))
        return F.zip_with(
            hits,
            F.transform(ends, lambda end, i: F.struct(end.alias("end"), i.alias("i"))),
            lambda hit, x: F.struct(
                (x["end"] - F.length(hit)).alias("start"), x["end"].alias("end"), hit.alias("hit"), x["i"].alias("i")
            ),
        )

    def scored(parts: Column, s: Column) -> Column:
        # What lies within reach is put together from the pieces and hits next to the span, each cut to that reach.
        i, last = s["i"], F.size(parts) - 1
        before = F.array_join(
            F.transform(
                F.sequence(F.greatest(i - NEIGHBOURS, F.lit(0)), i),
                lambda j: F.when(j < i, F.concat(parts[j]["tail"], parts[j]["hit_tail"])).otherwise(parts[j]["tail"]),
            ),
            "",
        )
        after = F.array_join(
            F.transform(
                F.sequence(i + 1, F.least(i + 1 + NEIGHBOURS, last)),
                lambda j: F.concat(parts[j]["head"], parts[j]["hit_head"]),
            ),
            "",
        )
        around = F.concat(F.right(before, F.lit(NEARBY)), F.lit(" "), F.left(after, F.lit(NEARBY)))
        near = F.rlike(F.lower(around), F.lit(kind.context))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.least(F.lit(kind.score) + F.when(near, 0.3).otherwise(0.0), F.lit(1.0)).alias("score"),
        )

    def cut(pieces: Column, hits: Column) -> Column:
        """Each piece and the hit after it (the last piece has none), by their ends."""
        near = F.lit(NEARBY)

        def ends(piece: Column, i: Column) -> Column:
            hit = F.coalesce(F.get(hits, i), F.lit(""))
            return F.struct(
                F.left(piece, near).alias("head"), F.right(piece, near).alias("tail"),
                F.left(hit, near).alias("hit_head"), F.right(hit, near).alias("hit_tail"),
            )

        return F.transform(pieces, ends)

    def of_pieces(pieces: Column, hits: Column) -> Column:
        valid = F.filter(placed(pieces, hits), lambda s: kind.valid(s["hit"]))
        return let(
            valid,
            lambda spans: F.when(
                F.size(spans) > 0, let(cut(pieces, hits), lambda parts: F.transform(spans, lambda s: scored(parts, s)))
            ).otherwise(F.array().cast(_SPAN)),
        )

    def of_hits(hits: Column) -> Column:
        out = let(F.split(text, kind.pattern, -1), lambda pieces: of_pieces(pieces, hits))
        if not kind.base:
            out = F.filter(out, lambda s: s["score"] >= LEAST_SCORE)
        return F.when(F.size(hits) > 0, out.cast(_SPAN))

    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.coalesce(F.when(kind.guard(text), let(hits, of_hits)), F.array().cast(_SPAN))


def find_personal(documents: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``personal``: all confirmed spans of a text, by kind as listed and then by start.

    Null and empty texts have none. Repeated rows get the same spans each. A column named ``personal`` is replaced. One
    narrow pass, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.withColumn("personal", F.concat(*[find(text, kind) for kind in kinds]))


def _of_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def document_personal(documents: DataFrame) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = find_personal(documents.select("doc_id", "text")).select("doc_id", "personal")
    names = [k.name for k in KINDS if k.base]

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat(
                    s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    return found.select(
        "doc_id",
        *[
            F.size(F.filter("personal", _of_kind(name))).cast("bigint").alias(f"n_{name}") for name in names
        ],
        F.sha2(written(F.filter("personal", lambda s: s["kind"].isin(names))), 256).alias("base_sha256"),
        written(F.col("personal")).alias("spans"),
        F.aggregate("personal", F.lit(0.0), lambda best, s: F.greatest(best, s["score"])).alias("top_score"),
    )
