"""Comment cleaning, pattern extraction and small text builders."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation marks that become a blank.
MARKS = ',.;“:”"\'!?-\\)(@'

# Abbreviations of Vietnamese comments and their expansion, applied in this order.
ABBREVIATIONS = (
    ("ko", "không "),
    ("k ", "không "),
    ("ad", "admin "),
    ("[dđ]c", "được "),
    ("thúi", "thối "),
    ("chuong trinh", "chương trình "),
    ("qua", "quá "),
    ("vn", "việt nam"),
    ("roi", "rồi"),
)

# Fixed value: the object id inside a stringified document key.
OBJECT_ID_PATTERN = r"'\$oid':\s*'([^']+)'"

# (?U): white space and word characters are those of Unicode, not of ASCII.
_BLANKS = r"(?U)\s+"
# Possessive, and only at the start of a run of marks, so that a long run is read once however the text goes on.
_CLOSING_MARKS = r"(?U)(?<![?!.])[?!.]++\s*+$"
# White space of Unicode, for trimming.
_SPACES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """White space removed at both ends."""
    return F.btrim(text, F.lit(_SPACES))


def squeeze(text: Column) -> Column:
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(text, _BLANKS, " "))


def strip_closing_marks(text: Column) -> Column:
    """Remove a run of ``?``, ``!`` and ``.`` at the end of the text."""
    return F.regexp_replace(text, _CLOSING_MARKS, "")


def blank_marks(text: Column) -> Column:
    """Replace each listed mark by one blank."""
    return F.translate(text, MARKS, " " * len(MARKS))


def standardize(text: Column) -> Column:
    """Lower case, listed marks and white space squeezed to single blanks, none at the ends. Null stays null.

    Closing marks need no step of their own here: they turn into trailing blanks, which go. So one pass is enough.
    """
    return F.trim(F.regexp_replace(F.lower(text), rf"(?U)[\s{re.escape(MARKS)}]+", " "))


def expand_abbreviations(
    text: Column, rules: Sequence[tuple[str, str]] = ABBREVIATIONS, word_boundary: bool = False
) -> Column:
    """Apply replacement rules one after the other. By default they also fire inside words."""
    for pattern, replacement in rules:
        if word_boundary:
            text = F.regexp_replace(text, rf"(?U)(?<!\w){pattern.strip()}(?!\w)", replacement)
        elif re.escape(pattern).replace("\\ ", " ") == pattern:
            text = F.replace(text, F.lit(pattern), F.lit(replacement))
        else:
            text = F.regexp_replace(text, pattern, replacement)
    return text


def clean_comment(
    text: Column, rules: Sequence[tuple[str, str]] = ABBREVIATIONS, word_boundary: bool = False
) -> Column:
    """Full comment cleaner: marks first, then abbreviations, then blanks."""
    plain = blank_marks(strip_closing_marks(F.lower(text)))
    return squeeze(expand_abbreviations(plain, rules, word_boundary))


def first_capture(text: Column, pattern: str) -> Column:
    """First capture group of the first match, null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def object_id(text: Column) -> Column:
    """Hex id out of a stringified document key."""
    return first_capture(text, OBJECT_ID_PATTERN)


def spoken_flag(flag: Column) -> Column:
    """``True``, ``False`` or ``None`` as text."""
    return F.coalesce(F.initcap(flag.cast("string")), F.lit("None"))


def outcome_text(landed: Column, landing_type: Column) -> Column:
    """Flag and type in one text, with ``None`` for what is missing."""
    return F.concat_ws(" ", spoken_flag(landed), F.coalesce(landing_type, F.lit("None")))


def distance_label(name: Column, km: Column) -> Column:
    """Name followed by a distance in a ten-character field."""
    return F.format_string("%s %10.2f KM", name, km)
