"""Column helpers for words and lines. A word is a run of anything but space, tab, LF, VT, FF and CR."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spaced(text: Column) -> Column:
    """Text with every white-space character of a word boundary as a space; null as empty text."""
    out = F.coalesce(text, F.lit(""))
    for blank in "\t\n\u000b\f\r":
        out = F.replace(out, F.lit(blank), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """The words in order, as an array."""
    return F.array_remove(F.split(spaced(text), " "), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)
