"""Rounding, ratios and numbers hidden in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the binary value (scale, round to integer, scale back), as array libraries do."""
    # Adding zero turns a negative zero into a plain one.
    if digits == 0:
        return F.rint(value) + F.lit(0.0)
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``; null when ``whole`` is zero."""
    return half_even(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), digits)


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Quotient of two numbers in double precision, null on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def money_text(text: Column) -> Column:
    """``$1,234`` to 1234.0; text without a number gives null."""
    return F.regexp_replace(text, "[$,\\s]", "").try_cast("double")


def percent_text(text: Column) -> Column:
    """``20.10%`` to 0.201."""
    return F.regexp_replace(text, "[%\\s]", "").try_cast("double") / F.lit(100.0)


def mass_text(text: Column) -> Column:
    """``~4,000 kg`` to 4000.0; a range gives its lower bound; text that does not state a mass gives null."""
    digits = F.regexp_extract(text, r"^\s*~?\s*([0-9][0-9,]*(?:\.[0-9]+)?)", 1)
    return F.regexp_replace(digits, ",", "").try_cast("double")
