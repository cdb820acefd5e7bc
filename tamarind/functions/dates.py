"""Date parsing and date arithmetic. The reporting date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.numbers import half_even

# The text that stands for "no end date" and the date that replaces it.
OPEN_END_TEXT = "12/31/9999"
OPEN_END_DATE = dt.date(2100, 12, 31)


def parse_month_first(text: Column) -> Column:
    """``M/d/yyyy`` text to date, with the open-end text mapped to a date far ahead; unparsable text gives null."""
    return F.when(text == F.lit(OPEN_END_TEXT), F.lit(OPEN_END_DATE)).otherwise(
        F.try_to_date(text, "M/d/yyyy")
    )


def parse_any(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits wins; null when none does."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def inferred_format(df: DataFrame, column: str, formats: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Format of a text column, decided by all its values: ``*by, format, fits, contradictions, ambiguous``.

    One aggregate counts for every candidate the texts it reads and those it cannot. The candidate with the fewest
    contradictions wins, ties going to the earlier one; ``ambiguous`` says that another does as well and reads the same
    texts to other days, so nothing in the column tells them apart. ``by`` names columns (a file, a source) whose values
    each have a format of their own. Nulls and blank texts count for nothing. Without any text that a candidate reads the
    format is null.
    """
    text = F.trim(F.col(column))
    text = F.when(text != "", text)
    days = [F.try_to_date(text, f) for f in formats]
    apart = [F.max((a.isNotNull() & b.isNotNull() & (a != b)).cast("int")) for a in days for b in days]
    counted = df.groupBy(*by).agg(
        F.count(text).alias("_texts"),
        F.array(*[F.count(d) for d in days]).alias("_fits"),
        F.array(*[F.coalesce(a, F.lit(0)) for a in apart]).alias("_apart"),
    )
    best = F.array_max("_fits")
    at = F.array_position("_fits", best).cast("int")
    rival = F.exists(
        F.sequence(F.lit(1), F.lit(len(formats))),
        lambda i: (F.get("_fits", i - 1) == best) & (F.get("_apart", (at - 1) * len(formats) + i - 1) == 1),
    )
    return counted.select(
        *by,
        F.when(best > 0, F.element_at(F.array(*[F.lit(f) for f in formats]), at)).alias("format"),
        best.alias("fits"),
        (F.col("_texts") - best).alias("contradictions"),
        F.when(best > 0, rival).otherwise(False).alias("ambiguous"),
    )


def parse_inferred(
    df: DataFrame, column: str, formats: Sequence[str], into: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``into``: the text as a date in the format that ``inferred_format`` finds for its column (or ``by`` group).

    A text that contradicts the format gives null, and never a day read by another format. Without ``by`` the format is a
    scalar of the plan; with it, one row for each group meets the rows, null groups included.
    """
    found = inferred_format(df, column, formats, by)
    text = F.trim(F.col(column))
    if by:
        group = found.select(F.struct(*by).alias("_by"), F.col("format").alias("_format"))
        known = df.withColumn("_key", F.struct(*by)).join(group, F.col("_key").eqNullSafe(F.col("_by")), "left")
    else:
        known = df.withColumn("_format", found.select("format").scalar())
    day = F.lit(None).cast("date")
    for f in formats:
        day = F.when(F.col("_format") == f, F.try_to_date(text, f)).otherwise(day)
    return known.withColumn(into, day).drop("_format", "_key", "_by")


def whole_years(end: Column, start: Column) -> Column:
    """Completed years between two dates on a 365.25-day year."""
    return F.floor(F.datediff(end, start) / F.lit(365.25))


def tenure_years(end: Column, start: Column) -> Column:
    """Years between two dates on a 365-day year, rounded half to even."""
    return half_even(F.datediff(end, start) / F.lit(365.0))


def month_name(day: Column) -> Column:
    """English month name."""
    return F.date_format(day, "MMMM")


def day_month_year(day: Column) -> Column:
    """``dd/MM/yyyy`` text for headlines."""
    return F.date_format(day, "dd/MM/yyyy")


def within_year(day: Column, year: int) -> Column:
    """Calendar-year test as a range on the column itself, so that it can be pushed into the scan."""
    return (day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))
