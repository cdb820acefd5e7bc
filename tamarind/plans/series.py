"""Price and revenue series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.dates import parse_any
from tamarind.functions.numbers import money_text

# Last days shown by default, and date formats found on revenue pages.
PRICE_UNTIL = dt.date(2021, 6, 14)
REVENUE_UNTIL = dt.date(2021, 4, 30)
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "d MMMM yyyy")


def clean_revenue(rows: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Amounts as numbers and dates as dates; rows without an amount are dropped."""
    return (
        rows.withColumns({"d": parse_any(F.col("date_text"), formats), "revenue": money_text(F.col("revenue_text"))})
        .filter(F.col("revenue").isNotNull())
        .drop("date_text", "revenue_text")
    )


def last_rows(rows: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The n last rows in the given order."""
    return rows.orderBy(*[F.col(c).desc_nulls_last() for c in order_by]).limit(n)


def price_and_revenue(
    prices: DataFrame,
    revenue: DataFrame,
    price_until: dt.date = PRICE_UNTIL,
    revenue_until: dt.date = REVENUE_UNTIL,
) -> DataFrame:
    """Both series on one date axis as ``series, d, value``, each up to its own last day."""
    shown_prices = prices.filter(F.col("d") <= F.lit(price_until)).select(
        F.lit("share_price").alias("series"), "d", F.col("close").cast("double").alias("value")
    )
    shown_revenue = revenue.filter(F.col("d") <= F.lit(revenue_until)).select(
        F.lit("revenue").alias("series"), "d", F.col("revenue").cast("double").alias("value")
    )
    return shown_prices.unionByName(shown_revenue)
