"""Recency, frequency and monetary value of customers, and the segments built from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.dates import whole_years
from tamarind.functions.numbers import ratio_or_null
from tamarind.operators.selection import bucket_scores


def rfm_metrics(transactions: DataFrame, registered: DataFrame, report_date: dt.date) -> DataFrame:
    """Days since the last purchase, purchase days per year of membership, amount per year of membership.

    Transactions are reduced to one row per customer before they meet the register. Frequency counts years up to the
    report date, monetary value up to the day the membership stopped. A membership of no full year gives nulls.
    """
    day = F.lit(report_date)
    per_customer = (
        transactions.filter(F.col("customer_id") != 0)
        .groupBy("customer_id")
        .agg(
            F.max("purchase_date").alias("last_purchase"),
            F.count_distinct("purchase_date").alias("purchase_days"),
            F.sum("gmv").alias("amount"),
        )
    )
    years = whole_years(day, F.col("created_date"))
    paid_years = whole_years(F.coalesce("stop_date", day), F.col("created_date"))
    return per_customer.join(registered, "customer_id").select(
        "customer_id",
        F.datediff(day, "last_purchase").alias("recency"),
        ratio_or_null(F.col("purchase_days"), years).alias("frequency"),
        ratio_or_null(F.col("amount"), paid_years).alias("monetary"),
    )


def rfm_scores(metrics: DataFrame, buckets: int = 5) -> DataFrame:
    """Score 1..buckets on each axis from the rank of the customer, and the three digits as one code.

    Long absence ranks first on recency; small values and missing values rank first on the other two.
    """
    axes = ("recency", "frequency", "monetary")
    scored = bucket_scores(metrics, "customer_id", [(axis, axis == "recency") for axis in axes], buckets)
    scores = [f"{axis}_score" for axis in axes]
    return scored.select(
        "customer_id", *scores, F.concat(*[F.col(s).cast("string") for s in scores]).alias("rfm_score")
    )


def rfm_distribution(scores: DataFrame) -> DataFrame:
    """Customers per code, largest segment first. Scores hold one row per customer already."""
    return (
        scores.groupBy("rfm_score")
        .agg(F.count("customer_id").alias("total_customers"))
        .orderBy(F.desc("total_customers"), "rfm_score")
    )
