"""Questions asked of a launch table: filters, totals, rankings, rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.dates import month_name, within_year
from tamarind.functions.labels import equals_ignoring_case
from tamarind.operators.summary import add_share


def with_date(launches: DataFrame) -> DataFrame:
    """Copy without rows that lack a date."""
    return launches.filter(F.col("launch_date").isNotNull())


def distinct_sites(launches: DataFrame) -> DataFrame:
    return launches.select("launch_site").distinct()


def site_prefix(launches: DataFrame, prefix: str, n: int, order_by: list[str]) -> DataFrame:
    """First n rows whose site starts with a prefix, upper or lower case."""
    return launches.filter(F.col("launch_site").ilike(f"{prefix}%")).orderBy(*order_by).limit(n)


def total_payload(launches: DataFrame, where: Column) -> DataFrame:
    return launches.filter(where).agg(F.sum("payload_mass").alias("total_payload_kg"))


def average_payload(launches: DataFrame, version: str) -> DataFrame:
    """Mean payload of a version, whatever its case."""
    return launches.filter(equals_ignoring_case(F.col("booster_version"), version)).agg(
        F.avg("payload_mass").alias("avg_payload_kg")
    )


def first_date(launches: DataFrame, outcome: str) -> DataFrame:
    """Earliest date of an outcome, whatever its case."""
    return launches.filter(equals_ignoring_case(F.col("outcome"), outcome)).agg(F.min("launch_date").alias("first_date"))


def boosters_in_range(launches: DataFrame, outcome: str, low: float, high: float) -> DataFrame:
    """Versions of launches with an outcome and a payload in [low, high], one row per launch."""
    return launches.filter((F.col("outcome") == outcome) & F.col("payload_mass").between(low, high)).select("booster_version")


def outcome_counts(launches: DataFrame) -> DataFrame:
    """Launches per outcome; a missing outcome is a group of its own."""
    return launches.groupBy("outcome").agg(F.count(F.lit(1)).alias("total_count"))


def heaviest(launches: DataFrame) -> DataFrame:
    """Versions that carried the largest payload, one row per launch."""
    largest = launches.select(F.max("payload_mass")).scalar()
    return launches.filter(F.col("payload_mass") == largest).select("booster_version")


def failures_by_month(launches: DataFrame, outcome: str, year: int) -> DataFrame:
    """Launches of one year with an outcome, with the name of the month."""
    return launches.filter(within_year(F.col("launch_date"), year) & (F.col("outcome") == outcome)).select(
        month_name(F.col("launch_date")).alias("month_name"), "booster_version", "launch_site"
    )


def outcome_rank(launches: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Outcomes of a period by number of launches."""
    return (
        launches.filter(F.col("launch_date").between(F.lit(start), F.lit(end)))
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("launches"))
        .orderBy(F.desc("launches"), "outcome")
    )


def success_rate_by(launches: DataFrame, key: Column | str, name: str) -> DataFrame:
    """Mean class per key in key order; rows without a key are left out."""
    key = F.col(key) if isinstance(key, str) else key
    return launches.filter(key.isNotNull()).groupBy(key.alias(name)).agg(F.avg("class").alias("success_rate")).orderBy(name)


def success_rate(launches: DataFrame) -> DataFrame:
    return launches.agg(F.avg("class").alias("success_rate"))


def scatter_bins(launches: DataFrame, x: str, width: float, y: str) -> DataFrame:
    """Points of a scatter plot counted per bin, category and class, so that the frame stays small at any scale."""
    return (
        launches.filter(F.col(x).isNotNull())
        .groupBy((F.floor(F.col(x) / width) * width).cast("double").alias(f"{x}_from"), y, "class")
        .agg(F.count(F.lit(1)).alias("points"))
    )


# --- dashboard ----------------------------------------------------------------------------------------------------
ALL_SITES = "ALL"


def payload_bounds(launches: DataFrame) -> DataFrame:
    """Ends of the payload slider."""
    return launches.agg(F.min("payload_mass").alias("min_payload"), F.max("payload_mass").alias("max_payload"))


def successes_by_site(launches: DataFrame) -> DataFrame:
    """Sum of class per site and its share of all successes: the slices of the pie over all sites."""
    return add_share(launches.groupBy("launch_site").agg(F.sum("class").alias("successes")), "successes")


def site_outcomes(launches: DataFrame, site: str) -> DataFrame:
    """Launches of one site by class."""
    return (
        launches.filter(F.col("launch_site") == site)
        .groupBy("launch_site", "class")
        .agg(F.count(F.lit(1)).alias("class_count"))
    )


def success_pie(launches: DataFrame, site: str = ALL_SITES) -> DataFrame:
    """What the pie shows for the chosen entry of the site selector."""
    return successes_by_site(launches) if site == ALL_SITES else site_outcomes(launches, site)


def payload_scatter(launches: DataFrame, low: float, high: float, site: str = ALL_SITES) -> DataFrame:
    """Launches in a payload range, of one site or of all."""
    rows = launches.filter(F.col("payload_mass").between(low, high))
    rows = rows if site == ALL_SITES else rows.filter(F.col("launch_site") == site)
    return rows.select("launch_site", "payload_mass", "class", "booster_version")
