"""Launch records: from nested documents and ids to a flat, labelled table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.labels import differs, failure_label
from tamarind.functions.numbers import mass_text
from tamarind.functions.text import outcome_text, strip
from tamarind.operators.rank import global_row_number
from tamarind.sources.files import flatten_structs, parse_json, unwrap_singletons
from tamarind.sources.views import LAUNCH_JSON


def from_documents(documents: DataFrame, column: str = "launch") -> DataFrame:
    """One row per JSON document with its fields as columns; arrays stay arrays."""
    return flatten_structs(parse_json(documents.select(column), column, LAUNCH_JSON).select(f"{column}.*"))


def single_core_launches(launches: DataFrame, until: dt.date) -> DataFrame:
    """Launches with one core and one payload, up to a day, with the core's fields as columns."""
    single = unwrap_singletons(launches, "cores", "payloads")
    dated = single.withColumn("launch_date", F.to_date(F.to_timestamp("date_utc")))
    return dated.filter(F.col("launch_date") <= F.lit(until))


def core_outcomes(launches: DataFrame) -> DataFrame:
    """Landing outcome of each launch as text, next to the other fields of its core."""
    core = F.col("cores")
    return launches.select(
        "flight_number",
        core["core"].alias("core_id"),
        outcome_text(core["landing_success"], core["landing_type"]).alias("outcome"),
        core["flight"].alias("flights"),
        core["gridfins"].alias("grid_fins"),
        core["reused"].alias("reused"),
        core["legs"].alias("legs"),
        core["landpad"].alias("landing_pad"),
    )


def resolve_ids(
    launches: DataFrame, rockets: DataFrame, launchpads: DataFrame, payloads: DataFrame, cores: DataFrame
) -> DataFrame:
    """Attributes of the four ids. A missing or unknown id keeps its row and gets nulls."""
    return (
        launches.join(rockets, "rocket_id", "left")
        .join(launchpads, "launchpad_id", "left")
        .join(payloads, "payload_id", "left")
        .join(cores, "core_id", "left")
    )


def renumber(launches: DataFrame, excluded_version: str, order_by: list[str], name: str = "flight_number") -> DataFrame:
    """Rows of all other versions, numbered 1..n in the given total order."""
    return global_row_number(launches.filter(differs(F.col("booster_version"), excluded_version)), order_by, name)


def label_outcomes(launches: DataFrame, failures: Iterable[str], outcome: str = "outcome", name: str = "class") -> DataFrame:
    """Add 0 for a listed failure and 1 otherwise."""
    return launches.withColumn(name, failure_label(F.col(outcome), failures))


def tidy_scraped(rows: DataFrame) -> DataFrame:
    """Scraped text to values: mass in kg, outcome without stray line ends, date."""
    return rows.withColumns(
        {
            "payload_mass": mass_text(F.col("payload_mass")),
            "launch_outcome": strip(F.col("launch_outcome")),
            "launch_date": F.try_to_date(F.col("date_text"), "d MMMM yyyy"),
        }
    ).drop("date_text")
