"""Workforce turnover: cleaning of contract statements and the reports on leavers and hires."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.dates import day_month_year, parse_month_first, tenure_years
from tamarind.functions.labels import POSITION_FAMILIES, differs, first_contained
from tamarind.functions.numbers import percent
from tamarind.operators.missing import drop_empty_columns, fill, require
from tamarind.operators.summary import add_share, counted_by, headcount

# Statement types of a leaver and of a hire, and the text for a missing leader.
LEAVER = "ZG - Chấm dứt HĐLĐ"
HIRE = "ZA - Tuyển mới"
NO_LEADER = "No Leader"


def clean_statements(
    raw: DataFrame,
    unused: Sequence[str] = (),
    renames: dict[str, str] | None = None,
    dates: Sequence[str] = ("statement_valid_date", "statement_expired_date", "employee_work_date"),
) -> DataFrame:
    """Empty and unused columns dropped, leader filled in, dates parsed, rows without a first working day dropped."""
    df = drop_empty_columns(raw).drop(*unused).withColumnsRenamed(renames or {"KH200": "leader_code"})
    df = fill(require(df, "employee_work_date"), leader_code=NO_LEADER)
    return df.withColumns({c: parse_month_first(F.col(c)) for c in dates if c in df.columns})


def enrich(
    statements: DataFrame, report_date: dt.date, leaver: str = LEAVER, families: Sequence[str] = POSITION_FAMILIES
) -> DataFrame:
    """Years of service, year and month of the statement, and the position family where there is a title.

    Service ends with the statement for a leaver and with the report date for everybody else.
    """
    end = F.when(F.col("statement_type") == leaver, F.col("statement_valid_date")).otherwise(F.lit(report_date))
    added = {
        "tenure": tenure_years(end, F.col("employee_work_date")),
        "valid_year": F.year("statement_valid_date"),
        "valid_month": F.month("statement_valid_date"),
    }
    if "job_title" in statements.columns:
        added["position"] = first_contained(F.col("job_title"), families)
    return statements.withColumns(added)


def kpis(statements: DataFrame, report_date: dt.date, leaver: str = LEAVER, hire: str = HIRE) -> DataFrame:
    """Headcount, leavers, leavers in percent and hires in one row, with the report date as text."""
    kind = F.col("statement_type")
    counts = headcount(statements, {"leavers": kind == leaver, "hires": kind == hire})
    return counts.select(
        day_month_year(F.lit(report_date)).alias("report_date"),
        F.col("total").alias("employees"),
        "leavers",
        percent(F.col("leavers"), F.col("total")).alias("leaver_pct"),
        "hires",
    )


def leavers(statements: DataFrame, city: str | None = None, leaver: str = LEAVER) -> DataFrame:
    """Statements of leavers, of one city if given."""
    left = statements.filter(F.col("statement_type") == leaver)
    return left if city is None else left.filter(F.col("work_location") == city)


def count_report(rows: DataFrame, keys: Sequence[str], counted: str, share: bool = False, by_key: bool = False) -> DataFrame:
    """Employees per key, optionally with their share in percent; largest first, or in key order."""
    groups = counted_by(rows, keys, counted)
    if share:
        groups = add_share(groups, "total_employees")
    return groups.orderBy(*keys) if by_key else groups.orderBy(F.desc("total_employees"), *keys)


def top_leaders(left: DataFrame, counted: str, n: int = 10) -> DataFrame:
    """The leaders with most leavers; people without a leader are left out."""
    known = left.filter(differs(F.col("leader_code"), NO_LEADER))
    return counted_by(known, ["leader_code"], counted).orderBy(F.desc("total_employees"), "leader_code").limit(n)


def hires_against_leavers(statements: DataFrame, counted: str, leaver: str = LEAVER, hire: str = HIRE) -> DataFrame:
    """Hires, leavers and their difference by month, from one pass.

    Months without a hire do not appear; a month without a leaver has a null there.
    """
    kind, present = F.col("statement_type"), F.col(counted).isNotNull()
    return (
        require(statements, "valid_month")
        .filter(kind.isin(hire, leaver))
        .groupBy("valid_month")
        .agg(
            F.count_if(kind == hire).alias("_hires"),
            F.count_if(kind == leaver).alias("_leavers"),
            F.count_if((kind == hire) & present).alias("new_employees"),
            F.count_if((kind == leaver) & present).alias("_left"),
        )
        .filter(F.col("_hires") > 0)
        .withColumn("churn_employees", F.when(F.col("_leavers") > 0, F.col("_left")))
        .select(
            "valid_month",
            "new_employees",
            "churn_employees",
            (F.col("new_employees") - F.col("churn_employees")).alias("difference"),
        )
        .orderBy("valid_month")
    )


def served(left: DataFrame) -> DataFrame:
    """Leavers whose years of service make sense."""
    return left.filter(F.col("tenure") >= 0)
