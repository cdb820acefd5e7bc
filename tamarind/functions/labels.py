"""Category labels decided by conditions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position families looked for in a job title, in this order.
POSITION_FAMILIES = ("Chuyên viên", "Cộng tác viên", "Trưởng phòng", "Giám đốc")

# Landing outcomes that count as a failure.
FAILED_LANDINGS = ("None None", "False ASDS", "False Ocean", "None ASDS", "False RTLS")


def first_contained(text: Column, families: Sequence[str] = POSITION_FAMILIES) -> Column:
    """The first listed phrase that the text contains, else null."""
    return F.coalesce(*[F.when(text.contains(phrase), F.lit(phrase)) for phrase in families])


def failure_label(value: Column, failures: Iterable[str] = FAILED_LANDINGS) -> Column:
    """0 for a listed failure, 1 for anything else, null included."""
    return F.when(value.isin(list(failures)), F.lit(0)).otherwise(F.lit(1))


def marker_color(outcome: Column) -> Column:
    """Green for success, red for the rest."""
    return F.when(outcome == 1, F.lit("green")).otherwise(F.lit("red"))


def equals_ignoring_case(text: Column, value: str) -> Column:
    """Equality that ignores case. ``value`` may hold ``%`` and ``_`` as wildcards."""
    return text.ilike(value)


def differs(value: Column, other) -> Column:
    """Inequality that keeps rows whose value is missing."""
    return ~value.eqNullSafe(F.lit(other))
