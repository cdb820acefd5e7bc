"""Small-vector expressions on array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(logits: Column) -> Column:
    """Exponentials divided by their sum, shifted by the maximum so that large logits stay finite."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(shifted, lambda e: e / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def argmax(values: Column) -> Column:
    """Zero-based position of the largest entry; the first one wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Values of an array that are summed in one fold; longer arrays are cut into such runs, so that cost stays linear.
RUN = 256


def running_sums(steps: Column) -> Column:
    """Running sums of an array of integers, in time linear in its length up to some hundred thousand values."""

    def sums(run: Column, base: Column) -> Column:
        folded = F.aggregate(
            run,
            F.struct(base.alias("sum"), F.array().cast("array<int>").alias("out")),
            lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["out"], a["sum"] + x).alias("out")),
        )
        return folded["out"]

    def total(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda a, x: a + x)

    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")),
        lambda b: F.slice(steps, b * RUN + 1, F.lit(RUN)),
    )
    based = once(
        runs,
        lambda rs: once(
            F.transform(rs, total),
            lambda totals: F.flatten(F.transform(rs, lambda run, b: sums(run, total(F.slice(totals, F.lit(1), b))))),
        ),
    )
    return F.when(F.size(steps) > 0, based).otherwise(F.array().cast("array<int>"))
