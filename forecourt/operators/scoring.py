"""Turn one-row aggregates into check rows without joins or driver-side loops."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import MONEY_TOLERANCE

NUMBER = "decimal(38,2)"


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicates(frame: DataFrame, *keys: str) -> DataFrame:
    """One row: how many key values occur more than once."""
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .agg(F.count(F.lit(1)).alias("failed_count"))
    )


def failures(frame: DataFrame, condition: Column) -> DataFrame:
    """One row: how many rows satisfy the failing condition."""
    return frame.agg(F.count_if(condition).alias("failed_count"))


def summed(*counts: DataFrame) -> DataFrame:
    return union_all(counts).agg(F.sum("failed_count").alias("failed_count"))


def pass_fail(condition: Column) -> Column:
    return F.when(condition, "PASS").otherwise("FAIL")


def scalars(**frames: DataFrame) -> DataFrame:
    """One row with a MAP(metric -> number) made of the columns of several one-row frames.

    Keys read ``<frame>.<column>``. Each frame is aggregated on its own; only the few
    resulting numbers are brought together.
    """
    entries = []
    for scope, frame in frames.items():
        pairs = F.array(*[
            F.struct(F.lit(f"{scope}.{c}").alias("k"), F.col(c).cast(NUMBER).alias("v")) for c in frame.columns
        ])
        entries.append(frame.select(F.inline(pairs)))
    return union_all(entries).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))


def reconciled(numbers: DataFrame, rules: list[tuple[str, str, str | None, str]]) -> DataFrame:
    """Rows (check_name, status, difference, details) from rules (name, metric, baseline, details).

    A rule without a baseline takes the metric itself as the difference.
    """
    def number(metric: str) -> Column:
        return F.element_at("m", F.lit(metric))

    checks = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"),
            (number(metric) if baseline is None else (number(metric) - number(baseline)).cast(NUMBER))
            .alias("difference"),
            F.lit(details).alias("details"),
        )
        for name, metric, baseline, details in rules
    ])
    within = F.abs("difference") <= F.lit(MONEY_TOLERANCE).cast("decimal(3,2)")
    return numbers.select(F.inline(checks)).select(
        "check_name", pass_fail(within).alias("status"), "difference", "details"
    )


class CheckFailure(ValueError):
    """A gate found no rows or at least one row that is not PASS."""


def require_all_pass(checks: DataFrame, suite: str) -> int:
    """Gate: raise on an empty result or on any non-PASS row; return the number of rows."""
    counts = checks.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_list(F.when(~F.col("status").eqNullSafe("PASS"), F.col("check_name"))).alias("bad"),
    ).first()
    if not counts["n"]:
        raise CheckFailure(f"{suite}: no check results")
    if counts["bad"]:
        raise CheckFailure(f"{suite}: failed checks: {', '.join(sorted(counts['bad']))}")
    return counts["n"]
