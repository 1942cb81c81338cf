"""Which keys of a table another table does not hold, found without moving the table's rows.

All key columns of a table are read in one scan and reduced to their distinct values before the
shuffle; those meet the distinct keys of the tables that they refer to. What is left over, usually
nothing, is written to the shared folder. Rows then meet that list only: nothing is joined for a
column without dangling keys, and for the others Spark knows the size of the list from its files
and sends it to the rows when it is small.

Keys are sent as values, not as bitmaps: a task that sees a million of a billion keys in random
order would fill nearly every bucket of a bitmap, 4 kB each, for 8 bytes a key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

Stage = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Link:
    """A key column, the frame and column that must hold its keys, and a column that must agree with it there."""

    column: str
    held: DataFrame
    key: str
    within: str | None = None
    of: str | None = None


def _value(frame: DataFrame, name: str | None, kind: str) -> Column:
    """A key as text or as a number; days count from 1970."""
    if name is None:
        return F.lit(0).cast(kind)
    return (F.unix_date(name) if frame.schema[name].dataType == DateType() else F.col(name)).cast(kind)


def _kind(frame: DataFrame, links: list[Link]) -> str:
    return "string" if any(frame.schema[k.column].dataType == StringType() for k in links) else "bigint"


def _one_scan(frame: DataFrame, links: list[Link], kind: str) -> DataFrame:
    """(link, key, within) of every key that is not NULL."""
    return frame.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("link"), _value(frame, k.column, kind).alias("key"), _value(frame, k.within, kind).alias("within"))
        for i, k in enumerate(links)]))).where("key is not null")


def _held(links: list[Link], kind: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        k.held.select(F.lit(i).alias("link"), _value(k.held, k.key, kind).alias("key"), _value(k.held, k.of, kind).alias("within"))
        for i, k in enumerate(links)]).distinct()


def dangling(frame: DataFrame, links: list[Link]) -> DataFrame:
    """(link, key, within, n): keys that are not held, and how many rows have them; ``link`` counts from 0.

    A key with a ``within`` column dangles unless it is held with the same value there; NULL
    there is no value. NULL keys are left out.
    """
    kind = _kind(frame, links)
    used = _one_scan(frame, links, kind).groupBy("link", "key", "within").agg(F.count("*").alias("n"))
    return used.join(_held(links, kind), ["link", "key", "within"], "left_anti")


class Dangling:
    """The dangling keys of a frame, written once."""

    def __init__(self, frame: DataFrame, links: list[Link], stage: Stage, name: str):
        self.links, self.kind = links, _kind(frame, links)
        self.found = stage(f"{name}_dangling", dangling(frame, links))
        # One row per link at most.
        self.bad = sorted(r.link for r in self.found.select("link").distinct().collect())

    def _met(self, rows: DataFrame, i: int, how: str) -> DataFrame:
        """The rows joined with the dangling keys of a link, as ``_bad<i>_key``."""
        k, mark = self.links[i], f"_bad{i}_"
        keys = self.found.where(F.col("link") == i).select(F.col("key").alias(f"{mark}key"), F.col("within").alias(f"{mark}within"))
        same = _value(rows, k.column, self.kind) == F.col(f"{mark}key")
        if k.within:
            same = same & _value(rows, k.within, self.kind).eqNullSafe(F.col(f"{mark}within"))
        return rows.join(keys, same, how)

    def resolved(self, rows: DataFrame) -> DataFrame:
        """The rows whose keys are all held; rows with a NULL key are left out."""
        for k in self.links:
            rows = rows.where(F.col(k.column).isNotNull())
        for i in self.bad:
            rows = self._met(rows, i, "left_anti")
        return rows

    def marked(self, rows: DataFrame) -> tuple[DataFrame, list[Column]]:
        """The rows with more columns, and for each link the condition that its key is NULL or not held."""
        wrong = []
        for i, k in enumerate(self.links):
            none = F.col(k.column).isNull()
            if i in self.bad:
                rows = self._met(rows, i, "left")
                none = none | F.col(f"_bad{i}_key").isNotNull()
            wrong.append(none)
        return rows, wrong

    def unresolved(self, rows: DataFrame) -> DataFrame:
        """One row: how many rows have a NULL key or one that is not held, each counted once."""
        rows, wrong = self.marked(rows)
        return rows.agg(F.count_if(reduce(Column.__or__, wrong)).alias("failed_count"))
