"""Registry of named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gable.catalog.reference_sql import with_ctes

Build = Callable[[SparkSession, str], DataFrame]

#: Digits kept of sums and averages of doubles, whose last bits depend on the
#: order of addition. A nudge far below the last digit moves exact ties off the
#: rounding boundary, where those last bits would decide.
DIGITS = 4


def _nudge(digits: int) -> float:
    return 10.0 ** -(digits + 3)


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def register(name: str, build: Build, sql: str | None, rounded: Sequence[str] = (), digits: int = DIGITS) -> None:
    """Add a query. ``rounded`` columns are rounded on both sides."""
    if name in ENTRIES:
        raise ValueError(f"query {name} is registered twice")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(spark, folder).withColumns({c: F.round(F.col(c) + _nudge(digits), digits) for c in rounded})

    if sql is not None:
        if rounded:
            swaps = ", ".join(f"round({c} + {_nudge(digits)!r}, {digits}) AS {c}" for c in rounded)
            sql = f"SELECT * REPLACE ({swaps}) FROM (\n{sql.strip()}\n)"
        sql = with_ctes(sql.strip())
    ENTRIES[name] = Entry(run, sql)


def query(name: str, sql: str | None, rounded: Sequence[str] = (), digits: int = DIGITS) -> Callable[[Build], Build]:
    """Decorator form of :func:`register`."""

    def add(build: Build) -> Build:
        register(name, build, sql, rounded, digits)
        return build

    return add
