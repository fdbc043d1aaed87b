"""Registration of queries and the shape of their results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Fleet, with_views


@dataclass(frozen=True)
class Entry:
    build: Callable[[Fleet], DataFrame]
    sql: str | None
    exact: bool = False


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None, exact: bool = False):
    """Register a builder under its key; ``sql`` names views that are prefixed as needed.

    ``exact`` results hold stored values or single operations on them and are not rounded.
    """

    def add(build: Callable[[Fleet], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(build, with_views(sql, extra) if sql else None, exact)
        return build

    return add


# Added before rounding, so that a tie reached through another order of summation rounds alike.
TIE = 1e-9


def present(df: DataFrame, exact: bool = False) -> DataFrame:
    """Comparable values: doubles to six places, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("double", "float", "decimal"):
            c = c.cast("double") if exact else F.round(c.cast("double") + TIE, 6)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: present(entry.build(Fleet(spark, folder)), entry.exact)


def R(expr: str) -> str:
    """Rounded double in SQL."""
    return f"ROUND(CAST({expr} AS DOUBLE) + 1e-9, 6)"


def RA(expr: str, name: str) -> str:
    return f"{R(expr)} AS {name}"


def S(expr: str, name: str | None = None) -> str:
    """Text form of a date or timestamp in SQL."""
    return f"CAST({expr} AS VARCHAR)" + (f" AS {name}" if name else "")
