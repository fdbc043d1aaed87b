"""Ratios, threshold ladders and null guards."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with a costly value computed once per row, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def safe_ratio(num: Column | str, den: Column | str, guard: str = "null") -> Column:
    """``num / den`` under one of three guards.

    ``null``: NULL when the denominator is not positive; ``zero``: 0 instead; ``floor``: divide by ``max(1, den)``.
    """
    num, den = col(num), col(den)
    if guard == "null":
        return F.when(den > 0, num / den)
    if guard == "zero":
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))
    if guard == "floor":
        return num / F.greatest(F.lit(1.0), den)
    raise ValueError(f"unknown guard {guard!r}")


def ladder(value: Column | str, steps: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """First step whose bound the value strictly exceeds, in the given order."""
    value = col(value)
    out = None
    for bound, label in steps:
        cond = value > F.lit(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace the missing side of a left join by zero."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def pct_change(new: Column, old: Column) -> Column:
    """Relative change in percent; NULL when the old value is zero."""
    return F.when(old != 0, (new - old) / old * 100)


def tail_label(prefix: Column | str, ident: Column | str, length: int = 6) -> Column:
    """``prefix - <last characters of ident>``."""
    ident = col(ident).cast("string")
    start = F.greatest(F.length(ident) - F.lit(length - 1), F.lit(1))
    return F.concat(col(prefix), F.lit(" - "), F.substring(ident, start, F.lit(length)))


def count_where(cond: Column) -> Column:
    """Rows for which the condition is true."""
    return F.count_if(cond)


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))
