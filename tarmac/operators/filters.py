"""Row selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_samples(df: DataFrame, features: Sequence[str], positive: Sequence[str] = ()) -> DataFrame:
    """Drop samples with a missing feature or a non-positive reading where it must be positive."""
    kept = df.na.drop(subset=list(features))
    return kept.filter(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in positive])) if positive else kept


def optional(df: DataFrame, equal: Mapping[str, object] | None = None, at_least: Mapping[str, object] | None = None,
             at_most: Mapping[str, object] | None = None, contains: Mapping[str, object] | None = None) -> DataFrame:
    """Conjunction of the supplied conditions; a parameter that is None is left out."""
    tests: list[Column] = []
    tests += [F.col(c) == F.lit(v) for c, v in (equal or {}).items() if v is not None]
    tests += [F.col(c) >= F.lit(v) for c, v in (at_least or {}).items() if v is not None]
    tests += [F.col(c) <= F.lit(v) for c, v in (at_most or {}).items() if v is not None]
    tests += [F.array_contains(c, v) for c, v in (contains or {}).items() if v is not None]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def differs_or_null(c: str, value: object) -> Column:
    """True when the column is another value or NULL."""
    return (F.col(c) != F.lit(value)) | F.col(c).isNull()


def with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in a key table."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")
