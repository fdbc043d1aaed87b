"""Joins with tables derived from the facts themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

BROADCAST_ROWS = 200_000
# compressed, as stored; a broadcast table takes a few times as much in memory
BROADCAST_BYTES = 16 << 20


def stored_bytes(stored: DataFrame) -> int:
    """Size of a stored table, as the planner knows it from its files."""
    return int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table is within both bounds of a broadcast."""
    return stored_bytes(stored) <= BROADCAST_BYTES and stored.limit(max_rows + 1).count() <= max_rows


def sized_join(facts: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", max_rows: int = BROADCAST_ROWS,
               stored: bool = False) -> DataFrame:
    """Join facts with a table derived from them (statistics, sizes, limits), which may or may not be small.

    The derived side is stored, so it is computed once, and its bytes and rows are checked. Within both bounds it is broadcast
    and the facts stay where they are; above, both are shuffled and a hot key is split by its size. ``stored`` says that
    the side already is a stored table.
    """
    side = side if stored else materialise(side, "side")
    return facts.join(F.broadcast(side) if is_small(side, max_rows) else side, list(on), how)
