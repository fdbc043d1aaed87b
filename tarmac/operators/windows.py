"""Ordered computations that stay bounded for a hot key.

A key's rows are first reduced to one row per day (or slice); only that summary is ever ordered in one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import whole_days
from ..session import materialise
from .sizing import sized_join


def running_totals(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, Column], slice_unit: str = "day") -> DataFrame:
    """Running sums per key in time order, ties included, over rows that may all share one key.

    The order is taken inside time slices; slice totals, one row each, carry the sum from slice to slice. The
    input is read twice: store it first if it is costly.
    """
    keys, names = list(keys), list(sums)
    cut = df.withColumns({n: c for n, c in sums.items()}).withColumn("_slice", F.date_trunc(slice_unit, ts))
    inside = W.partitionBy(*keys, "_slice").orderBy(ts).rangeBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = cut.groupBy(*keys, "_slice").agg(*[F.sum(n).alias(n) for n in names]).select(
        *keys, "_slice", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_c_{n}") for n in names]
    )
    inner = cut.withColumns({n: F.sum(n).over(inside) for n in names})
    return (
        inner.join(carried, [*keys, "_slice"])
        .withColumns({n: F.col(n) + F.col(f"_c_{n}") for n in names})
        .drop("_slice", *[f"_c_{n}" for n in names])
    )


def day_intervals(events: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Intervals between consecutive distinct event days of an entity: start, end, length in days."""
    days = events.select(*keys, F.to_date(ts).alias("end_date")).distinct()
    order = W.partitionBy(*keys).orderBy("end_date")
    return (
        days.withColumn("start_date", F.lag("end_date").over(order))
        .filter(F.col("start_date").isNotNull())
        .select(*keys, "start_date", "end_date", F.datediff("end_date", "start_date").alias("interval_days"))
    )


def event_intervals(events: DataFrame, keys: Sequence[str], ts: str, carry: Sequence[str]) -> DataFrame:
    """Intervals of at least one whole day between consecutive events, with attributes of the later event.

    A gap of a day can only lead to the first event of a calendar day, from the last event of an earlier
    day. So each day is reduced to both before any ordering. Of events at the same instant the smallest by
    ``carry`` comes first.
    """
    keys = list(keys)
    days = events.groupBy(*keys, F.to_date(ts).alias("_day")).agg(
        F.min(F.struct(F.col(ts).alias("end_date"), *carry)).alias("_first"), F.max(ts).alias("_last")
    )
    order = W.partitionBy(*keys).orderBy("_day")
    return (
        days.select(*keys, "_first.*", F.lag("_last").over(order).alias("start_date"))
        .withColumn("interval_days", whole_days(F.col("start_date"), F.col("end_date")))
        .filter("interval_days > 0")
        .select(*keys, *carry, "start_date", "end_date", "interval_days")
    )


def fill_gaps(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Last known value, else the next known one, else zero, within the entity; for tables of one row per entity and day."""
    ordered = W.partitionBy(*keys).orderBy(order)
    # a row with nothing known up to it takes the first known value of the entity: no second order is needed
    back, whole = ordered.rowsBetween(W.unboundedPreceding, 0), ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(whole), F.lit(0.0)) for c in columns}
    )


def sums_before(df: DataFrame, groups: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds ``before_<value>``: the sum over the rows of the group that come earlier; a group may hold all rows.

    Rows are dealt by ranges of the order and stored; sums inside a range meet the sums of the ranges before, a table of one row a range and group.
    ``order`` tells the rows of a group apart.
    """
    groups = list(groups)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = materialise(df.repartitionByRange(parts, *groups, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = W.partitionBy(*groups).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored.groupBy(*groups, "_range").agg(*[F.sum(v).alias(v) for v in values]).select(
        *groups, "_range", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values]
    )
    inside = W.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = stored.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(offsets, [*groups, "_range"])
    return summed.withColumns({f"before_{v}": F.col(f"before_{v}") + F.col(f"_o_{v}") for v in values}).drop("_range", *[f"_o_{v}" for v in values])


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``; map tasks forward at most ``k`` rows per group."""
    w = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def group_quantile(df: DataFrame, keys: Sequence[str], value: str, q: str, out: str = "threshold", accuracy: int = 1000) -> DataFrame:
    """Exact quantile per group: the smallest value with at least a share ``q`` of the rows at or below it.

    A sketch brackets the answer; rows below the bracket are only counted. The rows inside it, a small
    share, are collapsed by value and ranked in sub-ranges of the bracket, so no task holds a whole group.
    """
    keys = list(keys)
    share, eps = Decimal(q), 2.0 / accuracy
    low, high = max(0.0, float(share) - eps), min(1.0, float(share) + eps)
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    rank = F.ceil(F.lit(share) * F.col("_n").cast("decimal(20,0)")).cast("bigint")
    # percentile_approx is off by at most 1/accuracy in rank, so the bracket holds the answer; the slack
    # covers long integers, which the sketch keeps as doubles
    b = F.col("_b").cast("array<double>")
    ends = [(b[0] - F.abs(b[0]) * 1e-12).alias("_lo"), (b[1] + F.abs(b[1]) * 1e-12).alias("_hi")]
    bracket = (
        known.groupBy(*keys)
        .agg(F.percentile_approx("_v", F.array(F.lit(low), F.lit(high)), F.lit(accuracy)).alias("_b"), F.count("*").alias("_n"))
        .select(*keys, *ends, F.greatest(rank, F.lit(1)).alias("_rank"))
    )
    near = sized_join(known, bracket, keys, "inner")
    width = (F.col("_hi") - F.col("_lo")) / 64
    sub = F.when(F.col("_v") < F.col("_lo"), F.lit(-1)).when(width > 0, F.floor((F.col("_v") - F.col("_lo")) / width)).otherwise(F.lit(0))
    cells = materialise(
        near.filter(F.col("_v") <= F.col("_hi"))
        .withColumn("_sub", sub.cast("bigint"))
        # below the bracket one cell per group is enough
        .withColumn("_v", F.when(F.col("_sub") >= 0, F.col("_v")))
        .groupBy(*keys, "_sub", "_v", "_rank")
        .agg(F.count("*").alias("_c")),
        "cells",
    )
    subs = cells.groupBy(*keys, "_sub", "_rank").agg(F.sum("_c").alias("_c"))
    upto = W.partitionBy(*keys).orderBy("_sub").rowsBetween(W.unboundedPreceding, 0)
    hit = (
        subs.withColumn("_end", F.sum("_c").over(upto))
        .filter((F.col("_end") >= F.col("_rank")) & (F.col("_end") - F.col("_c") < F.col("_rank")))
        .select(*keys, "_sub", (F.col("_end") - F.col("_c")).alias("_before"))
    )
    inside = W.partitionBy(*keys).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    return (
        cells.join(hit, [*keys, "_sub"])
        .withColumn("_end", F.col("_before") + F.sum("_c").over(inside))
        .filter(F.col("_end") >= F.col("_rank"))
        .groupBy(*keys)
        .agg(F.min("_v").alias(out))
    )
