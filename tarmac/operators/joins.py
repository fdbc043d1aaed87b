"""Joins: dimensions, calendars, intervals, as-of and look-ahead.

Two rules hold throughout. Facts are aggregated to the join key before a join wherever the result allows
it, so a key with very many rows arrives as one row. A side is broadcast only below a checked size: for
plain tables the planner knows it, derived tables are stored and counted first. Beyond the bound the join
shuffles and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .windows import running_totals


def join_dimensions(events: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "inner") -> DataFrame:
    """Join each dimension table in turn on its own key columns; the planner broadcasts it if its files are small."""
    for dim, on in dims:
        events = events.join(dim, list(on), how)
    return events


def join_aggregates(base: DataFrame, parts: Sequence[DataFrame], on: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Left-join tables that are already aggregated to the key; missing counts become zero."""
    for part in parts:
        base = base.join(part, list(on), "left")
    return base.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}) if zero else base


def cross_calendar(entities: DataFrame, first: Column, last: Column, span: DataFrame, name: str = "date") -> DataFrame:
    """Every entity on every day between the first and last day of ``span``.

    The two ends are scalar subqueries and each entity row generates its own days: nothing is joined or shuffled.
    """
    ends = [span.agg(c.alias("_e")).scalar() for c in (first, last)]
    return entities.withColumn(name, F.explode(F.sequence(*ends)))


def interval_totals(
    intervals: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    day: str,
    sums: Mapping[str, Column],
    missing_as_null: Sequence[str] = (),
) -> DataFrame:
    """Totals of the facts dated inside each interval (both ends included) of the same entity.

    No interval meets a fact in a join. Facts are summed per entity and day, one running total per entity
    gives the value up to any day, and an interval is the difference at its two ends. Work is linear in facts
    plus intervals, whatever the interval length, and an entity's window holds one row per day at most.
    Intervals and running totals are looked at twice, so both are stored.

    A difference of floating totals would lose the digits that the total before the interval has taken. Daily sums of doubles run as
    decimals of 15 places, so an interval gets the sum of its own days to the last digit; days of 10^12 and more, infinite ones
    and NaN run beside them as doubles.
    """
    keys, names = list(keys), list(sums)
    intervals = materialise(intervals, "intervals")
    daily = facts.groupBy(*keys, F.col(day).alias("_d")).agg(
        *[F.coalesce(c, F.lit(0)).alias(n) for n, c in sums.items()], F.count("*").alias("_n")
    )
    split = [n for n in names if daily.schema[n].dataType.typeName() in ("double", "float")]
    usual = lambda n: F.abs(F.col(n)) < 1e12
    far = {n: f"_far_{n}" for n in split}
    daily = daily.withColumns({far[n]: F.when(usual(n), 0.0).otherwise(F.col(n)).cast("double") for n in split})
    daily = daily.withColumns({n: F.when(usual(n), F.col(n)).otherwise(F.lit(0)).cast("decimal(38,15)") for n in split})
    parts = [*names, *far.values(), "_n"]
    zero = [F.lit(0).cast(daily.schema[n].dataType).alias(n) for n in parts]
    ends = intervals.select(*keys, F.explode(F.array(start, end)).alias("_d")).distinct()
    points = daily.unionByName(ends.select(*keys, "_d", *zero)).groupBy(*keys, "_d").agg(*[F.sum(n).alias(n) for n in parts])
    upto = W.partitionBy(*keys).orderBy("_d").rowsBetween(W.unboundedPreceding, 0)
    running = materialise(
        points.select(
            *keys, "_d", F.struct(*parts).alias("own"), F.struct(*[F.sum(n).over(upto).alias(n) for n in parts]).alias("upto"),
        ),
        "running",
    )
    at_end = running.select(*keys, F.col("_d").alias(end), F.col("upto").alias("_e"))
    at_start = running.select(*keys, F.col("_d").alias(start), F.col("upto").alias("_s"), F.col("own").alias("_o"))
    joined = intervals.join(at_end, [*keys, end], "left").join(at_start, [*keys, start], "left")

    def inside(n: str, kind: str | None = None) -> Column:
        at = [F.col(f"{side}.{n}") for side in ("_e", "_s", "_o")]
        upper, lower, own = [c.cast(kind) for c in at] if kind else at
        return upper - lower + own

    # two digits less, so that the difference keeps all 15 places
    total = lambda n: inside(n, "decimal(36,15)").cast("double") + inside(far[n]) if n in far else inside(n)
    out = {n: F.when(total("_n") > 0, total(n)) if n in missing_as_null else total(n) for n in names}
    return joined.select(*[F.col(c) for c in intervals.columns], *[c.alias(n) for n, c in out.items()])


def days_since_last(rows: DataFrame, events: DataFrame, keys: Sequence[str], day: str, event_day: str, out: str, default: int = 365) -> DataFrame:
    """Days since the entity's last event strictly before the row's day; ``default`` if there is none.

    Rows and distinct event days share one ordered window per entity. An event counts from the next day on.
    """
    keys = list(keys)
    marks = events.select(*keys, F.col(event_day).alias(day)).distinct().withColumn("_mark", F.lit(True))
    both = rows.withColumn("_row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    earlier = W.partitionBy(*keys).orderBy(F.datediff(day, F.lit("1970-01-01"))).rangeBetween(W.unboundedPreceding, -1)
    last = F.max(F.when(F.col("_mark"), F.col(day))).over(earlier)
    return (
        both.withColumn(out, F.coalesce(F.datediff(F.col(day), last), F.lit(default)))
        .filter("_row")
        .drop("_mark", "_row")
    )


def event_ahead(rows: DataFrame, events: DataFrame, keys: Sequence[str], day: str, event_day: str, out: str, days: int = 7) -> DataFrame:
    """Whether an event of the entity falls in ``(day, day + days]``: each event marks the days before it."""
    keys = list(keys)
    marked = (
        events.select(*keys, F.col(event_day).alias("_e")).distinct()
        .select(*keys, F.explode(F.sequence(F.date_sub("_e", days), F.date_sub("_e", 1))).alias(day))
        .distinct()
        .withColumn(out, F.lit(True))
    )
    return rows.join(marked, [*keys, day], "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def join_either_side(usage: DataFrame, maintenance: DataFrame, alerts: DataFrame, entity: str, part: str) -> DataFrame:
    """Entities with their maintenance rows, and alerts of the same part, or all alerts of an entity without maintenance.

    An alert on a part without a maintenance row is lost when its entity has other maintenance. The residual
    ``OR`` is resolved into two equi-joins. Inputs hold one row per (entity, part).
    """
    with_work = usage.join(maintenance, entity, "inner").join(alerts, [entity, part], "left")
    idle = usage.join(maintenance.select(entity).distinct(), entity, "left_anti").join(alerts, entity, "inner")
    return with_work.unionByName(idle, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows that carry the newest timestamp of their key; every map task forwards only its own newest rows."""
    newest = W.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn("_r", F.rank().over(newest)).filter("_r = 1").drop("_r")


def rows_of_first(df: DataFrame, picks: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows of the one key that ranks first in ``picks``."""
    return df.join(F.broadcast(picks.orderBy(*order).select(key).limit(1)), key, "left_semi")


def split_before_after(
    metrics: DataFrame, changes: DataFrame, key: str, ts: str, change_ts: str, values: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Mean of metric values before and from each change of the same key on, over all (metric, change) pairs.

    Pairs are not formed: a metric row counts once per later change (before) and once per change up to it
    (after), and both counts come from one running count over the key's change and metric times.
    """
    parts = metrics.groupBy(key, F.col(ts).alias("_t"), *by).agg(
        *[F.sum(v).alias(f"_s_{v}") for v in values], *[F.count(v).alias(f"_n_{v}") for v in values], F.count("*").alias("_rows")
    )
    counted = changes.groupBy(key, F.col(change_ts).alias("_t")).agg(F.count("*").alias("_c"))
    cells = materialise(parts.unionByName(counted, allowMissingColumns=True).withColumn("_c", F.coalesce("_c", F.lit(0))), "cells")
    totals = cells.groupBy(key).agg(F.sum("_c").alias("_all")).filter("_all > 0")
    run = running_totals(cells, [key], "_t", {"_upto": F.col("_c")}).filter(F.col("_c") == 0).join(totals, key)
    before, after = F.col("_all") - F.col("_upto"), F.col("_upto")

    def mean(v: str, weight: Column) -> Column:
        n = F.sum(F.col(f"_n_{v}") * weight)
        return F.when(n > 0, F.sum(F.col(f"_s_{v}") * weight) / n)

    return run.groupBy(*by).agg(
        *[mean(v, before).alias(f"{v}_before") for v in values],
        *[mean(v, after).alias(f"{v}_after") for v in values],
        F.sum(before * F.col("_rows")).alias("pairs_before"),
        F.sum(after * F.col("_rows")).alias("pairs_after"),
    )
