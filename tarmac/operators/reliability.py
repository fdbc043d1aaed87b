"""Failure counts, mean time between failures and failure rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import as_date, lookback
from ..functions.numeric import count_where, safe_ratio
from .joins import join_aggregates, join_either_side
from .windows import top_k

PERIODS = (7, 30, 90)

def failure_condition(kind: str) -> Column:
    """Four meanings of "failure", by name: type FAILURE, any unscheduled event, unscheduled FAILURE, or type REPAIR."""
    kind_is = lambda v: F.col("event_type") == v
    return {
        "failure_type": lambda: kind_is("FAILURE"),
        "unscheduled": lambda: ~F.col("is_scheduled"),
        "unscheduled_failure": lambda: kind_is("FAILURE") & ~F.col("is_scheduled"),
        "repair": lambda: kind_is("REPAIR"),
    }[kind]()


def _per_period(df: DataFrame, keys: Sequence[str], periods: Sequence[int], fields: Sequence[str], as_of: date) -> DataFrame:
    """Turn columns ``<field>_<days>`` into one row per period."""
    rows = [
        F.struct(
            F.lit(f"{p}d").alias("period"),
            F.lit(str(as_of - timedelta(days=p))).cast("date").alias("start_date"),
            F.lit(str(as_of)).cast("date").alias("end_date"),
            *[F.col(f"{f}_{p}").alias(f) for f in fields],
        )
        for p in periods
    ]
    return df.select(*keys, F.explode(F.array(*rows)).alias("_p")).select(*keys, "_p.*")


def _rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "mtbf_hours": safe_ratio("total_flight_hours", "total_failures"),
            "failure_rate_per_1000_hours": safe_ratio(F.col("total_failures") * 1000.0, "total_flight_hours"),
        }
    )


def _windowed(maintenance, alerts, usage, as_of, periods, failure, whole_last_day):
    """Per-key counts with one column per period, each table read once for all periods."""
    inside = lambda ts, p: lookback(ts, as_of, p, whole_last_day)
    longest = max(periods)
    failed = maintenance.filter(inside("event_timestamp", longest) & failure)
    raised = alerts.filter(inside("event_timestamp", longest))
    flown = usage.filter(inside("date", longest))
    failures = failed.groupBy("component_id").agg(
        *[count_where(inside("event_timestamp", p)).alias(f"total_failures_{p}") for p in periods],
        *[count_where(inside("event_timestamp", p) & ~F.col("is_scheduled")).alias(f"unscheduled_failures_{p}") for p in periods],
    )
    alert_sums = raised.groupBy("component_id").agg(
        *[count_where(inside("event_timestamp", p)).alias(f"total_alerts_{p}") for p in periods],
        *[count_where(inside("event_timestamp", p) & (F.col("severity") == "CRITICAL")).alias(f"critical_alerts_{p}") for p in periods],
    )
    hours = flown.groupBy("aircraft_msn").agg(
        *[F.sum(F.when(inside("date", p), F.col("flight_hours"))).alias(f"total_flight_hours_{p}") for p in periods],
        *[F.sum(F.when(inside("date", p), F.col("takeoffs"))).alias(f"total_cycles_{p}") for p in periods],
    )
    return failures, alert_sums, hours


def component_reliability(
    maintenance: DataFrame, alerts: DataFrame, usage: DataFrame, components: DataFrame, as_of: str | date,
    periods: Sequence[int] = PERIODS, failure: Column | str = "failure_type", whole_last_day: bool = True,
) -> DataFrame:
    """Hours, failures, alerts, MTBF and rate per component for every lookback period in one pass."""
    as_of = as_date(as_of)
    failure = failure_condition(failure) if isinstance(failure, str) else failure
    failures, alert_sums, hours = _windowed(maintenance, alerts, usage, as_of, periods, failure, whole_last_day)
    counts = [f"{n}_{p}" for p in periods for n in ("total_failures", "unscheduled_failures", "total_alerts", "critical_alerts")]
    own_hours = (
        components.select("component_id", "aircraft_msn").join(hours, "aircraft_msn", "left").groupBy("component_id")
        .agg(*[F.sum(f"{n}_{p}").alias(f"{n}_{p}") for p in periods for n in ("total_flight_hours", "total_cycles")])
    )
    info = components.select("component_id", "component_name", "component_type")
    wide = join_aggregates(own_hours, [failures, alert_sums, info], ["component_id"], counts)
    fields = ["total_flight_hours", "total_cycles", "total_failures", "unscheduled_failures", "total_alerts", "critical_alerts"]
    return _rates(_per_period(wide, ["component_id", "component_name", "component_type"], periods, fields, as_of))


def system_reliability(
    maintenance: DataFrame, alerts: DataFrame, usage: DataFrame, components: DataFrame, as_of: str | date,
    periods: Sequence[int] = PERIODS, failure: Column | str = "failure_type", whole_last_day: bool = True,
) -> DataFrame:
    """The counts rolled up to component type, for types with a failed component in the period."""
    as_of = as_date(as_of)
    failure = failure_condition(failure) if isinstance(failure, str) else failure
    failures, alert_sums, _ = _windowed(maintenance, alerts, usage, as_of, periods, failure, whole_last_day)
    kind = components.select("component_id", "component_type")
    by_type = failures.join(kind, "component_id", "left").groupBy("component_type").agg(
        *[count_where(F.col(f"total_failures_{p}") > 0).alias(f"component_count_{p}") for p in periods],
        *[F.sum(f"{n}_{p}").alias(f"{n}_{p}") for p in periods for n in ("total_failures", "unscheduled_failures")],
    )
    alert_types = alert_sums.join(kind, "component_id", "left").groupBy("component_type").agg(
        *[F.sum(f"{n}_{p}").alias(f"{n}_{p}") for p in periods for n in ("total_alerts", "critical_alerts")]
    )
    zero = [f"{n}_{p}" for p in periods for n in ("total_alerts", "critical_alerts")]
    wide = join_aggregates(by_type, [alert_types], ["component_type"], zero)
    fields = ["component_count", "total_failures", "unscheduled_failures", "total_alerts", "critical_alerts"]
    return _per_period(wide, ["component_type"], periods, fields, as_of).filter("component_count > 0")


def component_reliability_total(maintenance: DataFrame, alerts: DataFrame, usage: DataFrame, components: DataFrame) -> DataFrame:
    """The all-time metric table, for components whose aircraft has usage."""
    hours = usage.groupBy("aircraft_msn").agg(
        F.sum("flight_hours").alias("total_flight_hours"), F.sum("takeoffs").alias("total_cycles")
    )
    failures = maintenance.filter(failure_condition("failure_type")).groupBy("component_id").agg(
        F.count("*").alias("total_failures"), count_where(~F.col("is_scheduled")).alias("unscheduled_failures")
    )
    alert_sums = alerts.groupBy("component_id").agg(
        F.count("*").alias("total_alerts"), count_where(F.col("severity") == "CRITICAL").alias("critical_alerts")
    )
    base = components.select("component_id", "aircraft_msn").join(hours, "aircraft_msn")
    zero = ["total_failures", "unscheduled_failures", "total_alerts", "critical_alerts"]
    return _rates(join_aggregates(base, [failures, alert_sums], ["component_id"], zero))


def aircraft_component_reliability(usage: DataFrame, maintenance: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per aircraft and part: MTBF by repairs in hours and (whole) cycles, unscheduled removals per 1000 hours."""
    flown = usage.groupBy("aircraft_msn").agg(
        F.sum("flight_hours").alias("total_flight_hours"), F.sum("takeoffs").alias("total_takeoffs"),
        F.sum("landings").alias("total_landings"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    worked = maintenance.groupBy("aircraft_msn", "component_id").agg(
        F.count("*").alias("total_maintenance_events"),
        count_where(F.col("event_type") == "REPAIR").alias("total_repairs"),
        count_where(F.col("event_type") == "INSPECTION").alias("total_inspections"),
        count_where(~F.col("is_scheduled")).alias("total_unscheduled"),
    )
    raised = alerts.groupBy("aircraft_msn", "component_id").agg(
        F.count("*").alias("total_alerts"), count_where(F.col("severity") == "CRITICAL").alias("critical_alerts"),
        count_where(F.col("severity") == "WARNING").alias("warning_alerts"),
    )
    counts = [c for c in [*worked.columns, *raised.columns] if c.startswith(("total_", "critical_", "warning_"))]
    joined = join_either_side(flown, worked, raised, "aircraft_msn", "component_id")
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    repaired = F.col("total_repairs") > 0
    return joined.withColumns(
        {
            "mtbf_hours": F.when((F.col("total_flight_hours") > 0) & repaired, F.col("total_flight_hours") / F.col("total_repairs")),
            "mtbf_cycles": F.expr("CASE WHEN total_takeoffs > 0 AND total_repairs > 0 THEN total_takeoffs DIV total_repairs END"),
            "unscheduled_removal_rate": safe_ratio(F.col("total_unscheduled") * 1000.0, "total_flight_hours"),
        }
    )


def weekly_reliability(
    maintenance: DataFrame, usage: DataFrame, as_of: str | date, periods: Sequence[int] = PERIODS, whole_last_day: bool = True
) -> DataFrame:
    """Unscheduled events per component over the hours of every aircraft that had work on it; divisors at least one."""
    as_of = as_date(as_of)
    inside = lambda ts, p: lookback(ts, as_of, p, whole_last_day)
    longest = max(periods)
    pairs = maintenance.filter(inside("event_timestamp", longest)).groupBy("component_id", "aircraft_msn").agg(
        *[count_where(inside("event_timestamp", p)).alias(f"events_{p}") for p in periods],
        *[count_where(inside("event_timestamp", p) & ~F.col("is_scheduled")).alias(f"failures_{p}") for p in periods],
    )
    hours = usage.filter(inside("date", longest)).groupBy("aircraft_msn").agg(
        *[F.sum(F.when(inside("date", p), F.col("flight_hours"))).alias(f"hours_{p}") for p in periods]
    )
    wide = pairs.join(hours, "aircraft_msn", "left").groupBy("component_id").agg(
        *[F.sum(f"failures_{p}").alias(f"failures_{p}") for p in periods],
        *[F.coalesce(F.sum(F.when(F.col(f"events_{p}") > 0, F.col(f"hours_{p}"))), F.lit(0.0)).alias(f"flight_hours_{p}") for p in periods],
    )
    long = _per_period(wide, ["component_id"], periods, ["failures", "flight_hours"], as_of)
    return long.filter("failures > 0").withColumns(
        {
            "mtbf": safe_ratio("flight_hours", "failures", "floor"),
            "failure_rate": safe_ratio(F.col("failures") * 1000, "flight_hours", "floor"),
        }
    )


def reliability_report(metrics: DataFrame, k: int = 5) -> DataFrame:
    """One nested row per period: totals, means, and the k most and least reliable components."""
    totals = metrics.groupBy("period", "start_date", "end_date").agg(
        F.count("*").alias("total_components_analyzed"), F.sum("failures").alias("total_failures"),
        F.sum("flight_hours").alias("total_flight_hours"), F.avg("mtbf").alias("average_mtbf"),
        F.avg("failure_rate").alias("average_failure_rate"),
    )

    def best(value: str, name: str) -> DataFrame:
        top = top_k(metrics, ["period"], [F.desc(value), F.asc("component_id")], k)
        packed = F.array_sort(F.collect_list(F.struct("rank", "component_id", value)))
        return top.groupBy("period").agg(packed.alias(name))

    return totals.join(best("mtbf", "top_reliable_components"), "period", "left").join(
        best("failure_rate", "top_unreliable_components"), "period", "left"
    )


def reliability_history(maintenance: DataFrame, usage: DataFrame, components: DataFrame, unit: str = "month") -> DataFrame:
    """The metric table over time: one row per component and period with events, stamped with the period start.

    Events come as they are, without their components. They are counted before they meet them, so no join sorts the events; each counts
    once for every row of its component, and not at all without one.
    """
    stamp = lambda c: F.date_trunc(unit, c).alias("calculation_timestamp")
    hours = usage.groupBy("aircraft_msn", stamp("date")).agg(F.sum("flight_hours").alias("total_flight_hours"))
    counts = maintenance.groupBy("component_id", stamp("event_timestamp")).agg(
        count_where(failure_condition("failure_type")).alias("total_failures"),
        count_where(failure_condition("unscheduled_failure")).alias("unscheduled_failures"),
    )
    info = components.select("component_id", "aircraft_msn", "component_type", "manufacturer")
    info = info.withColumn("_rows", F.count("*").over(W.partitionBy("component_id")))
    counts = counts.join(info, "component_id").withColumns({c: F.col(c) * F.col("_rows") for c in ("total_failures", "unscheduled_failures")}).drop("_rows")
    return _rates(counts.join(hours, ["aircraft_msn", "calculation_timestamp"], "left"))
