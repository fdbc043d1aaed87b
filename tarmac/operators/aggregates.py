"""Grouped statistics over samples, usage, maintenance and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import between_days
from ..functions.numeric import count_where, pct_change

# Sensor columns in reporting order.
SENSORS = (
    "engine_1_temp", "engine_2_temp", "engine_1_pressure", "engine_2_pressure",
    "engine_1_vibration", "engine_2_vibration", "fuel_flow_rate", "altitude", "speed",
)
DEVIATING = ("engine_1_temp", "engine_2_temp", "engine_1_vibration", "engine_2_vibration")
HEADLINE = ("engine_1_temp", "engine_2_temp", "fuel_flow_rate")


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def means(df: DataFrame, columns: Sequence[str], prefix: str = "avg_") -> list[Column]:
    return [F.avg(c).alias(f"{prefix}{c}") for c in _present(df, columns)]


def deviations(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.stddev_samp(c).alias(f"stddev_{c}") for c in _present(df, columns)]


def maxima(df: DataFrame, columns: Sequence[str], prefix: str = "max_") -> list[Column]:
    return [F.max(c).alias(f"{prefix}{c}") for c in _present(df, columns)]


def flight_stats(samples: DataFrame, dims: DataFrame, entity: str = "aircraft_msn", flight: str = "flight_id") -> DataFrame:
    """Sensor means and deviations per flight; the airline is looked up after the aggregation."""
    stats = samples.groupBy(entity, flight).agg(
        *means(samples, SENSORS), *deviations(samples, DEVIATING), F.count("*").alias("data_points")
    )
    return stats.join(dims, entity, "left")


def aircraft_stats(samples: DataFrame, dims: DataFrame, entity: str = "aircraft_msn", flight: str = "flight_id") -> DataFrame:
    """Headline means, sample count and flight count per aircraft."""
    stats = samples.groupBy(entity).agg(
        *means(samples, HEADLINE), F.count(flight).alias("data_points"), F.count_distinct(flight).alias("flight_count")
    )
    return stats.join(dims, entity, "left")


def airline_stats(samples: DataFrame, dims: DataFrame, airline: str, entity: str = "aircraft_msn", flight: str = "flight_id") -> DataFrame:
    """Means over all samples of an airline, its sample and aircraft counts, rolled up from one row per aircraft."""
    cols = _present(samples, HEADLINE)
    per_aircraft = samples.groupBy(entity).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols], F.count(flight).alias("_rows")
    )
    return (
        per_aircraft.join(dims, entity, "left")
        .groupBy(airline)
        .agg(
            *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(f"avg_{c}") for c in cols],
            F.sum("_rows").alias("data_points"),
            F.count_distinct(entity).alias("aircraft_count"),
        )
    )


def flight_daily(samples: DataFrame, entity: str = "aircraft_msn", flight: str = "flight_id", ts: str = "event_timestamp") -> DataFrame:
    """One row per flight: span, means, maxima, temperature deviations."""
    return samples.groupBy(entity, flight).agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
        *means(samples, SENSORS), *maxima(samples, ("altitude", "speed")),
        *deviations(samples, ("engine_1_temp", "engine_2_temp")),
    )


def aircraft_daily(samples: DataFrame, entity: str = "aircraft_msn", flight: str = "flight_id") -> DataFrame:
    """One row per aircraft of a day's samples."""
    return samples.groupBy(entity).agg(
        F.count(flight).alias("data_points"), F.count_distinct(flight).alias("flight_count"),
        *means(samples, SENSORS, "daily_avg_"), *maxima(samples, ("altitude", "speed"), "daily_max_"),
    )


def usage_totals(usage: DataFrame, keys: Sequence[str] = ("aircraft_msn",)) -> DataFrame:
    cols = _present(usage, ("takeoffs", "landings", "flight_hours", "apu_cycles", "apu_hours"))
    return usage.groupBy(*keys).agg(*[F.sum(c).alias(f"total_{c}") for c in cols])


def maintenance_counts(events: DataFrame, keys: Sequence[str] = ("aircraft_msn", "component_id")) -> DataFrame:
    """Events by kind and plan, and total hours."""
    return events.groupBy(*keys).agg(
        F.count("*").alias("event_count"),
        F.sum("duration_hours").alias("total_maintenance_hours"),
        count_where(F.col("is_scheduled")).alias("scheduled_events"),
        count_where(~F.col("is_scheduled")).alias("unscheduled_events"),
        count_where(F.col("event_type") == "REPAIR").alias("repair_events"),
        count_where(F.col("event_type") == "INSPECTION").alias("inspection_events"),
    )


def alert_counts(alerts: DataFrame, keys: Sequence[str] = ("aircraft_msn", "component_id")) -> DataFrame:
    """Alerts by severity."""
    return alerts.groupBy(*keys).agg(
        F.count("*").alias("total_alerts"),
        *[count_where(F.col("severity") == s).alias(f"{s.lower()}_alerts") for s in ("CRITICAL", "WARNING", "INFO")],
    )


def category_counts(df: DataFrame, by: str, name: str = "metric") -> DataFrame:
    return df.groupBy(F.col(by).alias(name)).agg(F.count("*").alias("value"))


def timeseries(df: DataFrame, time: Column, metric: Column, value: Column) -> DataFrame:
    """One aggregate per (time, metric) for a chart."""
    return df.groupBy(time.alias("time"), metric.alias("metric")).agg(value.alias("value"))


def by_interval(
    samples: DataFrame, entity: str, ids: Sequence[object] | None, first: str | date, last: str | date, unit: str,
    metrics: Sequence[str], stats: Sequence[str] = ("avg", "min", "max"), ts: str = "event_timestamp",
) -> DataFrame:
    """Chosen metrics per entity and time bucket (hour, day, week, month) over a date range."""
    if unit not in ("hour", "day", "week", "month"):
        raise ValueError(f"unknown interval {unit!r}")
    chosen = samples.filter(between_days(ts, first, last))
    if ids is not None:
        chosen = chosen.filter(F.col(entity).isin(list(ids)))
    make = {"avg": F.avg, "min": F.min, "max": F.max}
    return chosen.groupBy(entity, F.date_trunc(unit, ts).alias("bucket")).agg(
        *[make[s](m).alias(f"{m}_{s}") for m in metrics for s in stats]
    )


def mean_change(df: DataFrame, by: Sequence[str], new: str, old: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Mean of both columns and the change between the means in percent."""
    return df.groupBy(*by).agg(
        F.avg(old).alias(f"avg_{old}"), F.avg(new).alias(f"avg_{new}"),
        pct_change(F.avg(new), F.avg(old)).alias("change_pct"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def parameter_frequency(df: DataFrame, json_column: str, schema: str, top: int = 10) -> DataFrame:
    """How often each parameter occurs in a JSON array of objects; the most frequent ones."""
    return (
        df.select(F.explode(F.from_json(json_column, schema)).alias("p"))
        .groupBy(F.col("p.parameter").alias("metric"))
        .agg(F.count("*").alias("value"))
        .orderBy(F.desc("value"), "metric")
        .limit(top)
    )


def decision_stats(history: DataFrame) -> DataFrame:
    """Decisions made, toxic and accepted."""
    return history.agg(
        F.count("*").alias("total_decisions"),
        count_where(F.col("decision") == "TOXIC").alias("toxic_count"),
        count_where(F.col("decision") == "OK").alias("ok_count"),
    )


def anomaly_rate(samples: DataFrame, anomalies: DataFrame, flight: str, anomaly: str, by: Sequence[str]) -> DataFrame:
    """``100 * distinct anomalies / distinct flights`` per group, flights without anomalies included.

    Both sides are reduced to distinct flights and per-flight counts before they meet.
    """
    flights = samples.select(*by, flight).distinct()
    counts = anomalies.select(flight, anomaly).distinct().groupBy(flight).agg(F.count("*").alias("_a"))
    return (
        counts.join(flights, flight, "right")
        .groupBy(*by)
        .agg((F.coalesce(F.sum("_a"), F.lit(0)) * 100.0 / F.count(flight)).alias("anomaly_rate"))
    )
