"""Aircraft and airline performance figures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import between_days, previous_month
from ..functions.numeric import count_where, safe_ratio
from .aggregates import SENSORS, maxima, means
from .joins import join_aggregates


def aircraft_performance(usage: DataFrame, maintenance: DataFrame, alerts: DataFrame, samples: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Totals, means and three ratios per aircraft, from four tables each reduced to the aircraft first."""
    flown = usage.groupBy("aircraft_msn").agg(
        F.sum("flight_hours").alias("total_flight_hours"), F.sum("takeoffs").alias("total_takeoffs"),
        F.sum("landings").alias("total_landings"), F.avg("flight_hours").alias("avg_daily_flight_hours"),
    )
    worked = maintenance.groupBy("aircraft_msn").agg(
        F.count("*").alias("total_maintenance_events"),
        count_where(~F.col("is_scheduled")).alias("unscheduled_maintenance_events"),
        F.sum("duration_hours").alias("total_maintenance_hours"),
    )
    raised = alerts.groupBy("aircraft_msn").agg(
        F.count("*").alias("total_alerts"), count_where(F.col("severity") == "CRITICAL").alias("critical_alerts"),
        count_where(F.col("severity") == "WARNING").alias("warning_alerts"),
    )
    sensed = samples.groupBy("aircraft_msn").agg(
        F.avg("engine_1_temp").alias("avg_engine_1_temp"), F.avg("engine_2_temp").alias("avg_engine_2_temp"),
        F.avg("fuel_flow_rate").alias("avg_fuel_flow_rate"),
        F.stddev_samp("engine_1_vibration").alias("stddev_engine_1_vibration"),
        F.stddev_samp("engine_2_vibration").alias("stddev_engine_2_vibration"),
    )
    base = flown.join(aircraft.select("aircraft_msn", "airline_code"), "aircraft_msn")
    zero = [*worked.columns[1:], *raised.columns[1:]]
    return join_aggregates(base, [worked, raised, sensed], ["aircraft_msn"], zero).withColumns(
        {
            "maintenance_events_per_flight_hour": safe_ratio("total_maintenance_events", "total_flight_hours"),
            "alerts_per_flight_hour": safe_ratio("total_alerts", "total_flight_hours"),
            "unscheduled_maintenance_ratio": safe_ratio("unscheduled_maintenance_events", "total_maintenance_events"),
        }
    )


def monthly_aircraft_performance(samples: DataFrame, usage: DataFrame) -> DataFrame:
    """Days first, then months: means of daily means, estimated fuel, fuel per hour, hours per takeoff."""
    days = samples.groupBy("aircraft_msn", F.to_date("event_timestamp").alias("date")).agg(
        F.count_distinct("flight_id").alias("flights_count"), *means(samples, SENSORS), *maxima(samples, ("altitude", "speed"))
    )
    daily = days.join(usage, ["aircraft_msn", "date"], "left").withColumns(
        {
            "estimated_fuel": F.when(F.col("flight_hours") > 0, F.col("avg_fuel_flow_rate") * F.col("flight_hours")),
            "flight_duration": safe_ratio("flight_hours", "takeoffs"),
        }
    )
    sensors = [c for c in days.columns if c.startswith("avg_")]
    peaks = [c for c in days.columns if c.startswith("max_")]
    return daily.groupBy("aircraft_msn", F.trunc("date", "month").alias("month")).agg(
        F.count("date").alias("days_with_flights"), F.sum("flights_count").alias("total_flights"),
        F.sum("flight_hours").alias("total_flight_hours"), F.sum("takeoffs").alias("total_takeoffs"),
        F.sum("landings").alias("total_landings"),
        *[F.avg(c).alias(f"monthly_{c}") for c in sensors], *[F.max(c).alias(f"monthly_{c}") for c in peaks],
        F.sum("estimated_fuel").alias("monthly_fuel_consumption"),
        F.avg("flight_duration").alias("monthly_avg_flight_duration"),
        safe_ratio(F.sum("estimated_fuel"), F.sum("flight_hours")).alias("fuel_efficiency"),
        safe_ratio(F.sum("flight_hours"), F.sum("takeoffs")).alias("utilization_efficiency"),
    )


def _month_totals(usage, maintenance, alerts, aircraft, first, last):
    """Per-aircraft totals of a month for aircraft that flew in it."""
    flown = usage.filter(between_days("date", first, last)).groupBy("aircraft_msn").agg(
        F.sum("flight_hours").alias("total_flight_hours"), F.sum("takeoffs").alias("total_cycles")
    )
    worked = maintenance.filter(between_days("event_timestamp", first, last)).groupBy("aircraft_msn").agg(
        F.count("*").alias("total_maintenance_events"), count_where(~F.col("is_scheduled")).alias("total_unscheduled_maintenance")
    )
    raised = alerts.filter(between_days("event_timestamp", first, last)).groupBy("aircraft_msn").agg(
        F.count("*").alias("total_alerts"), count_where(F.col("severity") == "CRITICAL").alias("critical_alerts")
    )
    return flown, worked, raised, aircraft.select("aircraft_msn", "airline_code")


def airline_month(usage: DataFrame, maintenance: DataFrame, alerts: DataFrame, aircraft: DataFrame, as_of: str | date) -> DataFrame:
    """Totals and ratios per airline for the month before ``as_of``, for airlines that flew in it."""
    first, last = previous_month(as_of)
    flown, worked, raised, owner = _month_totals(usage, maintenance, alerts, aircraft, first, last)
    by_airline = lambda df: df.join(owner, "aircraft_msn").groupBy("airline_code").agg(
        *[F.sum(c).alias(c) for c in df.columns if c != "aircraft_msn"]
    )
    zero = [*worked.columns[1:], *raised.columns[1:]]
    out = join_aggregates(by_airline(flown), [by_airline(worked), by_airline(raised)], ["airline_code"], zero)
    return out.withColumns(
        {
            "year": F.lit(first.year),
            "month": F.lit(first.month),
            "maintenance_per_flight_hour": safe_ratio("total_maintenance_events", "total_flight_hours", "floor"),
            "unscheduled_ratio": safe_ratio("total_unscheduled_maintenance", "total_maintenance_events", "floor"),
            "alerts_per_flight_hour": safe_ratio("total_alerts", "total_flight_hours", "floor"),
        }
    )


def aircraft_month(
    usage: DataFrame, samples: DataFrame, maintenance: DataFrame, alerts: DataFrame, aircraft: DataFrame, as_of: str | date
) -> DataFrame:
    """Totals per aircraft for the month before ``as_of``; sensor figures are means of daily means."""
    first, last = previous_month(as_of)
    flown, worked, raised, owner = _month_totals(usage, maintenance, alerts, aircraft, first, last)
    names = {"fuel_flow_rate": "avg_fuel_flow", "engine_1_temp": "avg_engine_1_temp", "engine_2_temp": "avg_engine_2_temp"}
    days = samples.filter(between_days("event_timestamp", first, last)).groupBy(
        "aircraft_msn", F.to_date("event_timestamp").alias("date")
    ).agg(*[F.avg(c).alias(n) for c, n in names.items()])
    sensed = days.groupBy("aircraft_msn").agg(*[F.avg(n).alias(n) for n in names.values()])
    parts = [sensed, worked, raised.drop("critical_alerts")]
    zero = [*names.values(), *worked.columns[1:], "total_alerts"]
    return join_aggregates(flown.join(owner, "aircraft_msn"), parts, ["aircraft_msn"], zero).withColumns(
        {
            "year": F.lit(first.year),
            "month": F.lit(first.month),
            "fuel_efficiency": safe_ratio("avg_fuel_flow", "total_flight_hours", "floor"),
            "maintenance_per_flight_hour": safe_ratio("total_maintenance_events", "total_flight_hours", "floor"),
        }
    )
