"""Maintenance intervals: features, risk and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import whole_days
from ..functions.numeric import count_where, ladder, safe_ratio
from ..session import materialise
from .aggregates import alert_counts
from .joins import interval_totals, join_aggregates
from .reliability import failure_condition
from .windows import day_intervals, event_intervals

# Labels and texts of a recommendation, from high to low risk.
ACTIONS = ("REDUCE_INTERVAL", "MAINTAIN_INTERVAL", "EXTEND_INTERVAL")
FACTORS = (0.8, 1.0, 1.1)
REASONS = (
    "Taux élevé de défaillances non programmées et d'alertes",
    "Taux modéré de défaillances non programmées",
    "Faible taux de défaillances non programmées",
)
PART = ("aircraft_msn", "component_id")


def _by_risk(risk: Column | str, high: float, low: float, values: Sequence[object]) -> Column:
    return ladder(risk, [(high, values[0]), (low, values[1])], values[2])


def interval_features(maintenance: DataFrame, usage: DataFrame, alerts: DataFrame) -> DataFrame:
    """Intervals between scheduled work days of a part with usage, unscheduled work and alerts inside them."""
    intervals = day_intervals(maintenance.filter("is_scheduled"), PART, "event_timestamp")
    flown = interval_totals(
        intervals, usage, ["aircraft_msn"], "start_date", "end_date", "date",
        {
            "flight_hours_in_interval": F.sum("flight_hours"),
            "takeoffs_in_interval": F.sum("takeoffs"),
            "landings_in_interval": F.sum("landings"),
        },
        missing_as_null=["flight_hours_in_interval", "takeoffs_in_interval", "landings_in_interval"],
    )
    # unscheduled work and alerts share the part and the day, so one pass covers both
    work = maintenance.filter(~F.col("is_scheduled")).select(
        *PART, F.to_date("event_timestamp").alias("day"), F.lit("work").alias("kind"), F.lit(None).cast("string").alias("severity")
    )
    raised = alerts.select(*PART, F.to_date("event_timestamp").alias("day"), F.lit("alert").alias("kind"), "severity")
    return interval_totals(
        flown, work.unionByName(raised), PART, "start_date", "end_date", "day",
        {
            "unscheduled_failures_in_interval": count_where(F.col("kind") == "work"),
            "alerts_in_interval": count_where(F.col("kind") == "alert"),
            "critical_alerts_in_interval": count_where(F.col("severity") == "CRITICAL"),
        },
    )


def interval_risk(features: DataFrame, components: DataFrame) -> DataFrame:
    """Risk per hundred flight hours, and the interval it suggests."""
    info = components.select("component_id", "component_name", "component_type", "recommended_maintenance_interval")
    weight = F.col("unscheduled_failures_in_interval") * 2 + F.col("alerts_in_interval")
    risk = F.when(F.col("flight_hours_in_interval") > 0, weight / F.col("flight_hours_in_interval") * 100).otherwise(F.lit(0.0))
    return (
        features.join(info, "component_id", "left")
        .withColumn("failure_risk", risk)
        .withColumn("optimal_interval_ratio", _by_risk("failure_risk", 5, 2, FACTORS))
        .withColumn("optimal_interval_days", F.col("recommended_maintenance_interval") * F.col("optimal_interval_ratio"))
    )


def recommend(risks: DataFrame) -> DataFrame:
    """One recommendation per component from the mean risk of its intervals."""
    per_component = risks.groupBy("component_id", "component_name", "component_type", "recommended_maintenance_interval").agg(
        F.avg("optimal_interval_days").alias("optimal_interval_days"), F.avg("failure_risk").alias("average_failure_risk"),
        F.sum("unscheduled_failures_in_interval").alias("total_unscheduled_failures"),
        F.sum("alerts_in_interval").alias("total_alerts"), F.count("*").alias("interval_count"),
    )
    return per_component.withColumns(
        {
            "recommendation": _by_risk("average_failure_risk", 5, 2, ACTIONS),
            "justification": _by_risk("average_failure_risk", 5, 2, REASONS),
            "confidence_score": ladder("interval_count", [(5, 0.9), (2, 0.7)], 0.5),
        }
    )


def interval_history(maintenance: DataFrame, components: DataFrame, aircraft: DataFrame, alerts: DataFrame) -> DataFrame:
    """Intervals between any two consecutive events of a part, with totals of the part and a risk per day."""
    raw = event_intervals(maintenance, PART, "event_timestamp", ["event_type", "is_scheduled"])
    info = components.select("component_id", "component_type", "manufacturer", "recommended_maintenance_interval")
    dims = raw.join(info, "component_id").join(aircraft.select("aircraft_msn", "airline_code"), "aircraft_msn")
    failed = maintenance.filter(failure_condition("unscheduled_failure")).groupBy(*PART).agg(F.count("*").alias("unscheduled_failures"))
    raised = alert_counts(alerts).select(*PART, "total_alerts", "critical_alerts")
    joined = join_aggregates(dims, [raised, failed], PART, ["total_alerts", "critical_alerts", "unscheduled_failures"])
    return joined.withColumns(
        {
            "is_failure": (F.col("event_type") == "FAILURE") & ~F.col("is_scheduled"),
            "recommended_interval": F.col("recommended_maintenance_interval").cast("double"),
            "interval_ratio": F.try_divide("interval_days", "recommended_maintenance_interval"),
            "failure_risk": (F.col("unscheduled_failures") * 2 + F.col("critical_alerts")) / F.col("interval_days") * 100,
        }
    )


def interval_analysis(history: DataFrame, by: str, spread: bool = False) -> DataFrame:
    """Interval statistics per group; ``spread`` adds extremes, alert totals and the failure rate."""
    extra = []
    if spread:
        extra = [
            F.min("interval_days").alias("min_interval"), F.max("interval_days").alias("max_interval"),
            F.sum("total_alerts").alias("total_alerts"), F.sum("critical_alerts").alias("critical_alerts"),
            (count_where(F.col("is_failure")) / F.sum("interval_days") * 1000).alias("failure_rate_per_1000_days"),
        ]
    return history.groupBy(by).agg(
        F.avg("interval_days").alias("mean_interval"), F.stddev_samp("interval_days").alias("std_interval"),
        F.count("*").alias("count"), F.avg("recommended_interval").alias("mean_recommended_interval"),
        F.avg("interval_ratio").alias("mean_interval_ratio"), count_where(F.col("is_failure")).alias("failures"),
        F.sum("unscheduled_failures").alias("unscheduled_failures"), *extra,
    )


def component_analysis(maintenance: DataFrame, usage: DataFrame, alerts: DataFrame, components: DataFrame) -> DataFrame:
    """Per component with two events or more: mean gap in whole days, mean hours flown between events, counts.

    Consecutive events of one day form gaps of zero days and of that day's hours, so each day is one row with
    its event count; the gaps between days are the only ones that need an order. Counts and gaps are summed per component
    at once; only stretches that a gap covers are looked up, and names are attached at the end.
    """
    days = maintenance.groupBy("component_id", F.to_date("event_timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"),
        count_where(~F.col("is_scheduled")).alias("unscheduled"),
    )
    order = W.partitionBy("component_id").orderBy("day")
    steps = materialise(days.withColumns({"prev_day": F.lag("day").over(order), "prev_last": F.lag("last").over(order)}), "steps")
    gap = F.coalesce(whole_days(F.col("prev_last"), F.col("first")), F.lit(0))
    counted = steps.groupBy("component_id").agg(
        F.sum("n").alias("total_maintenance_events"), F.sum("unscheduled").alias("unscheduled_maintenance_count"), F.sum(gap).alias("_days")
    )
    info = ["component_id", "component_name", "aircraft_msn", "recommended_maintenance_interval"]
    # repeated rows of a component count each
    owners = components.groupBy(*info).agg(F.count("*").alias("_rows")).join(usage.select("aircraft_msn").distinct(), "aircraft_msn", "left_semi")
    stretch = lambda start, pairs: F.struct(F.col(start).alias("start"), F.col("day").alias("end"), pairs.cast("bigint").alias("pairs"))
    both = F.array(
        F.when(F.col("n") > 1, stretch("day", F.col("n") - 1)), F.when(F.col("prev_day").isNotNull(), stretch("prev_day", F.lit(1)))
    )
    spans = steps.select("component_id", F.explode(F.filter(both, lambda s: s.isNotNull())).alias("s")).select("component_id", "s.*")
    spans = spans.join(owners.select("component_id", "aircraft_msn").distinct(), "component_id")
    hours = interval_totals(spans, usage, ["aircraft_msn"], "start", "end", "date", {"hours": F.sum("flight_hours")})
    flown = hours.groupBy("component_id", "aircraft_msn").agg(F.sum(F.col("pairs") * F.coalesce("hours", F.lit(0.0))).alias("_hours"))
    sums = ["total_maintenance_events", "unscheduled_maintenance_count", "_days"]
    per_component = (
        owners.join(counted, "component_id").join(flown, ["component_id", "aircraft_msn"], "left")
        .select(*info, *[(F.col(c) * F.col("_rows")).alias(c) for c in sums], (F.coalesce("_hours", F.lit(0.0)) * F.col("_rows")).alias("_hours"))
        .filter("total_maintenance_events > 1")
    )
    raised = alerts.groupBy("component_id").agg(F.count("*").alias("alert_count"))
    pairs = F.col("total_maintenance_events") - 1
    return join_aggregates(per_component, [raised], ["component_id"], ["alert_count"]).withColumns(
        {
            "avg_actual_interval_days": F.col("_days") / pairs,
            "avg_flight_hours_between_maintenance": F.col("_hours") / pairs,
        }
    ).drop("_days", "_hours")


def recommend_from_analysis(analysis: DataFrame) -> DataFrame:
    """Recommendation from unscheduled work and alerts per event, and the flight hours that fit the new interval."""
    risk = safe_ratio(
        F.col("unscheduled_maintenance_count") * 2 + F.col("alert_count"), "total_maintenance_events", "floor"
    )
    per_day = safe_ratio("avg_flight_hours_between_maintenance", "avg_actual_interval_days", "floor")
    return (
        analysis.withColumn("risk_score", risk)
        .withColumns(
            {
                "optimal_interval_days": F.col("recommended_maintenance_interval") * _by_risk("risk_score", 0.5, 0.2, FACTORS),
                "recommendation": _by_risk("risk_score", 0.5, 0.2, ACTIONS),
                "justification": _by_risk("risk_score", 0.5, 0.2, REASONS),
            }
        )
        .withColumn(
            "optimal_flight_hours",
            F.when(F.col("avg_flight_hours_between_maintenance") > 0, F.col("optimal_interval_days") * per_day),
        )
        .withColumn("optimal_flight_hours", F.when(F.col("optimal_flight_hours") != 0, F.col("optimal_flight_hours")))
    )
