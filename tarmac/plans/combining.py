"""Joins and ordered computations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import joins as jn
from ..operators import windows as wn
from .registry import R, RA, S, query

PART = ["aircraft_msn", "component_id"]


@query("join_enrich_left", f"""SELECT f.aircraft_msn, f.flight_id, {RA('f.engine_1_temp', 'engine_1_temp')}, a.airline_code, a.status
    FROM flights f LEFT JOIN aircraft a ON a.aircraft_msn = f.aircraft_msn""")
def _(f):
    return jn.join_dimensions(f.flights, [(f.aircraft, ["aircraft_msn"])], "left").select("aircraft_msn", "flight_id", "engine_1_temp", "airline_code", "status")


@query("join_dims_inner", f"""SELECT m.aircraft_msn, m.component_id, {S('m.event_timestamp', 'event_timestamp')}, m.event_type, m.is_scheduled,
    c.component_type, c.manufacturer, a.airline_code FROM maint m JOIN components c ON c.component_id = m.component_id
    JOIN aircraft a ON a.aircraft_msn = m.aircraft_msn""")
def _(f):
    parts = f.components.select("component_id", "component_type", "manufacturer")
    joined = jn.join_dimensions(f.maint, [(parts, ["component_id"]), (f.aircraft, ["aircraft_msn"])])
    return joined.select(*PART, "event_timestamp", "event_type", "is_scheduled", "component_type", "manufacturer", "airline_code")


@query("join_agg_chain", f"""SELECT a.aircraft_msn, a.airline_code, {RA('u.hours', 'hours')}, COALESCE(m.events, 0) AS events, COALESCE(al.alerts, 0) AS alerts
    FROM aircraft a LEFT JOIN (SELECT aircraft_msn, SUM(flight_hours) AS hours FROM usage GROUP BY 1) u USING (aircraft_msn)
    LEFT JOIN (SELECT aircraft_msn, COUNT(*) AS events FROM maint GROUP BY 1) m USING (aircraft_msn)
    LEFT JOIN (SELECT aircraft_msn, COUNT(*) AS alerts FROM alerts GROUP BY 1) al USING (aircraft_msn)""")
def _(f):
    key = "aircraft_msn"
    parts = [
        f.usage.groupBy(key).agg(F.sum("flight_hours").alias("hours")),
        f.maint.groupBy(key).agg(F.count("*").alias("events")),
        f.alerts.groupBy(key).agg(F.count("*").alias("alerts")),
    ]
    return jn.join_aggregates(f.aircraft.select(key, "airline_code"), parts, [key], ["events", "alerts"])


@query("join_conditional_or", """SELECT u.aircraft_msn, COALESCE(m.component_id, al.component_id) AS component_id, m.events, al.alerts
    FROM (SELECT DISTINCT aircraft_msn FROM usage) u
    LEFT JOIN (SELECT aircraft_msn, component_id, COUNT(*) AS events FROM maint WHERE event_type = 'MODIFICATION' AND aircraft_msn % 2 = 0 GROUP BY 1, 2) m
        ON m.aircraft_msn = u.aircraft_msn
    LEFT JOIN (SELECT aircraft_msn, component_id, COUNT(*) AS alerts FROM alerts GROUP BY 1, 2) al
        ON al.aircraft_msn = u.aircraft_msn AND (m.component_id IS NULL OR m.component_id = al.component_id)
    WHERE m.component_id IS NOT NULL OR al.component_id IS NOT NULL""")
def _(f):
    # odd aircraft play those without maintenance
    worked = f.maint.filter("event_type = 'MODIFICATION' AND aircraft_msn % 2 = 0").groupBy(*PART).agg(F.count("*").alias("events"))
    raised = f.alerts.groupBy(*PART).agg(F.count("*").alias("alerts"))
    return jn.join_either_side(f.usage.select("aircraft_msn").distinct(), worked, raised, *PART)


@query("join_multi_key", f"""SELECT d.aircraft_msn, d.component_id, {S('d.day', 'day')}, {RA('u.flight_hours', 'flight_hours')}, a.alerts FROM
    (SELECT DISTINCT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS day FROM maint) d
    LEFT JOIN usage u ON u.aircraft_msn = d.aircraft_msn AND u.date = d.day
    LEFT JOIN (SELECT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS day, COUNT(*) AS alerts FROM alerts GROUP BY ALL) a
      ON a.aircraft_msn = d.aircraft_msn AND a.component_id = d.component_id AND a.day = d.day""")
def _(f):
    day = F.to_date("event_timestamp").alias("day")
    days = f.maint.select(*PART, day).distinct()
    raised = f.alerts.groupBy(*PART, day).agg(F.count("*").alias("alerts"))
    usage = f.usage.select("aircraft_msn", F.col("date").alias("day"), "flight_hours")
    return days.join(usage, ["aircraft_msn", "day"], "left").join(raised, [*PART, "day"], "left")


@query("join_interval_range", f"""SELECT i.aircraft_msn, i.component_id, {S('i.start_date', 'start_date')}, {S('i.end_date', 'end_date')},
    i.interval_days, {RA('u.hours', 'hours')}, u.days, COALESCE(m.n, 0) AS repairs FROM sched_intervals i
    LEFT JOIN (SELECT i.aircraft_msn, i.component_id, i.end_date, SUM(u.flight_hours) AS hours, COUNT(*) AS days
        FROM sched_intervals i JOIN usage u ON u.aircraft_msn = i.aircraft_msn AND u.date BETWEEN i.start_date AND i.end_date GROUP BY ALL) u
        USING (aircraft_msn, component_id, end_date)
    LEFT JOIN (SELECT i.aircraft_msn, i.component_id, i.end_date, COUNT(*) AS n FROM sched_intervals i JOIN maint m
        ON m.aircraft_msn = i.aircraft_msn AND m.component_id = i.component_id AND m.event_type = 'REPAIR'
        AND CAST(m.event_timestamp AS DATE) BETWEEN i.start_date AND i.end_date GROUP BY ALL) m
        USING (aircraft_msn, component_id, end_date)""")
def _(f):
    f.store("components", "maint")
    intervals = wn.day_intervals(f.maint.filter("is_scheduled"), PART, "event_timestamp")
    flown = jn.interval_totals(
        intervals, f.usage, ["aircraft_msn"], "start_date", "end_date", "date",
        {"hours": F.sum("flight_hours"), "days": F.count("*")}, missing_as_null=["hours", "days"],
    )
    repairs = f.maint.filter("event_type = 'REPAIR'").withColumn("day", F.to_date("event_timestamp"))
    return jn.interval_totals(flown, repairs, PART, "start_date", "end_date", "day", {"repairs": F.count("*")})


@query("join_semi_in", f"""SELECT {S('date', 'date')}, {RA('SUM(flight_hours)', 'hours')} FROM usage
    WHERE aircraft_msn IN (SELECT aircraft_msn FROM aircraft WHERE airline_code IN (3, 7, 11)) GROUP BY date""")
def _(f):
    owned = f.aircraft.filter(F.col("airline_code").isin(3, 7, 11)).select("aircraft_msn")
    return f.usage.join(owned, "aircraft_msn", "left_semi").groupBy("date").agg(F.sum("flight_hours").alias("hours"))


@query("join_semi_limit", f"""SELECT aircraft_msn, flight_id, {S('event_timestamp', 'event_timestamp')}, {RA('engine_1_temp', 'engine_1_temp')} FROM flights
    WHERE flight_id IN (SELECT alert_id FROM alerts WHERE severity = 'CRITICAL' ORDER BY event_timestamp DESC, alert_id LIMIT 1)""")
def _(f):
    picks = f.alerts.filter("severity = 'CRITICAL'").select(F.col("alert_id").alias("flight_id"), "event_timestamp")
    chosen = jn.rows_of_first(f.flights, picks, "flight_id", [F.desc("event_timestamp"), F.asc("flight_id")])
    return chosen.select("aircraft_msn", "flight_id", "event_timestamp", "engine_1_temp")


@query("join_right_rate", f"""SELECT f.aircraft_msn, {RA('100.0 * COUNT(DISTINCT a.anomaly_id) / COUNT(DISTINCT f.flight_id)', 'anomaly_rate')}
    FROM anomalies a RIGHT JOIN flights f ON a.flight_id = f.flight_id GROUP BY f.aircraft_msn""")
def _(f):
    return ag.anomaly_rate(f.flights, f.anomalies, "flight_id", "anomaly_id", ["aircraft_msn"])


@query("join_cross_calendar", f"""SELECT c.component_type, {S('d.date', 'date')}, COUNT(*) AS n FROM components c,
    (SELECT CAST(unnest(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM usage) d
    GROUP BY c.component_type, d.date""")
def _(f):
    grid = jn.cross_calendar(f.components.select("component_id", "component_type"), F.min("date"), F.max("date"), f.usage)
    return grid.groupBy("component_type", "date").agg(F.count("*").alias("n"))


@query("join_asof_strict", f"""SELECT aircraft_msn, component_id, {S('day', 'day')}, COALESCE(CAST(day - before AS BIGINT), 365) AS days_since FROM
    (SELECT r.aircraft_msn, r.component_id, r.day, MAX(e.day) AS before FROM
        (SELECT DISTINCT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS day FROM alerts) r
        LEFT JOIN (SELECT DISTINCT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS day FROM maint) e
        ON e.aircraft_msn = r.aircraft_msn AND e.component_id = r.component_id AND e.day < r.day GROUP BY ALL)""")
def _(f):
    day = F.to_date("event_timestamp").alias("day")
    return jn.days_since_last(f.alerts.select(*PART, day).distinct(), f.maint.select(*PART, day), PART, "day", "day", "days_since")


@query("join_lookahead_exists", f"""SELECT r.aircraft_msn, r.component_id, {S('r.day', 'day')}, EXISTS (SELECT 1 FROM maint e
    WHERE e.event_type = 'FAILURE' AND NOT e.is_scheduled AND e.aircraft_msn = r.aircraft_msn AND e.component_id = r.component_id
    AND CAST(e.event_timestamp AS DATE) > r.day AND CAST(e.event_timestamp AS DATE) <= r.day + 7) AS failure_next_7d FROM
    (SELECT DISTINCT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS day FROM alerts) r""")
def _(f):
    day = F.to_date("event_timestamp").alias("day")
    failed = f.maint.filter("event_type = 'FAILURE' AND NOT is_scheduled").select(*PART, day)
    return jn.event_ahead(f.alerts.select(*PART, day).distinct(), failed, PART, "day", "day", "failure_next_7d")


_MODS = {"mods": "SELECT component_id, event_timestamp AS modification_date FROM maint WHERE event_type = 'MODIFICATION'"}


@query("join_before_after", f"""SELECT *, {R('CASE WHEN mtbf_hours_before <> 0 THEN (mtbf_hours_after - mtbf_hours_before) / mtbf_hours_before * 100 END')}
    AS improvement FROM (SELECT r.component_type, {RA('AVG(r.mtbf_hours) FILTER (WHERE r.calculation_timestamp < m.modification_date)', 'mtbf_hours_before')},
    {RA('AVG(r.mtbf_hours) FILTER (WHERE r.calculation_timestamp >= m.modification_date)', 'mtbf_hours_after')},
    {RA('AVG(r.failure_rate_per_1000_hours) FILTER (WHERE r.calculation_timestamp < m.modification_date) / 1000', 'failure_rate_before')},
    {RA('AVG(r.failure_rate_per_1000_hours) FILTER (WHERE r.calculation_timestamp >= m.modification_date) / 1000', 'failure_rate_after')}
    FROM rel_hist r JOIN mods m ON m.component_id = r.component_id GROUP BY r.component_type
    HAVING COUNT(*) FILTER (WHERE r.calculation_timestamp < m.modification_date) > 0
       AND COUNT(*) FILTER (WHERE r.calculation_timestamp >= m.modification_date) > 0)""", _MODS)
def _(f):
    mods = f.maint.filter("event_type = 'MODIFICATION'").select("component_id", F.col("event_timestamp").alias("modification_date"))
    both = jn.split_before_after(
        f.rel_hist, mods, "component_id", "calculation_timestamp", "modification_date", ["mtbf_hours", "failure_rate_per_1000_hours"], ["component_type"]
    ).filter("pairs_before > 0 AND pairs_after > 0")
    before, after = F.round("mtbf_hours_before", 6), F.round("mtbf_hours_after", 6)
    return both.select(
        "component_type", "mtbf_hours_before", "mtbf_hours_after",
        (F.col("failure_rate_per_1000_hours_before") / 1000).alias("failure_rate_before"),
        (F.col("failure_rate_per_1000_hours_after") / 1000).alias("failure_rate_after"),
        F.when(before != 0, (after - before) / before * 100).alias("improvement"),
    )


@query("join_latest", f"""SELECT r.component_id, {S('r.calculation_timestamp', 'calculation_timestamp')}, r.total_failures, {RA('r.mtbf_hours', 'mtbf_hours')}
    FROM rel_hist r JOIN (SELECT component_id, MAX(calculation_timestamp) AS t FROM rel_hist GROUP BY 1) l
    ON l.component_id = r.component_id AND l.t = r.calculation_timestamp""")
def _(f):
    return jn.latest_per_key(f.rel_hist, ["component_id"], "calculation_timestamp").select("component_id", "calculation_timestamp", "total_failures", "mtbf_hours")


# ---- ordered computations


@query("win_intervals", f"""SELECT aircraft_msn, component_id, {S('start_date', 'start_date')}, {S('end_date', 'end_date')}, interval_days FROM sched_intervals""")
def _(f):
    return wn.day_intervals(f.maint.filter("is_scheduled"), PART, "event_timestamp")


@query("win_intervals_all", f"""SELECT aircraft_msn, component_id, event_type, is_scheduled, {S('start_date', 'start_date')}, {S('end_date', 'end_date')},
    interval_days, event_type = 'FAILURE' AND NOT is_scheduled AS is_failure FROM event_intervals""")
def _(f):
    spans = wn.event_intervals(f.maint, PART, "event_timestamp", ["event_type", "is_scheduled"])
    return spans.withColumn("is_failure", (F.col("event_type") == "FAILURE") & ~F.col("is_scheduled"))


@query("win_ffill_bfill", f"""SELECT aircraft_msn, {S('date', 'date')}, {R('''COALESCE(
    LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY aircraft_msn ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    FIRST_VALUE(v IGNORE NULLS) OVER (PARTITION BY aircraft_msn ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)''')} AS v
    FROM (SELECT aircraft_msn, date, CASE WHEN takeoffs > 1 THEN flight_hours END AS v FROM usage)""")
def _(f):
    gaps = f.usage.select("aircraft_msn", "date", F.when(F.col("takeoffs") > 1, F.col("flight_hours")).alias("v"))
    return wn.fill_gaps(gaps, ["aircraft_msn"], "date", ["v"])


@query("win_topk_per_group", f"""SELECT {S('calculation_timestamp', 'calculation_timestamp')}, component_id, {RA('failure_rate_per_1000_hours', 'failure_rate')}, rank FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY calculation_timestamp ORDER BY ROUND(failure_rate_per_1000_hours, 6) DESC NULLS LAST, component_id) AS rank FROM rel_hist)
    WHERE rank <= 5""")
def _(f):
    order = [F.round("failure_rate_per_1000_hours", 6).desc_nulls_last(), F.asc("component_id")]
    best = wn.top_k(f.rel_hist, ["calculation_timestamp"], order, 5)
    return best.select("calculation_timestamp", "component_id", F.col("failure_rate_per_1000_hours").alias("failure_rate"), "rank")
