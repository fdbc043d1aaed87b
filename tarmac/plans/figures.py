"""Aggregations: sensor statistics, reliability, performance, maintenance and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from ..operators import aggregates as ag
from ..operators import maintenance as mnt
from ..operators import performance as pf
from ..operators import reliability as rel
from ..operators import windows as wn
from ..sources.schemas import ABNORMAL_PARAMETERS
from .registry import R, RA, S, query
from .selection import AS_OF

SENSORS = ["engine_1_temp", "engine_2_temp", "engine_1_pressure", "engine_2_pressure", "engine_1_vibration", "engine_2_vibration", "fuel_flow_rate"]
DEVIATING = ["engine_1_temp", "engine_2_temp", "engine_1_vibration", "engine_2_vibration"]
HEADLINE = ["engine_1_temp", "engine_2_temp", "fuel_flow_rate"]
PERIODS = (7, 30, 90)


def avgs(cols, prefix="avg_"):
    return ", ".join(RA(f"AVG({c})", f"{prefix}{c}") for c in cols)


def devs(cols):
    return ", ".join(RA(f"STDDEV_SAMP({c})", f"stddev_{c}") for c in cols)


def since(column, days):
    return f"{column} >= DATE '{AS_OF}' - INTERVAL {days} DAY AND {column} < DATE '{AS_OF}' + INTERVAL 1 DAY"


def per_period(select):
    """UNION of one SELECT per lookback period; ``{p}`` is its length."""
    return " UNION ALL ".join(select(p) for p in PERIODS)


# ---- sensor, usage, maintenance and alert statistics


@query("agg_flight_stats", f"""SELECT f.aircraft_msn, f.flight_id, a.airline_code, {avgs(SENSORS)}, {devs(DEVIATING)}, COUNT(*) AS data_points
    FROM flights f LEFT JOIN aircraft a ON a.aircraft_msn = f.aircraft_msn GROUP BY ALL""")
def _(f):
    return ag.flight_stats(f.flights, f.aircraft.select("aircraft_msn", "airline_code"))


@query("agg_aircraft_stats", f"""SELECT f.aircraft_msn, a.airline_code, {avgs(HEADLINE)}, COUNT(f.flight_id) AS data_points,
    COUNT(DISTINCT f.flight_id) AS flight_count FROM flights f LEFT JOIN aircraft a ON a.aircraft_msn = f.aircraft_msn GROUP BY ALL""")
def _(f):
    return ag.aircraft_stats(f.flights, f.aircraft.select("aircraft_msn", "airline_code"))


@query("agg_airline_stats", f"""SELECT a.airline_code, {avgs(HEADLINE)}, COUNT(f.flight_id) AS data_points, COUNT(DISTINCT f.aircraft_msn) AS aircraft_count
    FROM flights f LEFT JOIN aircraft a ON a.aircraft_msn = f.aircraft_msn GROUP BY ALL""")
def _(f):
    return ag.airline_stats(f.flights, f.aircraft.select("aircraft_msn", "airline_code"), "airline_code")


@query("agg_flight_daily", f"""SELECT aircraft_msn, flight_id, {S('MIN(event_timestamp)', 'start_time')}, {S('MAX(event_timestamp)', 'end_time')},
    {avgs([*SENSORS, 'altitude', 'speed'])}, {RA('MAX(altitude)', 'max_altitude')}, {RA('MAX(speed)', 'max_speed')}, {devs(DEVIATING[:2])}
    FROM (SELECT *, engine_1_temp * 10 AS altitude, fuel_flow_rate * 10 AS speed FROM flights) GROUP BY ALL""")
def _(f):
    return ag.flight_daily(f.flights.withColumns({"altitude": F.col("engine_1_temp") * 10, "speed": F.col("fuel_flow_rate") * 10}))


@query("agg_aircraft_daily", f"""SELECT aircraft_msn, COUNT(flight_id) AS data_points, COUNT(DISTINCT flight_id) AS flight_count,
    {avgs([*SENSORS, 'altitude', 'speed'], 'daily_avg_')}, {RA('MAX(altitude)', 'daily_max_altitude')}, {RA('MAX(speed)', 'daily_max_speed')}
    FROM (SELECT *, engine_1_temp * 10 AS altitude, fuel_flow_rate * 10 AS speed FROM flights
          WHERE CAST(event_timestamp AS DATE) = DATE '2000-03-15') GROUP BY ALL""")
def _(f):
    day = f.flights.filter(cal.on_day("event_timestamp", "2000-03-15"))
    return ag.aircraft_daily(day.withColumns({"altitude": F.col("engine_1_temp") * 10, "speed": F.col("fuel_flow_rate") * 10}))


@query("agg_usage_totals", f"""SELECT aircraft_msn, CAST(SUM(takeoffs) AS BIGINT) AS total_takeoffs, CAST(SUM(landings) AS BIGINT) AS total_landings,
    {RA('SUM(flight_hours)', 'total_flight_hours')}, CAST(SUM(takeoffs * 2) AS BIGINT) AS total_apu_cycles, {RA('SUM(flight_hours / 4)', 'total_apu_hours')}
    FROM usage GROUP BY aircraft_msn""")
def _(f):
    return ag.usage_totals(f.usage.withColumns({"apu_cycles": F.col("takeoffs") * 2, "apu_hours": F.col("flight_hours") / 4}))


@query("agg_maintenance_counts", f"""SELECT aircraft_msn, component_id, COUNT(*) AS event_count, {RA('SUM(duration_hours)', 'total_maintenance_hours')},
    COUNT(*) FILTER (WHERE is_scheduled) AS scheduled_events, COUNT(*) FILTER (WHERE NOT is_scheduled) AS unscheduled_events,
    COUNT(*) FILTER (WHERE event_type = 'REPAIR') AS repair_events, COUNT(*) FILTER (WHERE event_type = 'INSPECTION') AS inspection_events
    FROM maint GROUP BY aircraft_msn, component_id""")
def _(f):
    return ag.maintenance_counts(f.maint)


@query("agg_alert_counts", """SELECT aircraft_msn, component_id, COUNT(*) AS total_alerts, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
    COUNT(*) FILTER (WHERE severity = 'WARNING') AS warning_alerts, COUNT(*) FILTER (WHERE severity = 'INFO') AS info_alerts
    FROM alerts GROUP BY aircraft_msn, component_id""")
def _(f):
    return ag.alert_counts(f.alerts)


@query("agg_cond_filter", """SELECT event_type, COUNT(*) AS events, COUNT(*) FILTER (WHERE NOT is_scheduled) AS unscheduled,
    COUNT(CASE WHEN duration_hours > 40 THEN 1 END) AS long_events FROM maint GROUP BY event_type""")
def _(f):
    return f.maint.groupBy("event_type").agg(
        F.count("*").alias("events"), num.count_where(~F.col("is_scheduled")).alias("unscheduled"),
        F.count(F.when(F.col("duration_hours") > 40, 1)).alias("long_events"),
    )


# ---- reliability

_PERIOD_COLS = lambda p: f"'{p}d' AS period, CAST(CAST(DATE '{AS_OF}' - INTERVAL {p} DAY AS DATE) AS VARCHAR) AS start_date, '{AS_OF}' AS end_date"


def _component_sql(p):
    return f"""SELECT c.component_id, c.component_name, c.component_type, {_PERIOD_COLS(p)}, {RA('h.hours', 'total_flight_hours')}, h.cycles AS total_cycles,
        COALESCE(m.n, 0) AS total_failures, COALESCE(m.u, 0) AS unscheduled_failures, COALESCE(a.n, 0) AS total_alerts, COALESCE(a.c, 0) AS critical_alerts,
        {R('CASE WHEN COALESCE(m.n, 0) > 0 THEN h.hours / m.n END')} AS mtbf_hours,
        {R('CASE WHEN h.hours > 0 THEN COALESCE(m.n, 0) * 1000 / h.hours END')} AS failure_rate_per_1000_hours
        FROM components c
        LEFT JOIN (SELECT aircraft_msn, SUM(flight_hours) AS hours, CAST(SUM(takeoffs) AS BIGINT) AS cycles FROM usage WHERE {since('date', p)} GROUP BY 1) h
          ON h.aircraft_msn = c.aircraft_msn
        LEFT JOIN (SELECT component_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_scheduled) AS u FROM maint
                   WHERE event_type = 'FAILURE' AND {since('event_timestamp', p)} GROUP BY 1) m ON m.component_id = c.component_id
        LEFT JOIN (SELECT component_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS c FROM alerts
                   WHERE {since('event_timestamp', p)} GROUP BY 1) a ON a.component_id = c.component_id"""


@query("rel_component", per_period(_component_sql))
def _(f):
    return rel.component_reliability(f.maint, f.alerts, f.usage, f.components, AS_OF)


def _system_sql(p):
    return f"""SELECT m.component_type, {_PERIOD_COLS(p)}, m.k AS component_count, m.n AS total_failures, m.u AS unscheduled_failures,
        COALESCE(a.n, 0) AS total_alerts, COALESCE(a.c, 0) AS critical_alerts FROM
        (SELECT component_type, COUNT(DISTINCT maint.component_id) AS k, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_scheduled) AS u
         FROM maint JOIN components USING (component_id) WHERE event_type = 'FAILURE' AND {since('event_timestamp', p)} GROUP BY 1) m
        LEFT JOIN (SELECT component_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS c
                   FROM alerts JOIN components USING (component_id) WHERE {since('event_timestamp', p)} GROUP BY 1) a
          ON a.component_type = m.component_type"""


@query("rel_system", per_period(_system_sql))
def _(f):
    return rel.system_reliability(f.maint, f.alerts, f.usage, f.components, AS_OF)


@query("rel_component_total", f"""SELECT c.component_id, c.aircraft_msn, COALESCE(m.n, 0) AS total_failures, COALESCE(m.u, 0) AS unscheduled_failures,
    COALESCE(a.n, 0) AS total_alerts, COALESCE(a.c, 0) AS critical_alerts, {RA('h.hours', 'total_flight_hours')}, h.cycles AS total_cycles,
    {R('CASE WHEN COALESCE(m.n, 0) > 0 THEN h.hours / m.n END')} AS mtbf_hours,
    {R('CASE WHEN h.hours > 0 THEN COALESCE(m.n, 0) * 1000 / h.hours END')} AS failure_rate_per_1000_hours
    FROM components c JOIN (SELECT aircraft_msn, SUM(flight_hours) AS hours, CAST(SUM(takeoffs) AS BIGINT) AS cycles FROM usage GROUP BY 1) h
      ON h.aircraft_msn = c.aircraft_msn
    LEFT JOIN (SELECT component_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_scheduled) AS u FROM maint WHERE event_type = 'FAILURE' GROUP BY 1) m
      ON m.component_id = c.component_id
    LEFT JOIN (SELECT component_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS c FROM alerts GROUP BY 1) a
      ON a.component_id = c.component_id""")
def _(f):
    return rel.component_reliability_total(f.maint, f.alerts, f.usage, f.components)


_PARTS = {
    "worked_on": """SELECT aircraft_msn, component_id, COUNT(*) AS total_maintenance_events, COUNT(*) FILTER (event_type = 'REPAIR') AS total_repairs,
        COUNT(*) FILTER (event_type = 'INSPECTION') AS total_inspections, COUNT(*) FILTER (NOT is_scheduled) AS total_unscheduled FROM maint GROUP BY ALL""",
    "alerted": """SELECT aircraft_msn, component_id, COUNT(*) AS total_alerts, COUNT(*) FILTER (severity = 'CRITICAL') AS critical_alerts,
        COUNT(*) FILTER (severity = 'WARNING') AS warning_alerts FROM alerts GROUP BY ALL""",
    # parts with work and their alerts; parts with alerts only where their aircraft has no work at all
    "parts": """SELECT * FROM worked_on LEFT JOIN alerted USING (aircraft_msn, component_id)
        UNION ALL BY NAME SELECT * FROM alerted WHERE aircraft_msn NOT IN (SELECT aircraft_msn FROM worked_on)""",
    "flown": """SELECT aircraft_msn, SUM(flight_hours) AS hours, CAST(SUM(takeoffs) AS BIGINT) AS takeoffs, CAST(SUM(landings) AS BIGINT) AS landings,
        MIN(date) AS first_date, MAX(date) AS last_date FROM usage GROUP BY ALL""",
}
_PART_COUNTS = ("total_maintenance_events", "total_repairs", "total_inspections", "total_unscheduled", "total_alerts", "critical_alerts", "warning_alerts")


@query("rel_aircraft_component", f"""SELECT aircraft_msn, component_id, {RA('hours', 'total_flight_hours')}, takeoffs AS total_takeoffs, landings AS total_landings,
    {S('first_date', 'first_date')}, {S('last_date', 'last_date')}, {', '.join(f'COALESCE({c}, 0) AS {c}' for c in _PART_COUNTS)},
    {R('CASE WHEN hours > 0 THEN hours / NULLIF(total_repairs, 0) END')} AS mtbf_hours, CASE WHEN takeoffs > 0 THEN takeoffs // NULLIF(total_repairs, 0) END AS mtbf_cycles,
    {R('COALESCE(total_unscheduled, 0) * 1000 / CASE WHEN hours > 0 THEN hours END')} AS unscheduled_removal_rate FROM parts JOIN flown USING (aircraft_msn)""", _PARTS)
def _(f):
    return rel.aircraft_component_reliability(f.usage, f.maint, f.alerts)


def _weekly_sql(p):
    return f"""SELECT x.component_id, {_PERIOD_COLS(p)}, x.failures, COALESCE(h.hours, 0.0) AS flight_hours,
        COALESCE(h.hours, 0.0) / GREATEST(1, x.failures) AS mtbf, x.failures * 1000 / GREATEST(1.0, COALESCE(h.hours, 0.0)) AS failure_rate
        FROM (SELECT component_id, COUNT(*) AS failures FROM maint WHERE NOT is_scheduled AND {since('event_timestamp', p)} GROUP BY 1) x
        LEFT JOIN (SELECT d.component_id, SUM(u.flight_hours) AS hours FROM
                   (SELECT DISTINCT component_id, aircraft_msn FROM maint WHERE {since('event_timestamp', p)}) d
                   JOIN usage u ON u.aircraft_msn = d.aircraft_msn WHERE {since('u.date', p)} GROUP BY 1) h ON h.component_id = x.component_id"""


_WEEKLY = {"weekly": per_period(_weekly_sql)}


@query("rel_weekly", f"""SELECT component_id, period, start_date, end_date, failures, {RA('flight_hours', 'flight_hours')}, {RA('mtbf', 'mtbf')},
    {RA('failure_rate', 'failure_rate')} FROM weekly""", _WEEKLY)
def _(f):
    return rel.weekly_reliability(f.maint, f.usage, AS_OF)


@query("rpt_reliability", f"""SELECT t.*, b.top_reliable, w.top_unreliable FROM
    (SELECT period, start_date, end_date, COUNT(*) AS total_components_analyzed, CAST(SUM(failures) AS BIGINT) AS total_failures,
            {RA('SUM(flight_hours)', 'total_flight_hours')}, {RA('AVG(mtbf)', 'average_mtbf')}, {RA('AVG(failure_rate)', 'average_failure_rate')}
     FROM weekly GROUP BY ALL) t
    JOIN (SELECT period, string_agg(CAST(component_id AS VARCHAR), ',' ORDER BY rank) AS top_reliable FROM
          (SELECT *, ROW_NUMBER() OVER (PARTITION BY period ORDER BY mtbf DESC, component_id) AS rank FROM weekly) WHERE rank <= 5 GROUP BY 1) b USING (period)
    JOIN (SELECT period, string_agg(CAST(component_id AS VARCHAR), ',' ORDER BY rank) AS top_unreliable FROM
          (SELECT *, ROW_NUMBER() OVER (PARTITION BY period ORDER BY failure_rate DESC, component_id) AS rank FROM weekly) WHERE rank <= 5 GROUP BY 1) w
      USING (period)""", _WEEKLY)
def _(f):
    report = rel.reliability_report(rel.weekly_reliability(f.maint, f.usage, AS_OF))
    ids = lambda c: F.array_join(F.transform(c, lambda s: s.component_id.cast("string")), ",")
    return report.select(
        "period", "start_date", "end_date", "total_components_analyzed", "total_failures", "total_flight_hours", "average_mtbf", "average_failure_rate",
        ids("top_reliable_components").alias("top_reliable"), ids("top_unreliable_components").alias("top_unreliable"),
    )


# ---- performance

_PERF_DOUBLES = [
    "total_flight_hours", "avg_daily_flight_hours", "total_maintenance_hours", "avg_engine_1_temp", "avg_engine_2_temp", "avg_fuel_flow_rate",
    "stddev_engine_1_vibration", "stddev_engine_2_vibration", "maintenance_events_per_flight_hour", "alerts_per_flight_hour", "unscheduled_maintenance_ratio",
]


@query("perf_aircraft", f"""SELECT aircraft_msn, airline_code, total_takeoffs, total_landings, total_maintenance_events, unscheduled_maintenance_events,
    total_alerts, critical_alerts, warning_alerts, {', '.join(RA(c, c) for c in _PERF_DOUBLES)} FROM perf""")
def _(f):
    return f.perf


@query("perf_monthly_aircraft", f"""SELECT aircraft_msn, {S("CAST(DATE_TRUNC('month', d) AS DATE)", 'month')}, COUNT(d) AS days_with_flights,
    CAST(SUM(flights_count) AS BIGINT) AS total_flights, {RA('SUM(flight_hours)', 'total_flight_hours')}, CAST(SUM(takeoffs) AS BIGINT) AS total_takeoffs,
    CAST(SUM(landings) AS BIGINT) AS total_landings, {', '.join(RA(f'AVG(avg_{c})', f'monthly_avg_{c}') for c in SENSORS)},
    {RA('SUM(fuel)', 'monthly_fuel_consumption')}, {RA('AVG(duration)', 'monthly_avg_flight_duration')},
    {R('CASE WHEN SUM(flight_hours) > 0 THEN SUM(fuel) / SUM(flight_hours) END')} AS fuel_efficiency,
    {R('CASE WHEN SUM(takeoffs) > 0 THEN SUM(flight_hours) / SUM(takeoffs) END')} AS utilization_efficiency
    FROM (SELECT x.*, u.flight_hours, u.takeoffs, u.landings, CASE WHEN u.flight_hours > 0 THEN x.avg_fuel_flow_rate * u.flight_hours END AS fuel,
                 CASE WHEN u.takeoffs > 0 THEN u.flight_hours / u.takeoffs END AS duration
          FROM (SELECT aircraft_msn, CAST(event_timestamp AS DATE) AS d, COUNT(DISTINCT flight_id) AS flights_count,
                       {', '.join(f'AVG({c}) AS avg_{c}' for c in SENSORS)} FROM flights GROUP BY ALL) x
          LEFT JOIN usage u ON u.aircraft_msn = x.aircraft_msn AND u.date = x.d)
    GROUP BY ALL""")
def _(f):
    return pf.monthly_aircraft_performance(f.flights, f.usage)


def _in_month(column):
    return f"{column} >= DATE '2000-05-01' AND {column} < DATE '2000-06-01'"


@query("perf_airline_month", f"""SELECT h.airline_code, 2000 AS year, 5 AS month, {RA('h.hours', 'total_flight_hours')}, h.cycles AS total_cycles,
    COALESCE(m.n, 0) AS total_maintenance_events, COALESCE(m.u, 0) AS total_unscheduled_maintenance, COALESCE(a.n, 0) AS total_alerts,
    COALESCE(a.c, 0) AS critical_alerts, {R('COALESCE(m.n, 0) / GREATEST(1, h.hours)')} AS maintenance_per_flight_hour,
    {R('COALESCE(m.u, 0) / GREATEST(1, COALESCE(m.n, 0))')} AS unscheduled_ratio, {R('COALESCE(a.n, 0) / GREATEST(1, h.hours)')} AS alerts_per_flight_hour
    FROM (SELECT airline_code, SUM(flight_hours) AS hours, CAST(SUM(takeoffs) AS BIGINT) AS cycles FROM usage JOIN aircraft USING (aircraft_msn)
          WHERE {_in_month('date')} GROUP BY 1) h
    LEFT JOIN (SELECT airline_code, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_scheduled) AS u FROM maint JOIN aircraft USING (aircraft_msn)
               WHERE {_in_month('event_timestamp')} GROUP BY 1) m USING (airline_code)
    LEFT JOIN (SELECT airline_code, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS c FROM alerts JOIN aircraft USING (aircraft_msn)
               WHERE {_in_month('event_timestamp')} GROUP BY 1) a USING (airline_code)""")
def _(f):
    return pf.airline_month(f.usage, f.maint, f.alerts, f.aircraft, "2000-06-10")


@query("perf_aircraft_month", f"""SELECT h.aircraft_msn, x.airline_code, 2000 AS year, 5 AS month, {RA('h.hours', 'total_flight_hours')}, h.cycles AS total_cycles,
    {RA('COALESCE(s.fuel, 0)', 'avg_fuel_flow')}, {RA('COALESCE(s.t1, 0)', 'avg_engine_1_temp')}, {RA('COALESCE(s.t2, 0)', 'avg_engine_2_temp')},
    COALESCE(m.n, 0) AS total_maintenance_events, COALESCE(m.u, 0) AS total_unscheduled_maintenance, COALESCE(a.n, 0) AS total_alerts,
    {R('COALESCE(s.fuel, 0) / GREATEST(1, h.hours)')} AS fuel_efficiency, {R('COALESCE(m.n, 0) / GREATEST(1, h.hours)')} AS maintenance_per_flight_hour
    FROM (SELECT aircraft_msn, SUM(flight_hours) AS hours, CAST(SUM(takeoffs) AS BIGINT) AS cycles FROM usage WHERE {_in_month('date')} GROUP BY 1) h
    JOIN aircraft x USING (aircraft_msn)
    LEFT JOIN (SELECT aircraft_msn, AVG(fuel) AS fuel, AVG(t1) AS t1, AVG(t2) AS t2 FROM
               (SELECT aircraft_msn, CAST(event_timestamp AS DATE) AS d, AVG(fuel_flow_rate) AS fuel, AVG(engine_1_temp) AS t1, AVG(engine_2_temp) AS t2
                FROM flights WHERE {_in_month('event_timestamp')} GROUP BY 1, 2) GROUP BY 1) s USING (aircraft_msn)
    LEFT JOIN (SELECT aircraft_msn, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_scheduled) AS u FROM maint WHERE {_in_month('event_timestamp')} GROUP BY 1) m
      USING (aircraft_msn)
    LEFT JOIN (SELECT aircraft_msn, COUNT(*) AS n FROM alerts WHERE {_in_month('event_timestamp')} GROUP BY 1) a USING (aircraft_msn)""")
def _(f):
    return pf.aircraft_month(f.usage, f.flights, f.maint, f.alerts, f.aircraft, "2000-06-10")


# ---- maintenance

_ANALYSIS = {
    "component_steps": """SELECT m.component_id, c.aircraft_msn, m.event_timestamp AS cur, m.is_scheduled,
        LAG(m.event_timestamp) OVER (PARTITION BY m.component_id ORDER BY m.event_timestamp) AS prev
        FROM maint m JOIN components c ON c.component_id = m.component_id""",
    "daily_pairs": """SELECT DISTINCT aircraft_msn, CAST(prev AS DATE) AS a, CAST(cur AS DATE) AS b FROM component_steps WHERE prev IS NOT NULL""",
    "pair_hours": """SELECT p.aircraft_msn, p.a, p.b, SUM(u.flight_hours) AS hours FROM daily_pairs p
        JOIN usage u ON u.aircraft_msn = p.aircraft_msn AND u.date BETWEEN p.a AND p.b GROUP BY ALL""",
    "analysis": """SELECT c.component_id, c.component_name, c.aircraft_msn, c.recommended_maintenance_interval, s.total_maintenance_events,
        s.unscheduled_maintenance_count, s.avg_actual_interval_days, s.avg_flight_hours_between_maintenance, COALESCE(a.n, 0) AS alert_count
        FROM (SELECT t.component_id, COUNT(*) AS total_maintenance_events, COUNT(*) FILTER (WHERE NOT t.is_scheduled) AS unscheduled_maintenance_count,
                     AVG(date_diff('microsecond', t.prev, t.cur) // 86400000000) AS avg_actual_interval_days,
                     AVG(COALESCE(h.hours, 0)) FILTER (WHERE t.prev IS NOT NULL) AS avg_flight_hours_between_maintenance
              FROM component_steps t LEFT JOIN pair_hours h ON h.aircraft_msn = t.aircraft_msn AND h.a = CAST(t.prev AS DATE) AND h.b = CAST(t.cur AS DATE)
              GROUP BY 1) s JOIN components c ON c.component_id = s.component_id
        LEFT JOIN (SELECT component_id, COUNT(*) AS n FROM alerts GROUP BY 1) a ON a.component_id = c.component_id
        WHERE s.total_maintenance_events > 1""",
    "analysis_risk": """SELECT *, (unscheduled_maintenance_count * 2 + alert_count) / GREATEST(1, total_maintenance_events) AS risk_score FROM analysis""",
    "analysis_optimal": """SELECT *, recommended_maintenance_interval *
        CAST(CASE WHEN risk_score > 0.5 THEN 0.8 WHEN risk_score > 0.2 THEN 1.0 ELSE 1.1 END AS DOUBLE) AS optimal_interval_days,
        avg_flight_hours_between_maintenance / GREATEST(1, avg_actual_interval_days) AS per_day FROM analysis_risk""",
}


def _analysed(f):
    f.store("components", "maint", "usage")
    return mnt.component_analysis(f.maint, f.usage, f.alerts, f.components)


@query("mnt_component_analysis", f"""SELECT component_id, component_name, aircraft_msn, recommended_maintenance_interval, total_maintenance_events,
    unscheduled_maintenance_count, alert_count, {RA('avg_actual_interval_days', 'avg_actual_interval_days')},
    {RA('avg_flight_hours_between_maintenance', 'avg_flight_hours_between_maintenance')} FROM analysis""", _ANALYSIS)
def _(f):
    return _analysed(f)


@query("mnt_recommend_dag", f"""SELECT component_id, {RA('risk_score', 'risk_score')}, {RA('optimal_interval_days', 'optimal_interval_days')},
    {R('CASE WHEN avg_flight_hours_between_maintenance > 0 THEN optimal_interval_days * per_day END')} AS optimal_flight_hours,
    CASE WHEN risk_score > 0.5 THEN 'REDUCE_INTERVAL' WHEN risk_score > 0.2 THEN 'MAINTAIN_INTERVAL' ELSE 'EXTEND_INTERVAL' END AS recommendation
    FROM analysis_optimal""", _ANALYSIS)
def _(f):
    out = mnt.recommend_from_analysis(_analysed(f))
    return out.select("component_id", "risk_score", "optimal_interval_days", "optimal_flight_hours", "recommendation")


def _interval_sql(by, spread=""):
    return f"""SELECT {by}, {RA('AVG(interval_days)', 'mean_interval')}, {RA('STDDEV_SAMP(interval_days)', 'std_interval')}, COUNT(*) AS count,
        {RA('AVG(recommended_interval)', 'mean_recommended_interval')}, {RA('AVG(interval_ratio)', 'mean_interval_ratio')},
        COUNT(*) FILTER (WHERE is_failure) AS failures, CAST(SUM(unscheduled_failures) AS BIGINT) AS unscheduled_failures {spread}
        FROM interval_history GROUP BY {by}"""


@query("mnt_type_analysis", _interval_sql("component_type", f""", MIN(interval_days) AS min_interval, MAX(interval_days) AS max_interval,
    CAST(SUM(total_alerts) AS BIGINT) AS total_alerts, CAST(SUM(critical_alerts) AS BIGINT) AS critical_alerts,
    {R('COUNT(*) FILTER (WHERE is_failure) / (AVG(interval_days) * COUNT(*)) * 1000')} AS failure_rate_per_1000_days"""))
def _(f):
    return mnt.interval_analysis(mnt.interval_history(f.maint, f.components, f.aircraft, f.alerts), "component_type", spread=True)


@query("mnt_airline_analysis", _interval_sql("airline_code"))
def _(f):
    return mnt.interval_analysis(mnt.interval_history(f.maint, f.components, f.aircraft, f.alerts), "airline_code")


@query("mnt_manufacturer_analysis", _interval_sql("manufacturer"))
def _(f):
    return mnt.interval_analysis(mnt.interval_history(f.maint, f.components, f.aircraft, f.alerts), "manufacturer")


@query("mnt_interval_features", f"""SELECT aircraft_msn, component_id, {S('start_date', 'start_date')}, {S('end_date', 'end_date')}, interval_days,
    {RA('flight_hours_in_interval', 'flight_hours_in_interval')}, takeoffs_in_interval, landings_in_interval, unscheduled_failures_in_interval,
    alerts_in_interval, critical_alerts_in_interval FROM interval_features""")
def _(f):
    f.store("components", "maint")
    return mnt.interval_features(f.maint, f.usage, f.alerts)


@query("mnt_failure_risk", f"""SELECT 'hours' AS basis, component_id, {S('end_date', 'end_date')}, {RA('failure_risk', 'failure_risk')} FROM interval_risk
    UNION ALL SELECT 'days', component_id, CAST(CAST(end_date AS DATE) AS VARCHAR), {R('failure_risk')} FROM interval_history""")
def _(f):
    f.store("components", "maint", "alerts")
    hours = mnt.interval_risk(mnt.interval_features(f.maint, f.usage, f.alerts), f.components)
    days = mnt.interval_history(f.maint, f.components, f.aircraft, f.alerts)
    pick = lambda df, basis: df.select(F.lit(basis).alias("basis"), "component_id", F.to_date("end_date").alias("end_date"), "failure_risk")
    return pick(hours, "hours").unionByName(pick(days, "days"))


@query("mnt_recommend", f"""SELECT component_id, component_name, component_type, recommended_maintenance_interval,
    {RA('optimal_interval_days', 'optimal_interval_days')}, {RA('average_failure_risk', 'average_failure_risk')}, total_unscheduled_failures, total_alerts,
    interval_count, recommendation, justification, confidence_score FROM recs""")
def _(f):
    return f.store("components", "maint").recs


# ---- dashboard figures


@query("agg_multi_distinct", f"""SELECT airline_code, COUNT(DISTINCT aircraft_msn) AS aircraft, {RA('AVG(avg_daily_flight_hours)', 'daily_hours')},
    {RA('AVG(maintenance_events_per_flight_hour)', 'maintenance_per_hour')}, {RA('AVG(alerts_per_flight_hour)', 'alerts_per_hour')},
    {RA('AVG(unscheduled_maintenance_ratio)', 'unscheduled_ratio')} FROM perf GROUP BY airline_code""")
def _(f):
    return f.perf.groupBy("airline_code").agg(
        F.count_distinct("aircraft_msn").alias("aircraft"), F.avg("avg_daily_flight_hours").alias("daily_hours"),
        F.avg("maintenance_events_per_flight_hour").alias("maintenance_per_hour"), F.avg("alerts_per_flight_hour").alias("alerts_per_hour"),
        F.avg("unscheduled_maintenance_ratio").alias("unscheduled_ratio"),
    ).orderBy(F.desc("daily_hours"))


@query("agg_type_summary", f"""SELECT component_type, COUNT(DISTINCT component_id) AS components, CAST(SUM(total_failures) AS BIGINT) AS failures,
    CAST(SUM(unscheduled_failures) AS BIGINT) AS unscheduled, {RA('AVG(mtbf_hours)', 'mtbf')}, {RA('AVG(failure_rate_per_1000_hours) / 1000', 'rate')}
    FROM rel_hist GROUP BY component_type""")
def _(f):
    return f.rel_hist.groupBy("component_type").agg(
        F.count_distinct("component_id").alias("components"), F.sum("total_failures").alias("failures"),
        F.sum("unscheduled_failures").alias("unscheduled"), F.avg("mtbf_hours").alias("mtbf"),
        (F.avg("failure_rate_per_1000_hours") / 1000).alias("rate"),
    ).orderBy(F.desc("rate"))


@query("agg_pct_change", f"""SELECT component_type, recommendation, {RA('AVG(recommended_maintenance_interval)', 'avg_recommended_maintenance_interval')},
    {RA('AVG(optimal_interval_days)', 'avg_optimal_interval_days')},
    {R('(AVG(optimal_interval_days) - AVG(recommended_maintenance_interval)) / AVG(recommended_maintenance_interval) * 100')} AS change_pct,
    {RA('AVG(confidence_score)', 'confidence')} FROM recs GROUP BY component_type, recommendation
    UNION ALL SELECT component_type, 'only longer', {R('AVG(recommended_maintenance_interval)')}, {R('AVG(optimal_interval_days)')},
    {R('(AVG(optimal_interval_days) - AVG(recommended_maintenance_interval)) / AVG(recommended_maintenance_interval) * 100')}, {R('AVG(confidence_score)')}
    FROM recs WHERE optimal_interval_days > recommended_maintenance_interval GROUP BY component_type""")
def _(f):
    f.store("components", "maint", "recs")
    extra = {"confidence": F.avg("confidence_score")}
    cols = ("optimal_interval_days", "recommended_maintenance_interval")
    each = ag.mean_change(f.recs, ["component_type", "recommendation"], *cols, extra)
    longer = ag.mean_change(f.recs.filter("optimal_interval_days > recommended_maintenance_interval"), ["component_type"], *cols, extra)
    return each.unionByName(longer.withColumn("recommendation", F.lit("only longer")))


@query("agg_category_counts", """SELECT 'airline' AS chart, CAST(airline_code AS VARCHAR) AS metric, COUNT(*) AS value FROM aircraft GROUP BY 2
    UNION ALL SELECT 'status', status, COUNT(*) FROM aircraft GROUP BY 2
    UNION ALL SELECT 'method', detection_method, COUNT(*) FROM anomalies WHERE confidence_score >= 0.8 GROUP BY 2
    UNION ALL SELECT 'recommendation', recommendation, COUNT(*) FROM recs GROUP BY 2
    UNION ALL SELECT 'event', event_type, COUNT(*) FROM maint GROUP BY 2
    UNION ALL SELECT 'severity', severity, COUNT(*) FROM alerts GROUP BY 2
    UNION ALL SELECT 'failing type', component_type, COUNT(*) FROM maint JOIN components USING (component_id)
        WHERE event_type = 'FAILURE' AND NOT is_scheduled GROUP BY 2""")
def _(f):
    f.store("components", "maint", "alerts")
    failures = f.maint.filter(rel.failure_condition("unscheduled_failure")).groupBy("component_id").agg(F.count("*").alias("n"))
    by_type = failures.join(f.components, "component_id").groupBy(F.col("component_type").alias("metric")).agg(F.sum("n").alias("value"))
    charts = {
        "airline": ag.category_counts(f.aircraft, "airline_code").withColumn("metric", F.col("metric").cast("string")),
        "status": ag.category_counts(f.aircraft, "status"),
        "method": ag.category_counts(f.anomalies.filter("confidence_score >= 0.8"), "detection_method"),
        "recommendation": ag.category_counts(f.recs, "recommendation"),
        "event": ag.category_counts(f.maint, "event_type"),
        "severity": ag.category_counts(f.alerts, "severity"),
        "failing type": by_type,
    }
    out = None
    for name, df in charts.items():
        labelled = df.select(F.lit(name).alias("chart"), "metric", "value")
        out = labelled if out is None else out.unionByName(labelled)
    return out


@query("agg_timeseries", f"""SELECT 'hours' AS chart, {S('CAST(date AS TIMESTAMP)', 'time')}, CAST(airline_code AS VARCHAR) AS metric, {RA('AVG(flight_hours)', 'value')}
    FROM usage JOIN aircraft USING (aircraft_msn) GROUP BY date, airline_code
    UNION ALL SELECT 'anomalies', {S("CAST(DATE_TRUNC('day', detection_timestamp) AS TIMESTAMP)")}, detection_method, CAST(COUNT(*) AS DOUBLE) FROM anomalies
    GROUP BY DATE_TRUNC('day', detection_timestamp), detection_method
    UNION ALL SELECT 'mtbf', {S('calculation_timestamp')}, component_type, {R('AVG(mtbf_hours)')} FROM rel_hist GROUP BY calculation_timestamp, component_type
    UNION ALL SELECT 'rate', {S('calculation_timestamp')}, manufacturer, {R('AVG(failure_rate_per_1000_hours)')} FROM rel_hist
    GROUP BY calculation_timestamp, manufacturer
    UNION ALL SELECT 'takeoffs', {S('CAST(date AS TIMESTAMP)')}, 'all', CAST(SUM(takeoffs) AS DOUBLE) FROM usage GROUP BY date""")
def _(f):
    day, stamp = F.col("date").cast("timestamp"), F.col("calculation_timestamp")
    hours = f.usage.join(f.aircraft, "aircraft_msn")
    charts = {
        "hours": ag.timeseries(hours, day, F.col("airline_code").cast("string"), F.avg("flight_hours")),
        "anomalies": ag.timeseries(f.anomalies, F.date_trunc("day", "detection_timestamp"), F.col("detection_method"), F.count("*").cast("double")),
        "mtbf": ag.timeseries(f.rel_hist, stamp, F.col("component_type"), F.avg("mtbf_hours")),
        "rate": ag.timeseries(f.rel_hist, stamp, F.col("manufacturer"), F.avg("failure_rate_per_1000_hours")),
        "takeoffs": ag.timeseries(f.usage, day, F.lit("all"), F.sum("takeoffs").cast("double")),
    }
    out = None
    for name, df in charts.items():
        labelled = df.select(F.lit(name).alias("chart"), "time", "metric", "value")
        out = labelled if out is None else out.unionByName(labelled)
    return out


def _bucket_sql(unit):
    return f"""SELECT '{unit}' AS unit, aircraft_msn, {S(f"CAST(DATE_TRUNC('{unit}', event_timestamp) AS TIMESTAMP)", 'bucket')},
        {', '.join(RA(f'{s}({m})', f'{m}_{s.lower()}') for m in ('engine_1_temp', 'fuel_flow_rate') for s in ('AVG', 'MIN', 'MAX'))}
        FROM flights WHERE event_timestamp >= DATE '2000-01-01' AND event_timestamp < DATE '2000-07-01' GROUP BY aircraft_msn, DATE_TRUNC('{unit}', event_timestamp)"""


@query("agg_by_interval", " UNION ALL ".join(_bucket_sql(u) for u in ("hour", "day", "week", "month")))
def _(f):
    out = None
    for unit in ("hour", "day", "week", "month"):
        df = ag.by_interval(f.flights, "aircraft_msn", None, "2000-01-01", AS_OF, unit, ["engine_1_temp", "fuel_flow_rate"]).withColumn("unit", F.lit(unit))
        out = df if out is None else out.unionByName(df)
    return out


@query("agg_scalar_kpis", f"""SELECT {RA('AVG(mtbf_hours)', 'mean_mtbf')}, {RA('AVG(failure_rate_per_1000_hours)', 'mean_rate')}, COUNT(*) AS n
    FROM rel_hist WHERE component_type = (SELECT MIN(component_type) FROM components)""")
def _(f):
    first = f.components.agg(F.min("component_type")).scalar()
    return f.rel_hist.filter(F.col("component_type") == first).agg(
        F.avg("mtbf_hours").alias("mean_mtbf"), F.avg("failure_rate_per_1000_hours").alias("mean_rate"), F.count("*").alias("n")
    )


@query("agg_distinct_values", """SELECT 'type' AS selector, component_type AS value FROM components GROUP BY 2
    UNION ALL SELECT 'airline', CAST(airline_code AS VARCHAR) FROM aircraft GROUP BY 2""")
def _(f):
    pick = lambda df, name, c: df.select(F.lit(name).alias("selector"), F.col(c).cast("string").alias("value")).distinct()
    return pick(f.components, "type", "component_type").unionByName(pick(f.aircraft, "airline", "airline_code")).orderBy("selector", "value")


@query("agg_percentile", f"""SELECT aircraft_msn, {RA('MIN(v)', 'threshold')} FROM (SELECT aircraft_msn, engine_1_temp AS v,
    ROW_NUMBER() OVER (PARTITION BY aircraft_msn ORDER BY engine_1_temp) AS rn, COUNT(*) OVER (PARTITION BY aircraft_msn) AS n FROM flights)
    WHERE rn * 100 >= n * 95 GROUP BY aircraft_msn""")
def _(f):
    return wn.group_quantile(f.flights, ["aircraft_msn"], "engine_1_temp", "0.95")


_DEVIATION = {
    "long_samples": "SELECT aircraft_msn, UNNEST(" + str(list(SENSORS)).replace('"', "'") + ") AS parameter, UNNEST([" + ", ".join(SENSORS) + "]) AS v FROM flights",
    "deviating": """SELECT s.aircraft_msn, s.parameter FROM long_samples s JOIN (SELECT aircraft_msn, parameter, AVG(v) AS m, STDDEV_SAMP(v) AS d
        FROM long_samples GROUP BY ALL) t ON t.aircraft_msn = s.aircraft_msn AND t.parameter = s.parameter WHERE t.d > 0 AND abs(s.v - t.m) > 2 * t.d""",
}


@query("agg_json_param_freq", "SELECT parameter AS metric, COUNT(*) AS value FROM deviating GROUP BY 1 ORDER BY value DESC, metric LIMIT 10", _DEVIATION)
def _(f):
    from ..operators import anomaly as an

    marked = an.deviating_parameters(f.flights, ["aircraft_msn"], SENSORS, sigmas=2)
    stored = marked.select(F.to_json("abnormal_parameters").alias("abnormal_parameters"))
    return ag.parameter_frequency(stored, "abnormal_parameters", ABNORMAL_PARAMETERS, 10)


_HISTORY = """SELECT conv_id, turn, CASE WHEN length(text) % 3 = 0 THEN 'TOXIC' ELSE 'OK' END AS decision FROM conversations"""


@query("mod_history_stats", f"""SELECT COUNT(*) AS total_decisions, COUNT(*) FILTER (WHERE decision = 'TOXIC') AS toxic_count,
    COUNT(*) FILTER (WHERE decision = 'OK') AS ok_count, (SELECT string_agg(id, ',' ORDER BY n DESC) FROM
    (SELECT conv_id || '-' || turn AS id, conv_id * 1000 + turn AS n FROM conversations ORDER BY n DESC LIMIT 10)) AS latest FROM ({_HISTORY})""")
def _(f):
    decision = F.when(F.char_length("text") % 3 == 0, "TOXIC").otherwise("OK")
    history = f.table("conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("n"), decision.alias("decision")
    )
    newest = history.orderBy(F.desc("n")).limit(10).agg(F.reverse(F.array_sort(F.collect_list(F.struct("n", "id")))).alias("a"))
    latest = newest.select(F.array_join(F.transform("a", lambda s: s.id), ","))
    return ag.decision_stats(history).withColumn("latest", latest.scalar())
