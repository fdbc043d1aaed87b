"""Projections, filters, scalar functions, sorting and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from ..functions import text as tx
from ..operators import filters, paging
from .registry import R, RA, S, query

AS_OF = "2000-06-30"
FEATURES = ["engine_1_temp", "engine_2_temp", "engine_1_pressure", "engine_2_pressure", "engine_1_vibration", "engine_2_vibration", "fuel_flow_rate"]
# a word list that occurs in the invented prose
LEXICON = ("le", "la", "de", "en", "un", "the", "of", "and", "to", "der", "die", "und", "el", "los", "que", "a", "in")
SQL_LEXICON = "[" + ", ".join(f"'{w}'" for w in LEXICON) + "]"
SQL_CLEAN = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_\s!?.,]', '', 'g')"


def sql_tokens(column: str) -> str:
    return rf"list_filter(regexp_split_to_array({SQL_CLEAN.format(column)}, '\s+'), lambda w: w <> '')"


@query("prj_columns", f"""SELECT aircraft_msn, flight_id, {S('event_timestamp', 'event_timestamp')}, {', '.join(FEATURES)}
    FROM flights""", exact=True)
def _(f):
    return f.flights.select("aircraft_msn", "flight_id", "event_timestamp", *FEATURES)


@query("flt_clean_sensor", f"""SELECT aircraft_msn, flight_id, {RA('engine_1_temp', 'engine_1_temp')}, {RA('fuel_flow_rate', 'fuel_flow_rate')}
    FROM (SELECT *, CASE WHEN engine_1_vibration > 0.01 THEN engine_1_vibration END AS v FROM flights)
    WHERE v IS NOT NULL AND engine_1_temp > 0 AND engine_2_temp > 0 AND fuel_flow_rate > 0""")
def _(f):
    gaps = f.flights.withColumn("v", F.when(F.col("engine_1_vibration") > 0.01, F.col("engine_1_vibration")))
    kept = filters.clean_samples(gaps, [*FEATURES, "v"], ["engine_1_temp", "engine_2_temp", "fuel_flow_rate"])
    return kept.select("aircraft_msn", "flight_id", "engine_1_temp", "fuel_flow_rate")


@query("flt_day", f"""SELECT event_id, {S('ts', 'ts')}, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def _(f):
    return f.table("events").filter(cal.on_day("ts", "2024-01-15")).select("event_id", "ts", "event_type")


_LOOKBACKS = (7, 30, 90, 180, 365)


@query("flt_lookback", " UNION ALL ".join(
    f"""SELECT '{d}d' AS period, COUNT(*) AS events, {R('COALESCE(SUM(duration_hours), 0)')} AS hours FROM maint
    WHERE event_timestamp >= DATE '{AS_OF}' - INTERVAL {d} DAY AND event_timestamp < DATE '{AS_OF}' + INTERVAL 1 DAY""" for d in _LOOKBACKS))
def _(f):
    inside = {d: cal.lookback("event_timestamp", AS_OF, d) for d in _LOOKBACKS}
    one = f.maint.filter(inside[max(_LOOKBACKS)]).agg(
        *[F.count_if(c).alias(f"n{d}") for d, c in inside.items()],
        *[F.coalesce(F.sum(F.when(c, F.col("duration_hours"))), F.lit(0.0)).alias(f"h{d}") for d, c in inside.items()],
    )
    rows = [F.struct(F.lit(f"{d}d").alias("period"), F.col(f"n{d}").alias("events"), F.col(f"h{d}").alias("hours")) for d in _LOOKBACKS]
    return one.select(F.inline(F.array(*rows)))


@query("flt_prev_month", f"""SELECT aircraft_msn, {S('date', 'date')}, {RA('flight_hours', 'flight_hours')} FROM usage
    WHERE date BETWEEN DATE '2000-05-01' AND DATE '2000-05-31'""")
def _(f):
    return f.usage.filter(cal.between_days("date", *cal.previous_month("2000-06-15"))).select("aircraft_msn", "date", "flight_hours")


@query("flt_in_list", """SELECT event_type AS metric, COUNT(*) AS value FROM maint
    WHERE event_type IN ('FAILURE', 'DEGRADATION', 'REPLACEMENT', 'INSPECTION') GROUP BY event_type""")
def _(f):
    listed = F.col("event_type").isin("FAILURE", "DEGRADATION", "REPLACEMENT", "INSPECTION")
    return f.maint.filter(listed).groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("value"))


@query("flt_null_aware", """SELECT alert_id, status FROM (SELECT alert_id, CASE severity WHEN 'CRITICAL' THEN 'RESOLVED' WHEN 'WARNING' THEN 'OPEN' END
    AS status FROM alerts) WHERE status <> 'RESOLVED' OR status IS NULL""")
def _(f):
    status = F.when(F.col("severity") == "CRITICAL", "RESOLVED").when(F.col("severity") == "WARNING", "OPEN")
    return f.alerts.select("alert_id", status.alias("status")).filter(filters.differs_or_null("status", "RESOLVED"))


@query("flt_optional", f"""SELECT aircraft_msn, component_id, {S('event_timestamp', 'event_timestamp')}, event_type, is_scheduled FROM maint
    WHERE event_type = 'FAILURE' AND is_scheduled = FALSE AND event_timestamp >= TIMESTAMP '1999-01-01' AND event_timestamp <= TIMESTAMP '{AS_OF}'""")
def _(f):
    from datetime import datetime

    chosen = filters.optional(
        f.maint, equal={"aircraft_msn": None, "component_id": None, "event_type": "FAILURE", "is_scheduled": False},
        at_least={"event_timestamp": datetime(1999, 1, 1)}, at_most={"event_timestamp": datetime.fromisoformat(AS_OF)},
    )
    return chosen.select("aircraft_msn", "component_id", "event_timestamp", "event_type", "is_scheduled")


@query("flt_array_contains", """SELECT component_id, len(compatible) AS n_compatible FROM
    (SELECT component_id, list(DISTINCT airline_code) AS compatible FROM maint JOIN aircraft USING (aircraft_msn) GROUP BY component_id)
    WHERE list_contains(compatible, 7)""")
def _(f):
    fleets = f.maint.select("component_id", "aircraft_msn").distinct().join(f.aircraft, "aircraft_msn").groupBy("component_id").agg(
        F.collect_set("airline_code").alias("compatible")
    )
    return filters.optional(fleets, contains={"compatible": 7}).select("component_id", F.size("compatible").alias("n_compatible"))


@query("lookup_keys", """SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (SELECT component_id FROM alerts WHERE severity = 'CRITICAL')""")
def _(f):
    keys = f.alerts.filter(F.col("severity") == "CRITICAL").select(F.col("component_id").alias("p_partkey"))
    return filters.with_keys(f.table("part"), keys, ["p_partkey"]).select("p_partkey", "p_name", "p_brand")


@query("prj_calendar", """SELECT event_id, EXTRACT(HOUR FROM ts) AS hour_of_day, EXTRACT(DOW FROM ts) AS day_of_week,
    EXTRACT(DAY FROM ts) AS day_of_month, EXTRACT(MONTH FROM ts) AS month, EXTRACT(YEAR FROM ts) AS year FROM events""")
def _(f):
    return cal.add_calendar_parts(f.table("events"), "ts").drop("ts", "user_id", "event_type", "value", "props")


@query("prj_bucket", """SELECT component_id, CASE WHEN recommended_maintenance_interval > 30 THEN 'LONG' WHEN recommended_maintenance_interval > 15
    THEN 'MEDIUM' ELSE 'SHORT' END AS bucket FROM components""")
def _(f):
    return f.components.select("component_id", num.ladder("recommended_maintenance_interval", [(30, "LONG"), (15, "MEDIUM")], "SHORT").alias("bucket"))


@query("prj_safe_ratio", f"""SELECT aircraft_msn, {S('date', 'date')}, {R('CASE WHEN x > 0 THEN flight_hours / x END')} AS or_null,
    {R('CASE WHEN x > 0 THEN flight_hours / x ELSE 0 END')} AS or_zero, {R('flight_hours / GREATEST(1, x)')} AS at_least_one
    FROM (SELECT *, takeoffs - 2 AS x FROM usage)""")
def _(f):
    u = f.usage.withColumn("x", F.col("takeoffs") - 2)
    ratio = {n: num.safe_ratio("flight_hours", "x", g) for n, g in (("or_null", "null"), ("or_zero", "zero"), ("at_least_one", "floor"))}
    return u.select("aircraft_msn", "date", *[c.alias(n) for n, c in ratio.items()])


@query("prj_fill_zero", """SELECT c.component_id, COALESCE(f.n, 0) AS failures FROM components c
    LEFT JOIN (SELECT component_id, COUNT(*) AS n FROM maint WHERE event_type = 'MODIFICATION' GROUP BY component_id) f USING (component_id)""")
def _(f):
    counts = f.maint.filter(F.col("event_type") == "MODIFICATION").groupBy("component_id").agg(F.count("*").alias("failures"))
    return num.fill_zero(f.components.select("component_id").join(counts, "component_id", "left"), ["failures"])


@query("prj_label", """SELECT component_id, component_type || ' - ' || CASE WHEN length(k) > 6 THEN substring(k, length(k) - 5) ELSE k END AS label,
    component_type || ' (actuel)' AS current_label FROM (SELECT *, 'COMP-' || CAST(component_id AS VARCHAR) AS k FROM components)""")
def _(f):
    ident = F.concat(F.lit("COMP-"), F.col("component_id").cast("string"))
    return f.components.select(
        "component_id", num.tail_label("component_type", ident).alias("label"),
        F.concat("component_type", F.lit(" (actuel)")).alias("current_label"),
    )


@query("prj_stamp", f"""SELECT aircraft_msn, {RA('SUM(flight_hours)', 'hours')}, '30d' AS period, '2000-05-31' AS start_date, '{AS_OF}' AS end_date,
    '{AS_OF} 00:00:00' AS calculation_timestamp FROM usage
    WHERE date >= DATE '2000-05-31' AND date <= DATE '{AS_OF}' GROUP BY aircraft_msn""")
def _(f):
    totals = f.usage.filter(cal.lookback("date", AS_OF, 30)).groupBy("aircraft_msn").agg(F.sum("flight_hours").alias("hours"))
    return totals.withColumns(
        {
            "period": F.lit("30d"),
            "start_date": F.date_sub(F.lit(AS_OF).cast("date"), 30),
            "end_date": F.lit(AS_OF).cast("date"),
            "calculation_timestamp": F.lit(AS_OF).cast("timestamp"),
        }
    )


# ---- scalar function families


@query("fn_string", rf"""SELECT doc_id, length(t) AS n_clean, len({sql_tokens('text')}) AS n_tokens, right(t, 12) AS tail,
    lang || ':' || source AS tag FROM (SELECT *, {SQL_CLEAN.format('text')} AS t FROM documents)""")
def _(f):
    cleaned = tx.clean_text("text")
    return f.table("documents").select(
        "doc_id", F.char_length(cleaned).alias("n_clean"), F.size(tx.words(cleaned)).alias("n_tokens"),
        F.right(cleaned, F.lit(12)).alias("tail"), F.concat("lang", F.lit(":"), "source").alias("tag"),
    )


@query("fn_lexicon", f"""SELECT doc_id, len(list_filter({sql_tokens('text')}, lambda w: list_contains({SQL_LEXICON}, w))) AS hits FROM documents""")
def _(f):
    return f.table("documents").select("doc_id", tx.lexicon_hits(tx.words(tx.clean_text("text")), LEXICON).alias("hits"))


@query("fn_datetime", f"""SELECT event_id, {S('CAST(ts AS DATE)', 'day')}, {S("CAST(DATE_TRUNC('day', ts) AS TIMESTAMP)", 'day_start')},
    {S("CAST(DATE_TRUNC('month', ts) AS DATE)", 'month')}, {S('ts - INTERVAL 7 DAY', 'week_before')},
    date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days_in,
    CAST(floor(date_diff('microsecond', TIMESTAMP '2024-01-01 12:00:00', ts) / 86400000000.0) AS BIGINT) AS whole_days, epoch_us(ts) // 1000 AS epoch_ms FROM events""")
def _(f):
    start = F.lit("2024-01-01 12:00:00").cast("timestamp")
    return f.table("events").select(
        "event_id", F.to_date("ts").alias("day"), F.date_trunc("day", "ts").alias("day_start"), F.trunc("ts", "month").alias("month"),
        (F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("week_before"), F.datediff("ts", F.lit("2024-01-01")).alias("days_in"),
        cal.whole_days(start, F.col("ts")).alias("whole_days"), F.unix_millis("ts").alias("epoch_ms"),
    )


@query("fn_math", f"""SELECT {', '.join(['aircraft_msn', 'flight_id'])}, {RA('abs(engine_1_temp - engine_2_temp)', 'gap')},
    {RA('sqrt(fuel_flow_rate)', 'root')},
    {RA('sqrt((engine_1_temp - 300) * (engine_1_temp - 300) + (fuel_flow_rate - 25) * (fuel_flow_rate - 25))', 'dist')},
    {RA('least(engine_1_vibration, engine_2_vibration)', 'low')}, {RA('greatest(engine_1_vibration, engine_2_vibration)', 'high')},
    {RA('engine_1_vibration * 1000 / fuel_flow_rate', 'rate')} FROM flights""")
def _(f):
    v1, v2 = F.col("engine_1_vibration"), F.col("engine_2_vibration")
    return f.flights.select(
        "aircraft_msn", "flight_id", F.abs(F.col("engine_1_temp") - F.col("engine_2_temp")).alias("gap"), F.sqrt("fuel_flow_rate").alias("root"),
        num.distance(F.array("engine_1_temp", "fuel_flow_rate"), F.array(F.lit(300.0), F.lit(25.0))).alias("dist"),
        F.least(v1, v2).alias("low"), F.greatest(v1, v2).alias("high"), (v1 * 1000 / F.col("fuel_flow_rate")).alias("rate"),
    )


@query("fn_conditional", """SELECT alert_id, CASE WHEN severity = 'CRITICAL' THEN 3 WHEN severity = 'WARNING' THEN 2 ELSE 1 END AS level,
    COALESCE(CASE WHEN severity <> 'INFO' THEN severity END, 'none') AS shown,
    (CASE WHEN severity <> 'INFO' THEN severity END) IS NULL AS hidden FROM alerts""")
def _(f):
    shown = F.when(F.col("severity") != "INFO", F.col("severity"))
    level = F.when(F.col("severity") == "CRITICAL", 3).when(F.col("severity") == "WARNING", 2).otherwise(1)
    return f.alerts.select("alert_id", level.alias("level"), F.coalesce(shown, F.lit("none")).alias("shown"), shown.isNull().alias("hidden"))


@query("fn_json", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text,
    '{"id":' || event_id || ',"type":"' || event_type || '"}' AS packed,
    CAST(json_extract(props, '$.k') AS INTEGER) * 2 AS exploded FROM events""")
def _(f):
    k = F.from_json("props", "k int").k
    twice = F.from_json(F.to_json(F.array(F.struct((k * 2).alias("v")))), "array<struct<v:int>>")
    return f.table("events").select(
        "event_id", k.alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("packed"),
        F.explode(F.transform(twice, lambda s: s.v)).alias("exploded"),
    )




@query("fn_map", f"""SELECT conv_id, turn, {R('(CAST(turn % 2 = 0 AS INT) + CAST(length(text) > 300 AS INT) + CAST(role = ' + chr(39) + 'user' + chr(39) + ' AS INT)) / 3')}
    AS friends_ratio, 3 AS known FROM conversations""")
def _(f):
    friends = F.create_map(
        F.lit("a"), F.col("turn") % 2 == 0, F.lit("b"), F.char_length("text") > 300, F.lit("c"), F.col("role") == "user"
    )
    return f.table("conversations").select("conv_id", "turn", tx.friends_ratio(friends).alias("friends_ratio"), F.size(F.map_keys(friends)).alias("known"))


@query("fn_array", f"""SELECT doc_id, list_contains(w, 'de') AS has_de, md5(array_to_string(w, ', ')) AS joined
    FROM (SELECT doc_id, {sql_tokens('text')} AS w FROM documents)""")
def _(f):
    w = tx.words(tx.clean_text("text"))
    return f.table("documents").select("doc_id", F.array_contains(w, "de").alias("has_de"), F.md5(F.array_join(w, ", ")).alias("joined"))


# ---- sorting, limits, pages, set operations


@query("top_recent", f"""SELECT {S('event_timestamp', 'event_timestamp')}, aircraft_msn, component_id, alert_id, alert_code FROM alerts
    WHERE severity = 'CRITICAL' ORDER BY alerts.event_timestamp DESC, alert_id LIMIT 10""")
def _(f):
    critical = f.alerts.filter(F.col("severity") == "CRITICAL")
    return paging.newest(critical, "event_timestamp", 10, ["alert_id"]).select("event_timestamp", "aircraft_msn", "component_id", "alert_id", "alert_code")


@query("top_groups", """SELECT aircraft_msn AS metric, COUNT(*) AS value FROM anomalies
    WHERE detection_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY aircraft_msn ORDER BY value DESC, metric LIMIT 10""")
def _(f):
    recent = f.anomalies.filter(F.col("detection_timestamp") >= F.lit("2024-01-01").cast("timestamp"))
    return recent.groupBy(F.col("aircraft_msn").alias("metric")).agg(F.count("*").alias("value")).orderBy(F.desc("value"), "metric").limit(10)


_PAGE = "aircraft_msn, flight_id, event_timestamp, fuel_flow_rate, engine_1_temp"


@query("page_export", f"""SELECT aircraft_msn, flight_id, {S('event_timestamp', 'event_timestamp')}, {RA('engine_1_temp', 'engine_1_temp')}, position, total,
    CAST(position // 100 AS BIGINT) AS page FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {_PAGE}) - 1 AS position, COUNT(*) OVER () AS total FROM flights)""")
def _(f):
    order = ["aircraft_msn", "flight_id", "event_timestamp", "fuel_flow_rate", "engine_1_temp"]
    numbered = paging.number_pages(f.flights.select(*order), [F.asc(c) for c in order], 100)
    return numbered.select("aircraft_msn", "flight_id", "event_timestamp", "engine_1_temp", "position", "total", "page")


@query("sort_multi", f"""SELECT aircraft_msn, component_id, {S('event_timestamp', 'event_timestamp')}, event_type, is_scheduled
    FROM maint ORDER BY maint.aircraft_msn, maint.component_id, maint.event_timestamp, maint.event_type, maint.is_scheduled""")
def _(f):
    cols = ["aircraft_msn", "component_id", "event_timestamp", "event_type", "is_scheduled"]
    return f.maint.select(*cols).orderBy(*cols)


@query("set_distinct", """SELECT DISTINCT m.aircraft_msn, m.component_id, c.component_type, c.manufacturer FROM maint m JOIN components c
    ON c.component_id = m.component_id""")
def _(f):
    pairs = f.maint.select("aircraft_msn", "component_id").dropDuplicates(["aircraft_msn", "component_id"])
    return pairs.join(f.components.select("component_id", "component_type", "manufacturer"), "component_id")


