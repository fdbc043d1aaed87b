"""Sources, sinks and streams. Files are written by Spark from the driver tables into the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reliability as rel
from ..sources import readers, schemas, writers
from ..session import scratch_path
from ..streaming import moderation as mod
from ..streaming import review, trends
from .registry import R, RA, S, query
from .figures import _WEEKLY
from .science import _DEEP, _SCORED
from .selection import AS_OF, LEXICON, SQL_LEXICON

CLOCK = 1_700_000_000_000


@query("src_csv_schema", f"SELECT aircraft_msn, {S('date', 'date')}, {RA('flight_hours', 'flight_hours')}, takeoffs FROM usage")
def _(f):
    path = scratch_path(f.spark, "usage-csv")
    writers.write_csv(
        f.usage.select("aircraft_msn", "date", "takeoffs", "landings", "flight_hours", F.lit(0).alias("apu_cycles"), F.lit(0.0).alias("apu_hours")), path
    )
    back = readers.read_csv(f.spark, path, schemas.USAGE)
    return back.select(F.col("aircraft_msn").cast("bigint").alias("aircraft_msn"), "date", "flight_hours", F.col("takeoffs").cast("bigint").alias("takeoffs"))


@query("src_json_schema", f"SELECT CAST(aircraft_msn AS VARCHAR) AS aircraft_msn, {S('event_timestamp', 'event_timestamp')}, alert_code, severity FROM alerts")
def _(f):
    path = scratch_path(f.spark, "alerts-json")
    text = [F.col(c).cast("string").alias(c) for c in ("aircraft_msn", "component_id")]
    writers.write_json_report(f.alerts.select(*text, "event_timestamp", "alert_code", "severity", F.lit("m").alias("message")), path)
    return readers.read_json(f.spark, path, schemas.ALERT).select("aircraft_msn", "event_timestamp", "alert_code", "severity")


def _landing(f):
    airline = F.element_at(F.array(F.lit("AIR"), F.lit("FLY"), F.lit("SKY")), (F.col("user_id") % 3 + 1).cast("int"))
    return f.table("events").select("event_id", "event_type", "value", airline.alias("airline"), F.to_date("ts").alias("date"))


@query("src_partitioned", f"""SELECT event_id, event_type, {RA('value', 'value')}, ['AIR', 'FLY', 'SKY'][user_id % 3 + 1] AS airline FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND user_id % 3 < 2""")
def _(f):
    path = scratch_path(f.spark, "landing")
    writers.write_parquet(_landing(f), path, ["airline", "date"])
    day = readers.read_partitioned(f.spark, path, "event_id bigint, event_type string, value double", "2024-01-15", ["AIR", "FLY"])
    return day.select("event_id", "event_type", "value", "airline")


@query("src_sniff_route", """SELECT 'flight_data' AS route, COUNT(*) AS n FROM flights UNION ALL SELECT 'usage_cycles', COUNT(*) FROM usage
    UNION ALL SELECT 'alerts', COUNT(*) FROM alerts UNION ALL SELECT 'maintenance_events', COUNT(*) FROM maint
    UNION ALL SELECT 'weather_data', COUNT(*) FROM nation UNION ALL SELECT 'unknown', COUNT(*) FROM region""")
def _(f):
    root = scratch_path(f.spark, "mixed")
    # the components are found once
    f.store("components")
    parts = {
        "sensors": f.flights, "cycles": f.usage, "alarms": f.alerts, "maintenance_log": f.maint, "weather_data": f.table("nation"), "other": f.table("region"),
    }
    # every line names its fields, which compresses well
    for name, df in parts.items():
        writers.write_json_report(df, f"{root}/{name}", "gzip")
    return readers.read_routed(f.spark, [f"{root}/{name}" for name in parts]).groupBy("route").agg(F.count("*").alias("n"))


@query("src_documents", "SELECT lower(printf('%024x', p_partkey)) AS _id, p_name AS name, p_type AS type FROM part")
def _(f):
    path = scratch_path(f.spark, "collection")
    oid = F.lower(F.lpad(F.hex("p_partkey"), 24, "0"))
    dump = f.table("part").select(F.struct(oid.alias("$oid")).alias("_id"), F.col("p_name").alias("name"), F.col("p_type").alias("type"))
    writers.write_json_report(dump, path)
    return readers.read_documents(f.spark, path, "_id string, name string, type string")


@query("sink_parquet", f"""SELECT event_id, event_type, {RA('value', 'value')}, {S('CAST(ts AS DATE)', 'date')},
    ['AIR', 'FLY', 'SKY'][user_id % 3 + 1] AS airline FROM events""")
def _(f):
    path = scratch_path(f.spark, "sink-parquet")
    rows = _landing(f)
    writers.write_parquet(rows, path, ["date"])
    # a second run of one day replaces that day only
    writers.write_parquet(rows.filter(F.col("date") == F.lit("2024-01-15").cast("date")), path, ["date"])
    return f.spark.read.schema(rows.schema).parquet(path)


@query("sink_csv", f"""SELECT aircraft_msn, CAST(SUM(takeoffs) AS BIGINT) AS total_takeoffs, {RA('SUM(flight_hours)', 'total_flight_hours')} FROM usage GROUP BY 1""")
def _(f):
    totals = f.usage.groupBy("aircraft_msn").agg(F.sum("takeoffs").alias("total_takeoffs"), F.sum("flight_hours").alias("total_flight_hours"))
    path = scratch_path(f.spark, "sink-csv")
    writers.write_daily(totals, f"{path}/parquet", f"{path}/csv")
    return f.spark.read.schema(totals.schema).option("header", True).csv(f"{path}/csv")


@query("sink_json_report", f"""SELECT period, total_components_analyzed, total_failures, rank, component_id, {RA('mtbf', 'mtbf')} FROM
    (SELECT period, COUNT(*) AS total_components_analyzed, CAST(SUM(failures) AS BIGINT) AS total_failures FROM weekly GROUP BY period)
    JOIN (SELECT period, component_id, mtbf, ROW_NUMBER() OVER (PARTITION BY period ORDER BY mtbf DESC, component_id) AS rank FROM weekly) USING (period)
    WHERE rank <= 5""", _WEEKLY)
def _(f):
    path = scratch_path(f.spark, "report")
    report = rel.reliability_report(rel.weekly_reliability(f.maint, f.usage, AS_OF))
    writers.write_json_report(report, path)
    back = f.spark.read.schema(report.schema).json(path)
    return back.select("period", "total_components_analyzed", "total_failures", F.inline("top_reliable_components"))


# ---- streams

# files of one micro-batch at most; what lands keeps the partitioning of its source
FILES = 1000


@query("src_stream_json", f"""SELECT event_id, event_type, {RA('value', 'value')} FROM events""")
def _(f):
    landing, sink = scratch_path(f.spark, "lines"), scratch_path(f.spark, "sink")
    events = f.table("events").select("event_id", "event_type", "value")
    events.select(F.to_json(F.struct("*")).alias("value")).write.text(landing)
    lines = readers.stream_lines(f.spark, landing, files_per_trigger=FILES)
    parsed = lines.select(F.from_json("value", "event_id bigint, event_type string, value double").alias("m")).select("m.*")
    return writers.run_to_files(parsed, f"{sink}/out", f"{sink}/checkpoint")


def _raw_lines(f):
    """Conversations as JSON messages; every eleventh conversation sends one broken line per turn besides."""
    c = f.table("conversations")
    message = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), F.col("role").alias("sender_id"), F.col("text").alias("content"),
        (F.lit(CLOCK) + F.col("conv_id") * 1000 + F.col("turn")).alias("timestamp"), F.lit("g1").alias("game_id"), F.concat(F.lit("c"), "conv_id").alias("channel_id"),
        F.array(F.lit("r")).alias("recipients"),
        F.when(F.col("role") != "system", F.create_map(F.lit("r"), F.col("role") == "user")).alias("is_friends"),
        F.struct(F.lit("fps").alias("game_type"), F.lit(3).alias("sender_level"), F.when(F.col("role") == "assistant", "ranked").alias("game_context")).alias("metadata"),
    )
    broken = F.concat(F.lit("{oops "), F.concat_ws("-", "conv_id", "turn"))
    return c.select(F.to_json(message).alias("value")).unionByName(c.filter(F.col("conv_id") % 11 == 10).select(broken.alias("value")))


def _message_stream(f, copies: int = 1):
    landing = scratch_path(f.spark, "raw-messages")
    lines = _raw_lines(f)
    for i in range(copies):
        lines.write.text(f"{landing}/{i}")
    return readers.stream_lines(f.spark, f"{landing}/*", files_per_trigger=FILES)


def _topics(f, df, label):
    """Run a hop into keyed, routed files; returns a reader of one topic, again as a stream."""
    path = scratch_path(f.spark, label)
    stored = writers.run_to_files(df, f"{path}/out", f"{path}/checkpoint", partition_by=["topic"])
    stream = f.spark.readStream.schema(stored.schema).parquet(f"{path}/out")
    return stored, lambda topic: stream.filter(F.col("topic") == topic).select("value")


def _fast_hop(f):
    classified = mod.classify_fast(mod.parse_messages(_message_stream(f)), mod.lexicon_scorer(LEXICON), clock=F.lit(CLOCK))
    return _topics(f, writers.keyed_json(classified, "message_id", mod.fast_topic()), "fast")


def _read(df, schema):
    return df.select(F.from_json("value", schema).alias("m")).select("m.*")


def _deep_hop(f, topic):
    waiting = _read(topic(mod.ANALYSIS_REQUIRED), schemas.CLASSIFIED)
    analysed = mod.analyse_deep(waiting, lambda df: df.withColumn("toxicity_score", F.col("classification.toxicity_score")), clock=F.lit(CLOCK))
    return _topics(f, writers.keyed_json(analysed, "message_id", mod.deep_topic()), "deep")


@query("st_parse_validate", """SELECT conv_id || '-' || turn AS message_id, length(text) AS n_content, CASE WHEN role <> 'system' THEN 1 ELSE 0 END AS n_friends,
    CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS raw_message, CAST(NULL AS VARCHAR) AS decision FROM conversations
    UNION ALL SELECT NULL, NULL, 0, 'Message non parsable', '{oops ' || conv_id || '-' || turn, 'ERROR' FROM conversations WHERE conv_id % 11 = 10""")
def _(f):
    parsed = mod.classify_fast(mod.parse_messages(_message_stream(f)), mod.lexicon_scorer(LEXICON), clock=F.lit(CLOCK))
    sink = scratch_path(f.spark, "parsed")
    flat = parsed.select(
        "message_id", F.char_length("content").alias("n_content"), F.size("is_friends").alias("n_friends"), "error", "raw_message",
        F.when(F.col("classification.decision") == "ERROR", "ERROR").alias("decision"),
    )
    return writers.run_to_files(flat, f"{sink}/out", f"{sink}/checkpoint")


_FAST_SQL = "CASE WHEN uncertainty > 0.4 THEN 'NEEDS_ANALYSIS' WHEN score > 0.8 THEN 'TOXIC' ELSE 'OK' END"


@query("st_fast_classify", f"SELECT message_id, {RA('score', 'score')}, CAST(uncertainty AS DOUBLE) AS uncertainty, {_FAST_SQL} AS decision FROM doubted", _SCORED)
def _(f):
    classified = mod.classify_fast(mod.parse_messages(_message_stream(f)), mod.lexicon_scorer(LEXICON), clock=F.lit(CLOCK))
    sink = scratch_path(f.spark, "classified")
    v = "classification"
    flat = classified.filter("error IS NULL").select(
        "message_id", F.col(f"{v}.toxicity_score").alias("score"), F.col(f"{v}.uncertainty").alias("uncertainty"), F.col(f"{v}.decision").alias("decision")
    )
    return writers.run_to_files(flat, f"{sink}/out", f"{sink}/checkpoint")


@query("st_route", f"""SELECT CASE WHEN {_FAST_SQL} = 'NEEDS_ANALYSIS' THEN 'nlp-analysis-required' ELSE 'classified-messages' END AS topic, message_id AS key,
    {_FAST_SQL} AS decision FROM doubted
    UNION ALL SELECT 'classified-messages', NULL, 'ERROR' FROM conversations WHERE conv_id % 11 = 10""", _SCORED)
def _(f):
    stored, _ = _fast_hop(f)
    return stored.select("topic", "key", F.get_json_object("value", "$.classification.decision").alias("decision"))


_DEEP_HOP = {
    **{k: v for k, v in _DEEP.items()},
    "doubted": _SCORED["doubted"],
    "second": """SELECT a.message_id, a.content, a.s1, a.u3, CASE WHEN a.u3 > 0.1 THEN 'NEEDS_MODERATION' WHEN a.s1 > 0.7 THEN 'TOXIC' ELSE 'OK' END AS decision
        FROM adjusted a JOIN doubted d ON d.message_id = a.message_id WHERE d.uncertainty > 0.4""",
}


@query("st_deep_analyze", f"""SELECT CASE decision WHEN 'NEEDS_MODERATION' THEN 'moderation-required' ELSE 'nlp-analysis-results' END AS topic, message_id AS key,
    {RA('s1', 'score')}, {RA('u3', 'uncertainty')}, decision FROM second""", _DEEP_HOP)
def _(f):
    _, topic = _fast_hop(f)
    stored, _ = _deep_hop(f, topic)
    verdicts = stored.select("topic", "key", F.from_json("value", schemas.ANALYSED).alias("m")).select("topic", "key", "m.deep_analysis.*")
    return verdicts.select("topic", "key", F.col("toxicity_score").alias("score"), "uncertainty", "decision")


@query("st_moderation_queue", """SELECT conv_id || '-' || turn AS message_id, 1700000000000 + conv_id * 1000 + turn AS arrival FROM conversations
    ORDER BY arrival DESC, message_id DESC LIMIT 100""")
def _(f):
    parsed = mod.parse_messages(_message_stream(f, copies=2)).filter("error IS NULL").select("message_id", "timestamp", "sender_id", "content")
    sink = scratch_path(f.spark, "queue")
    stored = writers.run_to_files(review.queue_snapshots(parsed, "timestamp", 100), f"{sink}/out", f"{sink}/checkpoint")
    return review.current_queue(stored, 100).select("message_id", "arrival")


def _final(f):
    _, fast = _fast_hop(f)
    classified = _read(fast(mod.CLASSIFIED), schemas.CLASSIFIED)
    _, deep = _deep_hop(f, fast)
    analysed = _read(deep(mod.ANALYSIS_RESULTS), schemas.ANALYSED)
    # the moderator of this run judges by length
    judged = F.when(F.char_length("content") % 2 == 0, "TOXIC").otherwise("OK")
    moderated = mod.with_moderation(_read(deep(mod.MODERATION_REQUIRED), schemas.ANALYSED), judged, clock=F.lit(CLOCK))
    return mod.final_decisions(classified, analysed, moderated, clock=F.lit(CLOCK))


_FINAL = {
    **_DEEP_HOP,
    "final": f"""SELECT *, CASE decision WHEN 'TOXIC' THEN 'BLOCK' WHEN 'OK' THEN 'ALLOW' END AS action,
        CASE WHEN decision = 'TOXIC' OR source <> 'fast_classifier' THEN TRUE END AS training_value FROM (
        SELECT message_id, 'fast_classifier' AS source, {_FAST_SQL} AS decision FROM doubted WHERE {_FAST_SQL} <> 'NEEDS_ANALYSIS'
        UNION ALL SELECT message_id, 'deep_analyzer', decision FROM second WHERE decision <> 'NEEDS_MODERATION'
        UNION ALL SELECT message_id, 'human_moderator', CASE WHEN length(content) % 2 = 0 THEN 'TOXIC' ELSE 'OK' END FROM second WHERE decision = 'NEEDS_MODERATION')""",
}


@query("st_final_decision", "SELECT message_id, source, decision, action, training_value FROM final", _FINAL)
def _(f):
    sink = scratch_path(f.spark, "final")
    flat = _final(f).select("message_id", "final_decision.source", "final_decision.decision", "final_decision.action", "final_decision.training_value")
    return writers.run_to_files(flat, f"{sink}/out", f"{sink}/checkpoint")


@query("st_training_feedback", """SELECT f.message_id, length(m.content) AS n_text, CASE WHEN f.decision = 'TOXIC' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS toxicity FROM final f
    JOIN messages m ON m.message_id = f.message_id WHERE f.training_value""", _FINAL)
def _(f):
    sink = scratch_path(f.spark, "feedback")
    kept = writers.run_to_files(mod.training_feedback(_final(f)), f"{sink}/out", f"{sink}/checkpoint")
    return kept.select("message_id", F.char_length("text").alias("n_text"), "toxicity")


@query("set_union_decisions", "SELECT source, decision, COUNT(*) AS n FROM final GROUP BY ALL", _FINAL)
def _(f):
    sink = scratch_path(f.spark, "union")
    flat = _final(f).select("message_id", "final_decision.source", "final_decision.decision")
    return writers.run_to_files(flat, f"{sink}/out", f"{sink}/checkpoint").groupBy("source", "decision").agg(F.count("*").alias("n"))


@query("sink_stream_keyed", f"SELECT message_id AS key, length(content) AS n_content FROM messages")
def _(f):
    sink = scratch_path(f.spark, "keyed")
    parsed = mod.parse_messages(_message_stream(f)).filter("error IS NULL").drop("error", "raw_message")
    stored = writers.run_to_files(writers.keyed_json(parsed, "message_id"), f"{sink}/out", f"{sink}/checkpoint", fmt="json")
    return stored.select("key", F.char_length(F.get_json_object("value", "$.content")).alias("n_content"))


@query("st_window_tumbling", f"""SELECT {S('w', 'window_start')}, {S('w + INTERVAL 7 DAY', 'window_end')}, aircraft_msn, {RA('AVG(engine_1_temp)', 'avg_engine_1_temp')},
    {RA('AVG(engine_2_temp)', 'avg_engine_2_temp')}, {RA('AVG(fuel_flow_rate)', 'avg_fuel_flow_rate')}, COUNT(flight_id) AS data_points
    FROM (SELECT *, CAST(time_bucket(INTERVAL 7 DAY, event_timestamp, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS w FROM flights) GROUP BY w, aircraft_msn""")
def _(f):
    return trends.tumbling_stats(f.flights, ["engine_1_temp", "engine_2_temp", "fuel_flow_rate"])
