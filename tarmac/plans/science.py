"""Anomaly detection, training frames, models, and text scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import anomaly as an
from ..operators import clusters, density, detection, forest
from ..operators import maintenance as mnt
from ..operators import ngrams
from ..operators import textmodels as tm
from ..operators import training as tr
from ..session import scratch_path
from .registry import R, RA, S, query
from .selection import LEXICON, SQL_LEXICON, sql_tokens

FEATURES = ["engine_1_temp", "engine_2_temp", "engine_1_pressure", "engine_2_pressure", "engine_1_vibration", "engine_2_vibration", "fuel_flow_rate"]
ROW = ["aircraft_msn", "flight_id", "event_timestamp", "fuel_flow_rate", "engine_1_temp"]
TWO = ["engine_1_temp", "fuel_flow_rate"]


def _z(c, std):
    return f"(s.{c} - t.m_{c}) / t.{std}_{c}"


_MOMENTS = "SELECT aircraft_msn, " + ", ".join(
    f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}, STDDEV_POP({c}) AS p_{c}" for c in FEATURES
) + " FROM flights GROUP BY aircraft_msn"


@query("ml_standardize", f"""SELECT 'sample' AS spread, s.flight_id, s.aircraft_msn, {', '.join(RA(_z(c, 's'), f'z_{c}') for c in TWO)}
    FROM flights s JOIN moments t USING (aircraft_msn) UNION ALL
    SELECT 'population', s.flight_id, s.aircraft_msn, {', '.join(R(_z(c, 'p')) for c in TWO)} FROM flights s JOIN moments t USING (aircraft_msn)""",
    {"moments": _MOMENTS})
def _(f):
    one = lambda name, ddof: an.standardise(f.flights, ["aircraft_msn"], TWO, ddof).select(
        F.lit(name).alias("spread"), "flight_id", "aircraft_msn", *[f"z_{c}" for c in TWO]
    )
    return one("sample", 1).unionByName(one("population", 0))


_LISTED = "list_filter([" + ", ".join(
    f"CASE WHEN t.s_{c} > 0 AND abs(s.{c} - t.m_{c}) > 2 * t.s_{c} THEN '{c}' END" for c in FEATURES
) + "], lambda x: x IS NOT NULL)"
_TOP = "greatest(" + ", ".join(f"CASE WHEN t.s_{c} > 0 THEN abs(s.{c} - t.m_{c}) / t.s_{c} ELSE 0 END" for c in FEATURES) + ")"


@query("ml_zscore_params", f"""SELECT aircraft_msn, flight_id, {RA('fuel_flow_rate', 'fuel_flow_rate')}, array_to_string(names, ',') AS names, {RA('top', 'top_deviation')} FROM
    (SELECT s.aircraft_msn, s.flight_id, s.fuel_flow_rate, {_LISTED} AS names, {_TOP} AS top FROM flights s JOIN moments t USING (aircraft_msn))
    WHERE len(names) > 0""", {"moments": _MOMENTS})
def _(f):
    marked = an.deviating_parameters(f.flights, ["aircraft_msn"], FEATURES, sigmas=2).filter(F.size("abnormal_parameters") > 0)
    top = F.array_max(F.transform("abnormal_parameters", lambda p: p.deviation))
    return marked.select(
        "aircraft_msn", "flight_id", "fuel_flow_rate", F.array_join(an.parameter_names("abnormal_parameters"), ",").alias("names"), top.alias("top_deviation")
    )


@query("ml_kmeans_outlier")
def _(f):
    out = clusters.kmeans_outliers(f.flights.select(*ROW, *[c for c in FEATURES if c not in ROW]), "aircraft_msn", FEATURES)
    flagged = out.filter("is_anomaly").withColumn("detection_method", F.lit("K_MEANS"))
    return flagged.select("aircraft_msn", "flight_id", "event_timestamp", "detection_method", "cluster", "distance_to_center")


def _shares(found, method):
    """Scored rows of each aircraft, and whether close to one in twenty is flagged."""
    share = F.count_if("is_anomaly") / F.count("*")
    return found.groupBy("aircraft_msn").agg(F.lit(method).alias("method"), F.count_if(F.col("is_anomaly").isNotNull()).alias("scored"), share.between(0.03, 0.07).alias("one_in_twenty"))


@query("ml_outlier_shares", """SELECT aircraft_msn, method, COUNT(*) AS scored, TRUE AS one_in_twenty
    FROM flights, (VALUES ('ISOLATION_FOREST'), ('K_MEANS')) m(method) GROUP BY ALL""")
def _(f):
    rows = f.flights.select(*ROW, *[c for c in FEATURES if c not in ROW])
    trees = forest.isolation_outliers(rows, rows, "aircraft_msn", FEATURES)
    return _shares(trees, "ISOLATION_FOREST").unionByName(_shares(clusters.kmeans_outliers(rows, "aircraft_msn", FEATURES), "K_MEANS"))


# rows of five clusters of very different size, a thousand apart
_PLANTED = "CASE WHEN flight_id % 16 = 0 THEN 0 WHEN flight_id % 16 = 1 THEN 1 WHEN flight_id % 16 < 4 THEN 2 WHEN flight_id % 16 < 8 THEN 3 ELSE 4 END"


@query("ml_cluster_sizes", f"""SELECT aircraft_msn, COUNT(*) AS cluster_rows, {_PLANTED} AS least, {_PLANTED} AS most FROM flights GROUP BY aircraft_msn, {_PLANTED}""")
def _(f):
    label = F.expr(_PLANTED)
    rows = f.flights.select(
        "aircraft_msn", label.alias("label"), (F.col("fuel_flow_rate") + F.when(label.isin(1, 4), 1000.0).otherwise(0.0)).alias("x"),
        (F.col("engine_2_pressure") + F.when(label.isin(2, 4), 1000.0).otherwise(0.0)).alias("y"),
        (F.col("engine_1_vibration") + F.when(label == 3, 1000.0).otherwise(0.0)).alias("z"),
    )
    placed = clusters.assign(rows, clusters.grouped_kmeans(rows, "aircraft_msn", ["x", "y", "z"]), "aircraft_msn", ["x", "y", "z"])
    return placed.groupBy("aircraft_msn", "cluster").agg(
        F.count("*").alias("cluster_rows"), F.min("label").alias("least"), F.max("label").alias("most")
    ).drop("cluster")


@query("ml_isolation_forest")
def _(f):
    rows = f.flights.select(*ROW, *[c for c in FEATURES if c not in ROW])
    found = forest.isolation_outliers(rows, rows, "aircraft_msn", FEATURES).filter("is_anomaly")
    return found.select("aircraft_msn", "flight_id", "event_timestamp", "anomaly_score", "confidence_score")


_EPS, _MIN, _AXES = 0.5, 5, [f"z_{c}" for c in FEATURES]
_NEAR = " + ".join(f"(p.{z} - q.{z}) * (p.{z} - q.{z})" for z in _AXES) + f" <= {_EPS * _EPS!r}"
_DENSITY = {
    "moments": _MOMENTS,
    "scaled": f"SELECT s.aircraft_msn, s.flight_id, s.engine_1_temp, {', '.join(f'{_z(c, chr(115))} AS z_{c}' for c in FEATURES)} FROM flights s JOIN moments t USING (aircraft_msn)",
    "places": f"SELECT aircraft_msn, {', '.join(_AXES)}, COUNT(*) AS w FROM scaled GROUP BY ALL",
    "sizes": "SELECT aircraft_msn, COUNT(*) AS n FROM flights GROUP BY aircraft_msn",
    "counted": f"SELECT p.aircraft_msn, {', '.join(f'p.{z}' for z in _AXES)}, SUM(q.w) >= {_MIN} AS core FROM places p JOIN places q ON q.aircraft_msn = p.aircraft_msn AND {_NEAR} GROUP BY ALL",
    "judged": f"SELECT p.aircraft_msn, {', '.join(f'p.{z}' for z in _AXES)}, NOT bool_or(q.core) AS is_noise FROM counted p JOIN counted q ON q.aircraft_msn = p.aircraft_msn AND {_NEAR} GROUP BY ALL",
}


@query("ml_density_noise", f"""SELECT s.aircraft_msn, s.flight_id, {RA('s.engine_1_temp', 'engine_1_temp')}, CASE WHEN k.n >= 10 THEN j.is_noise END AS is_noise FROM scaled s JOIN sizes k ON k.aircraft_msn = s.aircraft_msn
    JOIN judged j ON j.aircraft_msn = s.aircraft_msn AND {' AND '.join(f'j.{z} = s.{z}' for z in _AXES)}""", _DENSITY)
def _(f):
    scaled = an.standardise(f.flights.select("aircraft_msn", "flight_id", *FEATURES), ["aircraft_msn"], FEATURES)
    marked = density.density_noise(scaled, ["aircraft_msn"], _AXES, _EPS, _MIN, min_rows=10)
    return marked.select("aircraft_msn", "flight_id", "engine_1_temp", "is_noise")


def _flags(f):
    return an.deviating_parameters(f.flights, ["aircraft_msn"], FEATURES, sigmas=2).withColumns(
        {"forest_flag": F.col("engine_1_temp") > 950, "density_flag": F.col("fuel_flow_rate") < 2}
    )


_FLAGGED = {
    "moments": _MOMENTS,
    "flagged": f"""SELECT s.aircraft_msn, s.flight_id, s.engine_1_temp, s.fuel_flow_rate, s.engine_1_temp > 950 AS forest_flag,
        s.fuel_flow_rate < 2 AS density_flag, len({_LISTED}) AS n FROM flights s JOIN moments t USING (aircraft_msn)""",
}


@query("ml_anomaly_merge_marked", f"""SELECT aircraft_msn, flight_id, {RA('engine_1_temp', 'engine_1_temp')}, method AS detection_method,
    CAST(CASE method WHEN 'BOTH' THEN 0.95 WHEN 'ISOLATION_FOREST' THEN 0.85 ELSE 0.75 END AS DOUBLE) AS confidence_score,
    'Anomalie détectée par ' || method || ' dans ' || n || ' paramètres' AS description, n AS listed FROM
    (SELECT *, CASE WHEN forest_flag AND density_flag THEN 'BOTH' WHEN forest_flag THEN 'ISOLATION_FOREST' ELSE 'DBSCAN' END AS method FROM flagged)
    WHERE forest_flag OR density_flag""", _FLAGGED)
def _(f):
    merged = an.merge_detections(_flags(f), {"ISOLATION_FOREST": "forest_flag", "DBSCAN": "density_flag"})
    return merged.select(
        "aircraft_msn", "flight_id", "engine_1_temp", "detection_method", "confidence_score", "description",
        F.json_array_length("abnormal_parameters").cast("bigint").alias("listed"),
    )


@query("set_union_marked", f"""SELECT aircraft_msn, flight_id, 'ISOLATION_FOREST' AS detection_method, {RA('engine_1_temp', 'score')} FROM flagged WHERE forest_flag
    UNION ALL SELECT aircraft_msn, flight_id, 'K_MEANS', {R('fuel_flow_rate')} FROM flagged WHERE density_flag""", _FLAGGED)
def _(f):
    flagged = _flags(f)
    part = lambda flag, name, score: flagged.filter(flag).select(
        "aircraft_msn", "flight_id", F.lit(name).alias("detection_method"), F.col(score).alias("score")
    )
    return an.union_detections([part("forest_flag", "ISOLATION_FOREST", "engine_1_temp"), part("density_flag", "K_MEANS", "fuel_flow_rate")])


# the last months of the flights against all before them
_SPLIT = "2001-01-01"


def _history(f):
    rows = f.flights.select(*ROW, *[c for c in FEATURES if c not in ROW])
    return rows.filter(F.col("event_timestamp") < _SPLIT), rows.filter(F.col("event_timestamp") >= _SPLIT)


@query("ml_anomaly_merge")
def _(f):
    history, recent = _history(f)
    found = detection.detect_anomalies(history, recent, "aircraft_msn", FEATURES)
    return found.select(
        "aircraft_msn", "flight_id", "engine_1_temp", "detection_method", "confidence_score", "description",
        F.json_array_length("abnormal_parameters").cast("bigint").alias("listed"),
    )


@query("ml_detector_cover", f"""SELECT aircraft_msn, COUNT(*) AS judged, TRUE AS most_spared FROM flights
    WHERE event_timestamp >= DATE '{_SPLIT}' AND aircraft_msn IN (SELECT aircraft_msn FROM flights WHERE event_timestamp < DATE '{_SPLIT}' GROUP BY 1 HAVING COUNT(*) >= 100) GROUP BY ALL""")
def _(f):
    history, recent = _history(f)
    fitted = detection.fit_detectors(history, "aircraft_msn", FEATURES)
    path = scratch_path(f.spark, "detectors")
    fitted.save(path)
    marked = detection.detect(recent, detection.Detectors.load(f.spark, path), "aircraft_msn", FEATURES)
    flagged = F.count_if("forest_flag") / F.count("*")
    return marked.groupBy("aircraft_msn").agg(F.count("forest_flag").alias("judged"), (flagged < 0.5).alias("most_spared"))


@query("set_union_anomalies")
def _(f):
    rows = f.flights.select(*ROW, *[c for c in FEATURES if c not in ROW])
    trees = forest.isolation_outliers(rows, rows, "aircraft_msn", FEATURES).filter("is_anomaly")
    means = clusters.kmeans_outliers(rows, "aircraft_msn", FEATURES).filter("is_anomaly")
    part = lambda df, name, score: df.select("aircraft_msn", "flight_id", F.lit(name).alias("detection_method"), F.col(score).alias("score"))
    return an.union_detections([part(trees, "ISOLATION_FOREST", "anomaly_score"), part(means, "K_MEANS", "distance_to_center")])


# ---- tables for learning


@query("ml_risk_regression")
def _(f):
    f.store("components", "maint")
    risks = mnt.interval_risk(mnt.interval_features(f.maint, f.usage, f.alerts), f.components)
    _, tested, rmse = tr.risk_regression(risks, ["aircraft_msn", "component_id", "end_date"])
    return tested.select("aircraft_msn", "component_id", "end_date", "failure_risk", "prediction", F.lit(rmse).alias("rmse"))


_FRAME_COLS = ["flight_hours", "takeoffs", "landings", "avg_engine_1_temp", "avg_fuel_flow_rate", "total_alerts", "critical_alerts", "days_since_last_maintenance"]


_FRAME = {
    "days": "SELECT CAST(unnest(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM usage",
    "flown": """SELECT aircraft_msn, date, AVG(t) AS t, AVG(u) AS u FROM (SELECT aircraft_msn, flight_id, CAST(event_timestamp AS DATE) AS date,
        AVG(engine_1_temp) AS t, AVG(fuel_flow_rate) AS u FROM flights GROUP BY ALL) GROUP BY ALL""",
    "daily": """SELECT aircraft_msn, date, flight_hours, takeoffs, landings,
        COALESCE(LAST_VALUE(t IGNORE NULLS) OVER back, FIRST_VALUE(t IGNORE NULLS) OVER ahead, 0) AS avg_engine_1_temp,
        COALESCE(LAST_VALUE(u IGNORE NULLS) OVER back, FIRST_VALUE(u IGNORE NULLS) OVER ahead, 0) AS avg_fuel_flow_rate
        FROM (SELECT a.aircraft_msn, d.date, COALESCE(u.flight_hours, 0) AS flight_hours, COALESCE(u.takeoffs, 0) AS takeoffs,
              COALESCE(u.landings, 0) AS landings, f.t, f.u FROM (SELECT DISTINCT aircraft_msn FROM maint) a, days d
              LEFT JOIN usage u ON u.aircraft_msn = a.aircraft_msn AND u.date = d.date
              LEFT JOIN flown f ON f.aircraft_msn = a.aircraft_msn AND f.date = d.date)
        WINDOW back AS (PARTITION BY aircraft_msn ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               ahead AS (PARTITION BY aircraft_msn ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "worked": "SELECT DISTINCT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS d FROM maint",
    "failed": """SELECT DISTINCT aircraft_msn, component_id, CAST(CAST(event_timestamp AS DATE) - CAST(k AS INTEGER) AS DATE) AS date FROM maint, generate_series(1, 7) g(k)
        WHERE event_type = 'FAILURE' AND NOT is_scheduled""",
    "raised": """SELECT aircraft_msn, component_id, CAST(event_timestamp AS DATE) AS date, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS c
        FROM alerts GROUP BY ALL""",
    "frame": """SELECT p.component_type, d.*, COALESCE(r.n, 0) AS total_alerts, COALESCE(r.c, 0) AS critical_alerts,
        COALESCE(CAST(d.date - w.d AS BIGINT), 365) AS days_since_last_maintenance, x.date IS NOT NULL AS ahead
        FROM (SELECT DISTINCT m.aircraft_msn, m.component_id, c.component_type FROM maint m JOIN components c ON c.component_id = m.component_id) p
        JOIN daily d ON d.aircraft_msn = p.aircraft_msn
        ASOF LEFT JOIN worked w ON w.aircraft_msn = p.aircraft_msn AND w.component_id = p.component_id AND d.date > w.d
        LEFT JOIN failed x ON x.aircraft_msn = p.aircraft_msn AND x.component_id = p.component_id AND x.date = d.date
        LEFT JOIN raised r ON r.aircraft_msn = p.aircraft_msn AND r.component_id = p.component_id AND r.date = d.date""",
}


@query("ml_failure_frame", f"""SELECT component_type, CAST(CAST(DATE_TRUNC('month', date) AS DATE) AS VARCHAR) AS month, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE ahead) AS failing, {', '.join(RA(f'AVG({c})', c) for c in _FRAME_COLS)} FROM frame GROUP BY ALL""", _FRAME)
def _(f):
    frame = tr.failure_frame(f.maint, f.components, f.aircraft, f.usage, f.flights, f.alerts)
    return frame.groupBy("component_type", F.trunc("date", "month").alias("month")).agg(
        F.count("*").alias("n"), F.count_if("failure_next_7d").alias("failing"), *[F.avg(c).alias(c) for c in _FRAME_COLS]
    )


_NUMERIC = ["flight_hours", "takeoffs", "landings", *[f"avg_{c}" for c in FEATURES], "total_alerts", "critical_alerts", "days_since_last_maintenance"]
_KINDS = ["component_type", "manufacturer", "airline_code"]
# learned from the days before, judged on the days from here
_LEARN_UNTIL = "2001-01-01"


def _labelled_days(f, stored=False):
    f.store("components", "maint")
    frame = tr.failure_frame(f.maint, f.components, f.aircraft, f.usage, f.flights, f.alerts, stored=stored).withColumn("airline_code", F.col("airline_code").cast("string"))
    return frame.select("aircraft_msn", "component_id", "date", *_NUMERIC, *_KINDS, "failure_next_7d")


@query("ml_failure_split", f"""SELECT date < DATE '{_LEARN_UNTIL}' AS learns, ahead AS failing, COUNT(*) AS n FROM frame GROUP BY ALL""", _FRAME)
def _(f):
    return _labelled_days(f).groupBy((F.col("date") < _LEARN_UNTIL).alias("learns"), F.col("failure_next_7d").alias("failing")).agg(F.count("*").alias("n"))


@query("ml_failure_classifier")
def _(f):
    # read three times: its two sides are stored, not the days of every component
    days = _labelled_days(f, stored=True)
    learned = days.filter(F.col("date") < _LEARN_UNTIL)
    model = tr.failure_classifier(learned, _NUMERIC, _KINDS, "failure_next_7d", most_rows=tr.TASK_ROWS)
    judged = tr.predict_failures(model, days.filter(F.col("date") >= _LEARN_UNTIL), ["component_type", "date", "failure_next_7d"], _NUMERIC)
    return judged.groupBy("component_type", F.trunc("date", "month").alias("month"), "failure_next_7d").agg(
        F.count("*").alias("n"), F.avg("failure_probability").alias("mean_probability"), F.count_if("failure_predicted").alias("predicted")
    )


_HASH = "CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)"


@query("ml_stratified_split", f"""SELECT doc_id, toxic, rn * 10 < n * 8 + 10 AS is_train FROM (SELECT doc_id, toxic,
    ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY {_HASH}) AS rn, COUNT(*) OVER (PARTITION BY toxic) AS n FROM labels)""")
def _(f):
    return tr.stratified_split(f.table("labels").select("doc_id", "toxic"), "toxic", ["doc_id"])


@query("ml_class_weights", f"""SELECT toxic, n AS class_rows, {RA('t / (2 * n)', 'balanced_weight')},
    {R('CASE WHEN toxic = 1 THEN (t - n) / n ELSE 1 END')} AS positive_weight FROM
    (SELECT toxic, COUNT(*) AS n, (SELECT COUNT(*) FROM labels) AS t FROM labels GROUP BY toxic)""")
def _(f):
    return tr.class_weights(f.table("labels"), "toxic")


_CALLED = f"""SELECT l.toxic AS y, CASE WHEN len(list_filter(w, lambda x: list_contains({SQL_LEXICON}, x))) * 10 > len(w) THEN 1 ELSE 0 END AS p
    FROM labels l JOIN (SELECT doc_id, {sql_tokens('text')} AS w FROM documents) d ON d.doc_id = l.doc_id"""


@query("ml_eval_weighted", f"""SELECT {RA('SUM(hit) / SUM(support)', 'accuracy')}, {RA('SUM(precision * support) / SUM(support)', 'weighted_precision')},
    {RA('SUM(recall * support) / SUM(support)', 'weighted_recall')},
    {RA('SUM(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END * support) / SUM(support)', 'weighted_f1')}
    FROM (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall
          FROM (SELECT c, (SELECT COUNT(*) FROM called WHERE y = c) AS support, (SELECT COUNT(*) FROM called WHERE p = c) AS predicted,
                       (SELECT COUNT(*) FROM called WHERE y = c AND p = c) AS hit FROM (VALUES (0), (1)) k(c)))""", {"called": _CALLED})
def _(f):
    w = tx.words(tx.clean_text("text"))
    called = f.table("labels").join(f.table("documents").select("doc_id", "text"), "doc_id").select(
        F.col("toxic").alias("y"), F.when(tx.lexicon_hits(w, LEXICON) * 10 > F.size(w), 1).otherwise(0).alias("p")
    )
    return tr.weighted_scores(called, "y", "p")


# ---- messages


@query("tx_preprocess", rf"""SELECT doc_id, md5(regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_\s!?.,]', '', 'g')) AS cleaned FROM documents""")
def _(f):
    return f.table("documents").select("doc_id", F.md5(tx.clean_text("text")).alias("cleaned"))


_SCORED = {
    "tokens": f"SELECT message_id, sender_id, content, {sql_tokens('content')} AS w FROM messages",
    "scored": f"""SELECT *, CASE WHEN len(w) > 0 THEN least(1.0, len(list_filter(w, lambda x: list_contains({SQL_LEXICON}, x))) / len(w) * 3) ELSE 0.0 END
        AS score FROM tokens""",
    "doubted": "SELECT *, CASE WHEN score > 0.3 AND score < 0.7 THEN 0.5 ELSE 0.0 END AS uncertainty FROM scored",
}


@query("tx_lexicon_score", f"SELECT message_id, {RA('score', 'score')}, CAST(uncertainty AS DOUBLE) AS uncertainty FROM doubted", _SCORED)
def _(f):
    scored = f.messages.select("message_id", tx.lexicon_score("content", LEXICON).alias("score"))
    return scored.withColumn("uncertainty", tx.lexicon_uncertainty("score"))


@query("tx_uncertainty", f"""SELECT message_id, {R('greatest(0.0, 0.5 - abs(score - 0.5))')} AS fast, {R('1 - 2 * abs(score - 0.5)')} AS deep FROM scored""", _SCORED)
def _(f):
    scored = f.messages.select("message_id", tx.lexicon_score("content", LEXICON).alias("score"))
    return scored.select("message_id", tx.fast_uncertainty("score").alias("fast"), tx.deep_uncertainty("score").alias("deep"))


@query("tx_route_fast", """SELECT message_id, CASE WHEN uncertainty > 0.4 THEN 'NEEDS_ANALYSIS' WHEN score > 0.8 THEN 'TOXIC' ELSE 'OK' END AS decision
    FROM doubted""", _SCORED)
def _(f):
    score = tx.lexicon_score("content", LEXICON)
    return f.messages.select("message_id", score.alias("s")).select("message_id", tx.route_fast("s", tx.lexicon_uncertainty("s")).alias("decision"))


_DEEP = {
    **_SCORED,
    "context": """SELECT *, 1 - 2 * abs(score - 0.5) AS u0, sender_id = 'user' AS friendly, CASE WHEN sender_id = 'assistant' THEN 'ranked' END AS game_context FROM scored""",
    "step1": "SELECT *, CASE WHEN friendly THEN greatest(0, score - 0.2) ELSE score END AS s1, CASE WHEN friendly THEN greatest(0, u0 - 0.1) ELSE u0 END AS u1 FROM context",
    "step2": "SELECT *, CASE WHEN length(content) < 5 THEN least(1.0, u1 + 0.2) ELSE u1 END AS u2 FROM step1",
    "adjusted": "SELECT *, CASE WHEN length(game_context) > 0 THEN greatest(0, u2 - 0.1) ELSE u2 END AS u3 FROM step2",
}


def _adjusted(f):
    base = f.messages.withColumn("score", tx.lexicon_score("content", LEXICON)).withColumns(
        {
            "u": tx.deep_uncertainty("score"),
            "is_friends": F.create_map(F.lit("r"), F.col("sender_id") == "user"),
            "game_context": F.when(F.col("sender_id") == "assistant", "ranked"),
        }
    )
    score, unc = tx.context_adjust("score", "u", tx.friends_ratio("is_friends"), "content", "game_context")
    return base.select("message_id", score.alias("s1"), unc.alias("u3"))


@query("tx_context_adjust", f"SELECT message_id, {RA('s1', 's1')}, {RA('u3', 'u3')} FROM adjusted", _DEEP)
def _(f):
    return _adjusted(f)


@query("tx_route_deep", """SELECT message_id, CASE WHEN u3 > 0.1 THEN 'NEEDS_MODERATION' WHEN s1 > 0.7 THEN 'TOXIC' ELSE 'OK' END AS decision FROM adjusted""", _DEEP)
def _(f):
    return _adjusted(f).select("message_id", tx.route_deep("s1", "u3").alias("decision"))


@query("tx_final_action", """SELECT message_id, source, decision, CASE decision WHEN 'TOXIC' THEN 'BLOCK' WHEN 'OK' THEN 'ALLOW' END AS action,
    CASE WHEN decision = 'TOXIC' OR (decision = 'OK' AND source IN ('deep_analyzer', 'human_moderator')) THEN TRUE END AS training_value FROM
    (SELECT message_id, CASE WHEN uncertainty > 0.4 THEN 'ESCALATE' WHEN score > 0.8 THEN 'TOXIC' ELSE 'OK' END AS decision,
            CASE sender_id WHEN 'user' THEN 'fast_classifier' WHEN 'assistant' THEN 'deep_analyzer' ELSE 'human_moderator' END AS source FROM doubted)""", _SCORED)
def _(f):
    source = F.when(F.col("sender_id") == "user", "fast_classifier").when(F.col("sender_id") == "assistant", "deep_analyzer").otherwise("human_moderator")
    scored = f.messages.select("message_id", source.alias("source"), tx.lexicon_score("content", LEXICON).alias("s"))
    unsure = tx.lexicon_uncertainty("s") > 0.4
    decided = scored.withColumn("decision", F.when(unsure, "ESCALATE").when(F.col("s") > 0.8, "TOXIC").otherwise("OK"))
    return decided.select(
        "message_id", "source", "decision", tx.final_action("decision").alias("action"), tx.training_value("decision", "source").alias("training_value")
    )


def _labelled(f):
    joined = f.table("labels").join(f.table("documents"), "doc_id")
    return joined.select("doc_id", "text", F.col("toxic").cast("double").alias("toxicity"), (F.col("source") == "forum").alias("is_friends"))


@query("tx_tfidf_lr_fast")
def _(f):
    rows = tr.stratified_split(_labelled(f), "toxicity", ["doc_id"])
    model = tm.fit_terms(rows.filter("is_train"))
    return model.scores(rows).select("doc_id", "toxicity", "is_train", "toxicity_score")


_TERMS = {
    "said": r"SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}') AS w FROM documents",
    "terms": """SELECT doc_id, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS term FROM said""",
    "counted": "SELECT doc_id, term, COUNT(*) AS tf FROM terms GROUP BY ALL",
    "kept": """SELECT term, COUNT(*) AS doc_freq, ln((n + 1) / (COUNT(*) + 1)) + 1 AS idf FROM counted, (SELECT COUNT(*) AS n FROM documents)
        GROUP BY term, n HAVING COUNT(*) >= 2 AND COUNT(*) <= 0.9 * n""",
}


@query("tx_ngram_dictionary", f"""SELECT term, doc_freq, {R('idf')} AS idf, ROW_NUMBER() OVER (ORDER BY term) - 1 AS position FROM kept""", _TERMS)
def _(f):
    return ngrams.dictionary(f.table("documents"))


@query("tx_ngram_vectors", f"""SELECT d.doc_id, COUNT(k.term) AS n_terms, {R('COALESCE(SQRT(SUM(tf * idf * tf * idf)), 0)')} AS norm
    FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.term = c.term GROUP BY d.doc_id""", _TERMS)
def _(f):
    docs = f.table("documents")
    return ngrams.weights(docs, ngrams.dictionary(docs), "doc_id").select("doc_id", F.size("entries").cast("long").alias("n_terms"), "norm")


@query("tx_tfidf_lr_context")
def _(f):
    rows = tr.stratified_split(_labelled(f), "toxicity", ["doc_id"])
    train = rows.filter("is_train")
    context = tm.scores(tm.fit_context(train), rows, "context_score").select("doc_id", "toxicity", "is_train", "context_score")
    hashed = tm.scores(tm.fit_hashed(train), rows, "hashed_score").select("doc_id", "hashed_score")
    return context.join(hashed, "doc_id")


@query("tx_mlp")
def _(f):
    rows = tr.stratified_split(_labelled(f), "toxicity", ["doc_id"])
    model = tm.fit_network(rows.filter("is_train"))
    return tm.scores(model, rows).select("doc_id", "toxicity", "is_train", "toxicity_score")


@query("model_save_load")
def _(f):
    rows = _labelled(f)
    path = scratch_path(f.spark, "model")
    model = tm.fit_hashed(rows)
    model.write().overwrite().save(path)
    before = tm.scores(model, rows).select("doc_id", F.col("toxicity_score").alias("before"))
    after = tm.scores(PipelineModel.load(path), rows).select("doc_id", F.col("toxicity_score").alias("after"))
    return before.join(after, "doc_id").withColumn("equal", F.col("before") == F.col("after"))
