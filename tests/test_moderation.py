"""Message verdicts, routing, and streams that equal their batch form."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.functions import text as tx
from tarmac.operators import textmodels
from tarmac.sources import readers, writers
from tarmac.streaming import moderation as mod
from tarmac.streaming import trends


def lines(spark, *messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m, ensure_ascii=False),) for m in messages], "value string")


def fast(spark, *messages, **kw):
    return mod.classify_fast(mod.parse_messages(lines(spark, *messages)), clock=F.lit(0), **kw)


@pytest.mark.parametrize(
    "content, score, unsure, decision",
    [
        ("Tu es vraiment un idiot!", 0.0, 0.0, "OK"),
        ("idiot a b c d e f", 3 / 7, 0.5, "NEEDS_ANALYSIS"),
        ("débile", 1.0, 0.0, "TOXIC"),
        ("DÉBILE @@", 1.0, 0.0, "TOXIC"),
        ("", 0.0, 0.0, "OK"),
    ],
)
def test_fast_verdicts(spark, content, score, unsure, decision):
    c = fast(spark, {"message_id": "1", "content": content}).first().classification
    assert c.toxicity_score == pytest.approx(score) and (c.uncertainty, c.decision) == (unsure, decision)


def test_punctuation_can_be_split_off(spark):
    score = spark.createDataFrame([("idiot!",)], "t string").select(tx.lexicon_score("t", strip_punct=True)).first()[0]
    assert score == 1.0


def test_bad_lines(spark):
    rows = fast(spark, "{oops" + "x" * 300, '"text"', {"message_id": "1", "content": None}, {"message_id": "2", "content": "a", "timestamp": "soon"}, {"message_id": "3"}).collect()
    assert [r.classification.decision for r in rows] == ["ERROR", "ERROR", "NEEDS_ANALYSIS", "NEEDS_ANALYSIS", "OK"]
    assert len(rows[0].raw_message) == 200 and rows[2].raw_message is None and rows[4].is_friends == {}


def scorer(score):
    return lambda df: df.withColumn("toxicity_score", F.lit(score))


def deep(spark, score, **message):
    parsed = mod.parse_messages(lines(spark, {"message_id": "1", "content": "x" * 20, **message}))
    return mod.analyse_deep(parsed, scorer(score), clock=F.lit(0)).first().deep_analysis


def test_deep_verdicts(spark):
    r = deep(spark, 0.75)
    assert (r.uncertainty, r.decision) == (0.5, "NEEDS_MODERATION")
    r = deep(spark, 0.99, metadata={"game_context": "ranked"})
    assert r.uncertainty == 0 and r.decision == "TOXIC"
    r = deep(spark, 0.99, is_friends={"a": True, "b": True, "c": False})
    assert r.toxicity_score == pytest.approx(0.79) and r.uncertainty == 0
    r = deep(spark, 0.0, content="abc")
    assert r.uncertainty == pytest.approx(0.2) and r.decision == "NEEDS_MODERATION"
    undecided = mod.analyse_deep(mod.parse_messages(lines(spark, {"message_id": "1", "content": "long enough"}))).first().deep_analysis
    assert (undecided.toxicity_score, undecided.uncertainty) == (0.5, 0.5)


def test_final_decisions(spark):
    verdict = lambda field, d: F.struct(F.lit(d).cast("string").alias("decision")).alias(field)
    base = lambda ident, field, d: spark.range(1).select(F.lit(ident).cast("string").alias("message_id"), F.lit("t").alias("content"), verdict(field, d))
    classified = base("ok", "classification", "OK").union(base("wait", "classification", "NEEDS_ANALYSIS")).union(base(None, "classification", "OK"))
    classified = classified.union(base("err", "classification", "ERROR")).union(base("none", "classification", None))
    analysed = base("deep", "deep_analysis", "OK").union(base("hold", "deep_analysis", "NEEDS_MODERATION"))
    out = {r.message_id: r.final_decision for r in mod.final_decisions(classified, analysed, base("human", "moderation", "TOXIC"), clock=F.lit(0)).collect()}
    assert set(out) == {"ok", "err", "deep", "human"}
    assert (out["ok"].action, out["ok"].training_value) == ("ALLOW", None)
    assert (out["err"].action, out["err"].training_value) == (None, None)
    assert (out["deep"].source, out["deep"].training_value) == ("deep_analyzer", True)
    assert (out["human"].action, out["human"].training_value) == ("BLOCK", True)


def test_stream_equals_batch_and_routes_by_topic(spark, tmp_path):
    words = ["idiot", "idiot a b c d e f", "bonjour", "merde alors"]
    raw = lines(spark, *[{"message_id": str(i), "content": words[i % 4]} for i in range(40)])
    raw.repartition(4).write.text(str(tmp_path / "in"))
    hop = lambda df: writers.keyed_json(mod.classify_fast(mod.parse_messages(df), clock=F.lit(0)), "message_id", mod.fast_topic())
    stored = writers.run_to_files(
        hop(readers.stream_lines(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), str(tmp_path / "ck"), partition_by=["topic"]
    )
    key = lambda df: sorted((r.key, r.value, r.topic) for r in df.select("key", "value", "topic").collect())
    assert key(stored) == key(hop(raw))
    assert stored.filter(F.col("topic") == mod.ANALYSIS_REQUIRED).count() == 10


def test_queue_drops_repeats_and_keeps_the_newest(spark, tmp_path):
    rows = spark.range(300).selectExpr("CAST(id % 150 AS STRING) AS message_id", "id % 150 AS arrival", "timestamp_millis(1700000000000 + id % 150) AS sent")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    once = writers.run_to_files(mod.distinct_messages(stream, "sent"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert once.count() == 150
    assert [r.arrival for r in mod.queue(once, "arrival").collect()] == list(range(50, 150))


def test_windows_close_in_a_stream_as_in_batch(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("A", f"f{i}", start + timedelta(hours=9 * i), float(i)) for i in range(80)]
    # a far sample closes every window before it
    rows.append(("A", "end", start + timedelta(days=300), 0.0))
    df = spark.createDataFrame(rows, "aircraft_msn string, flight_id string, event_timestamp timestamp, t double")
    df.orderBy("event_timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    closed = writers.run_to_files(trends.tumbling_stats(stream, ["t"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = trends.tumbling_stats(df.filter("flight_id <> 'end'"), ["t"])
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, batch.collect()))


def test_model_scorer_in_the_first_hop(spark):
    texts = [("idiot stupid bad", 1.0), ("hello nice day", 0.0)] * 20
    df = spark.createDataFrame([(f"{t} w{i % 3}", y) for i, (t, y) in enumerate(texts)], "text string, toxicity double")
    model = textmodels.fit_fast(df, c=10.0, max_iter=50)
    out = {r.message_id: r.classification for r in fast(
        spark, {"message_id": "bad", "content": "stupid bad idiot"}, {"message_id": "good", "content": "nice hello day"}, scorer=textmodels.model_scorer(model)).collect()}
    assert out["bad"].toxicity_score > 0.5 > out["good"].toxicity_score
    assert out["bad"].uncertainty == pytest.approx(0.5 - abs(out["bad"].toxicity_score - 0.5))
