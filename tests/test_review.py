"""The review queue as stream state: against brute force over micro-batches, restarts and decisions."""

from pyspark.sql import functions as F

from tarmac.sources import writers
from tarmac.streaming import review

SCHEMA = "message_id string, arrival long, text string, decided boolean"


class Landing:
    """A folder that gets one file a micro-batch, and a queue that is started anew for each of them."""

    def __init__(self, spark, path, **options):
        self.spark, self.path, self.options, self.files = spark, path, options, 0

    def put(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        self.files += 1

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")
        snapshots = review.queue_snapshots(stream, "arrival", decided=F.col("decided"), **self.options)
        return writers.run_to_files(snapshots, f"{self.path}/out", f"{self.path}/ck")


def waiting(stored, length):
    return [(r.message_id, r.arrival) for r in review.current_queue(stored, length).collect()]


def test_newest_after_several_batches_and_a_restart(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), length=10, lanes=4)
    sent = [(f"m{i:03d}", (i * 37) % 101, f"t{i}", False) for i in range(120)]
    for a in range(0, 60, 20):
        landing.put(sent[a : a + 20])
    newest = lambda rows: sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[1], r[0]))[-10:]
    assert waiting(landing.run(), 10) == newest(sent[:60])
    # a new run goes on from the state: older messages, repeats, null ids and null arrivals change nothing
    landing.put([("m001", 37, "again", False), (None, 999, "no id", False), ("x", None, "no arrival", False), ("old", -5, None, False)])
    landing.put(sent[60:])
    stored = landing.run()
    assert waiting(stored, 10) == newest(sent)
    assert stored.groupBy("lane", "version").count().filter("count > 10").count() == 0
    payloads = {r.message_id: r.payload for r in review.current_queue(stored, 10).collect()}
    assert all(f'"text":"t{int(ident[1:])}"' in text for ident, text in payloads.items())


def test_decisions_free_places_as_in_a_bounded_list(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), length=5, lanes=1)
    batches = [
        [(f"a{i}", i, "", False) for i in range(8)],
        [("a7", None, None, True), ("a5", None, None, True), ("unknown", None, None, True)],
        [("b1", 20, "", False), ("b2", 21, "", True), ("a6", 6, "repeat", False)],
        [("b2", 21, "", False), ("b3", 22, "", False), ("b3", None, None, True)],
        [(i, None, None, True) for i in ("a3", "a4", "a6", "b1", "b2")],
    ]
    model: list[tuple[str, int]] = []
    for rows in batches:
        landing.put(rows)
        gone = {r[0] for r in rows if r[3]}
        model = [m for m in model if m[0] not in gone]
        for ident, arrival, _, decided in rows:
            if not decided and ident not in gone and ident not in {m[0] for m in model}:
                model = sorted([*model, (ident, arrival)], key=lambda m: (m[1], m[0]))[-5:]
        assert waiting(landing.run(), 5) == model
    assert model == []


def test_equal_arrivals_and_an_empty_stream(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), length=3, lanes=2)
    landing.put([])
    assert waiting(landing.run(), 3) == []
    landing.put([(i, 1, None, False) for i in "abcdefg"])
    assert waiting(landing.run(), 3) == [("e", 1), ("f", 1), ("g", 1)]


def test_a_message_leaves_by_itself(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), length=3, lanes=1, ttl_ms=1)
    landing.put([("a", 1, None, False)])
    landing.run()
    landing.put([("b", 2, None, False)])
    assert waiting(landing.run(), 3) == [("b", 2)]
