"""Files, routes and the arguments handed to a database reader."""

from datetime import date

import pytest
from pyspark.errors import PySparkException

from tarmac.sources import readers, schemas, writers


def test_csv_header_must_match(spark, tmp_path):
    writers.write_csv(spark.sql("SELECT 'a' AS aircraft_msn, 1 AS wrong"), str(tmp_path / "c"))
    with pytest.raises(Exception) as e:
        readers.read_csv(spark, str(tmp_path / "c"), "aircraft_msn string, takeoffs int").collect()
    assert isinstance(e.value, PySparkException) or "header" in str(e.value).lower()


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"alert_code": "X", "severity": "INFO"},\n {"alert_code": "Y", "severity": "CRITICAL"}]')
    rows = readers.read_json(spark, str(tmp_path / "a.json"), schemas.ALERT, array_files=True).collect()
    assert [r.alert_code for r in rows] == ["X", "Y"]


def test_document_ids(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": {"$oid": "5f"}, "name": "a"}\n{"_id": "plain", "name": "b"}\n{"_id": 7, "name": "c"}\n')
    rows = readers.read_documents(spark, str(tmp_path / "d.json"), "_id string, name string").collect()
    assert [r._id for r in rows] == ["5f", "plain", "7"]


def test_routes_by_file_and_columns(spark, tmp_path):
    files = {
        "x.json": '{"engine_1_temp": 1}', "y.json": '{"event_type": "CHECK"}', "maintenance_2024.json": '{"event_type": "CHECK"}',
        "weather_data_1.json": '{"t": 1}', "technical_bulletins.json": '{"b": 1}', "airline_data.json": '{"a": 1}', "bad.json": "{no",
    }
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    rows = readers.read_routed(spark, str(folder)).groupBy("route").count().collect()
    assert {r.route: r["count"] for r in rows} == {
        "flight_data": 1, "maintenance_events": 1, "weather_data": 1, "technical_bulletins": 1, "airline_metadata": 1, "unknown": 2,
    }


def test_one_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(10).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 2 AS INT)) AS date")
    writers.write_parquet(rows, path, ["date"])
    writers.write_parquet(rows.filter("id = 1"), path, ["date"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 4, 6, 8]


class Recorder:
    """Stands in for a session and keeps the arguments of a database read."""

    def __init__(self):
        self.read, self.calls = self, []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))


def test_database_reads_are_split(spark):
    r = Recorder()
    readers.read_jdbc(r, "url", "t", {"user": "u"}, column="id", bounds=(0, 100), partitions=4)
    assert r.calls[-1][1]["numPartitions"] == 4 and r.calls[-1][1]["column"] == "id"
    days = readers.day_predicates("ts", [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)])
    assert days == ["ts >= '2024-01-01' AND ts < '2024-01-02'", "ts >= '2024-01-02' AND ts < '2024-01-03'"]
    readers.read_jdbc(r, "url", "t", {}, predicates=days)
    assert r.calls[-1][1]["predicates"] == days


def test_compressed_dumps_are_routed_like_plain_ones(spark, tmp_path):
    rows = spark.range(500).selectExpr("CAST(id AS DOUBLE) AS engine_1_temp", "id % 7 AS flight_id", "'sensors' AS origin")
    for name, compression in (("plain", None), ("packed", "gzip")):
        writers.write_json_report(rows, str(tmp_path / name / "maintenance_log"), compression)
        writers.write_json_report(rows.selectExpr("'CHECK' AS event_type"), str(tmp_path / name / "maintenance_more"), compression)
    routed = lambda name: sorted(readers.read_routed(spark, [str(tmp_path / name / f) for f in ("maintenance_log", "maintenance_more")]).collect())
    assert routed("plain") == routed("packed") and {r.route for r in routed("packed")} == {"flight_data", "maintenance_events"}
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).rglob("part-*"))
    assert size("packed") * 4 < size("plain")
