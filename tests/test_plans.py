"""Physical plans and library rules."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarmac.functions.calendar import on_day
from tarmac.operators import joins, training, windows
from tarmac.plans.views import Fleet
from tarmac.session import materialise
from tarmac.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"
LIBRARY = Path(__file__).resolve().parents[1] / "tarmac"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fleet(spark):
    return Fleet(spark, FOLDER)


def test_no_quadratic_joins(fleet):
    part = ["aircraft_msn", "component_id"]
    day = F.to_date("event_timestamp").alias("day")
    spans = windows.day_intervals(fleet.maint.filter("is_scheduled"), part, "event_timestamp")
    frames = [
        joins.interval_totals(spans, fleet.usage, ["aircraft_msn"], "start_date", "end_date", "date", {"h": F.sum("flight_hours")}),
        joins.days_since_last(fleet.alerts.select(*part, day).distinct(), fleet.maint.select(*part, day), part, "day", "day", "n"),
        joins.event_ahead(fleet.alerts.select(*part, day).distinct(), fleet.maint.select(*part, day), part, "day", "day", "x"),
        joins.cross_calendar(fleet.components, F.min("date"), F.max("date"), fleet.usage),
    ]
    for df in frames:
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def test_failure_frame_is_taken_apart_after_its_last_shuffle(fleet):
    frame = training.failure_frame(fleet.maint, fleet.components, fleet.aircraft, fleet.usage, fleet.flights, fleet.alerts)
    text = plan(frame)
    # from the top: the days come out of the joined lists, no join and no exchange lies above them
    assert "inline" in text and text.index("Generate inline") < text.index("Join") and text.index("Generate inline") < text.index("Exchange")
    assert not re.search(r"(currentrow\$\(\)|\b1), unboundedfollowing", text)


def test_days_of_the_failure_frame_come_out_of_generated_code(fleet):
    frame = training.failure_frame(fleet.maint, fleet.components, fleet.aircraft, fleet.usage, fleet.flights, fleet.alerts)
    days = plan(frame).split("Generate inline")[1].splitlines()[0]
    # a function with a lambda would take the days of every stretch out of generated code
    assert "lambda" not in days and "filter(" not in days


def test_figures_nobody_asks_for_are_not_carried(fleet):
    frame = training.failure_frame(fleet.maint, fleet.components, fleet.aircraft, fleet.usage, fleet.flights, fleet.alerts)
    asked = plan(frame.select("date", "failure_next_7d"))
    assert "engine_1_temp" not in asked and "component_type" not in asked and "takeoffs" not in asked
    assert "engine_1_temp" in plan(frame.select("date", "avg_engine_1_temp"))


def test_the_regression_reads_its_input_once(spark):
    rows = spark.range(300).selectExpr("id", *[f"CAST(id % {i + 3} AS DOUBLE) AS {c}" for i, c in enumerate(training.RISK_FEATURES)])
    risks = rows.join(spark.range(300).selectExpr("id", "CAST(id % 5 AS DOUBLE) AS failure_risk").repartition(3, "id"), "id")
    assert "Join" in plan(risks)
    _, tested, rmse = training.risk_regression(risks, ["id"], trees=3)
    assert "Join" not in plan(tested) and 0 < tested.count() < 150 and rmse >= 0


def test_top_k_is_cut_before_the_shuffle(fleet):
    text = plan(windows.top_k(fleet.alerts, ["severity"], [F.desc("event_timestamp")], 3))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    text = plan(joins.latest_per_key(fleet.alerts, ["component_id"], "event_timestamp"))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_day_filter_reaches_the_scan(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet").filter(on_day("ts", "2024-01-05")).select("event_id")
    text = plan(df)
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in text.split("ReadSchema")[1]


def test_day_folder_is_pruned(spark, tmp_path):
    rows = spark.range(60).selectExpr("id", "concat('A', id % 3) AS airline", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS date")
    writers.write_parquet(rows, str(tmp_path / "p"), ["airline", "date"])
    day = readers.read_partitioned(spark, str(tmp_path / "p"), "id bigint", "2024-01-02", ["A1"])
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan(day))
    assert {r.id for r in day.collect()} == {i for i in range(60) if i % 3 == 1 and i % 5 == 1}


def test_stored_stages_lie_in_the_shared_folder(spark):
    stored = materialise(spark.range(5).withColumn("x", F.rand(1)))
    assert stored.inputFiles()[0].split("://")[-1].lstrip("/").startswith(spark.conf.get("spark.checkpoint.dir").lstrip("/"))
    assert stored.collect() == stored.collect()


def test_library_keeps_rows_on_the_cluster():
    # the optional text operators have a test of their own
    for path in (p for p in LIBRARY.rglob("*.py") if "llm" not in p.relative_to(LIBRARY).parts):
        text = path.read_text()
        for word in ("toPandas", "localCheckpoint", "crossJoin", ".rdd", "collect()"):
            assert word not in text, f"{word} in {path.name}"


def test_stored_stages_can_be_released(spark, tmp_path, monkeypatch):
    from tarmac import session

    monkeypatch.setattr(session, "_PATHS", [])
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file://{tmp_path}")
    assert session.materialise(spark.range(5)).count() == 5
    assert len(list(tmp_path.iterdir())) == 1
    assert session.release(spark) == 1 and not list(tmp_path.iterdir()) and session.release(spark) == 0


def test_a_wide_side_is_not_broadcast(spark):
    from tarmac.operators import sizing
    from tarmac.session import materialise

    wide = materialise(spark.range(40).selectExpr("id", "transform(sequence(1, 100000), x -> rand()) AS numbers"))
    assert sizing.stored_bytes(wide) > sizing.BROADCAST_BYTES
    plan = sizing.sized_join(spark.range(9), wide, ["id"], stored=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def _tiny(spark, folder):
    """Two parts with a few events each, in the driver's schema."""
    items = [(k, p, 1 + p % 2, 1 + k % 3, 10.0 + k, "RAN"[k % 3], "OF"[(k + p) % 2], f"2000-0{1 + k % 9}-{1 + k // 2:02d}") for k in range(20) for p in (1, 2)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate string"
    stamp = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    stamp(spark.createDataFrame(items, columns), "l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    stamp(spark.createDataFrame([(k, "2000-03-05", "1-URGENT") for k in range(20)], "o_orderkey long, o_orderdate string, o_orderpriority string"), "o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(p, f"n{p}", "t", "b", 30) for p in (1, 2)], "p_partkey long, p_name string, p_type string, p_brand string, p_size long").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(s, 1, 100.0) for s in (1, 2)], "s_suppkey long, s_nationkey long, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    events = spark.createDataFrame([(1, 1, "2000-01-01", "error", 50.0)], "event_id long, user_id long, ts string, event_type string, value double")
    stamp(events, "ts").write.parquet(f"{folder}/events.parquet")


def test_recommendations_are_computed_once_for_all_figures(spark, tmp_path):
    """What several branches of a result read is stored, so none of them joins or reads the items again."""
    from __spark_entry__ import queries

    _tiny(spark, str(tmp_path))
    change, counts = (queries()[n](spark, str(tmp_path)) for n in ("agg_pct_change", "agg_category_counts"))
    plan = change._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "l_partkey" not in plan
    assert "l_partkey" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert change.count() >= 1 and {r.chart for r in counts.collect()} >= {"recommendation", "event", "severity"}


def test_component_analysis_looks_up_covered_stretches_only(spark, monkeypatch):
    from tarmac.operators import maintenance as mnt

    seen, plain = [], mnt.interval_totals
    monkeypatch.setattr(mnt, "interval_totals", lambda spans, *a, **k: seen.append(spans) or plain(spans, *a, **k))
    days = ["2024-01-01 08:00:00", "2024-01-04 08:00:00", "2024-01-04 20:00:00", "2024-01-09 07:00:00"]
    work = spark.createDataFrame([(1, d, True) for d in days] + [(2, days[0], False)], "component_id long, event_timestamp string, is_scheduled boolean")
    work = work.withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    usage = spark.createDataFrame([(7, f"2024-01-0{d}", 1.0) for d in range(1, 10)], "aircraft_msn long, date string, flight_hours double").withColumn("date", F.to_date("date"))
    # a component that is listed twice counts twice
    parts = spark.createDataFrame([(1, "a", 7, 30), (1, "a", 7, 30), (2, "b", 7, 30), (1, "z", 8, 30)], "component_id long, component_name string, aircraft_msn long, recommended_maintenance_interval long")
    alerts = spark.createDataFrame([(1,)], "component_id long")
    got = {r.component_id: r for r in mnt.component_analysis(work, usage, alerts, parts).collect()}
    # four days, one day and six days flown between four events; gaps of 3, 0 and 4 whole days
    assert set(got) == {1} and got[1].total_maintenance_events == 8 and got[1].alert_count == 1
    assert got[1].avg_actual_interval_days == 2 * 7 / 7 and abs(got[1].avg_flight_hours_between_maintenance - 2 * 11 / 7) < 1e-9
    assert seen[0].count() == 3 and "component_name" not in seen[0].columns
