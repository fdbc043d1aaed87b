"""Hand-made cases and brute-force comparisons on small frames."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac.functions import calendar as cal
from tarmac.functions import numeric as num
from tarmac.operators import detection, anomaly, clusters, density, filters, forest, joins, maintenance, paging, reliability, training, windows

D = date.fromisoformat
PART = ["aircraft_msn", "component_id"]


def tables(spark, failures, usage, alerts=()):
    maint = spark.createDataFrame(
        [(a, c, datetime.fromisoformat(t), e, s, 1.0) for a, c, t, e, s in failures],
        "aircraft_msn string, component_id string, event_timestamp timestamp, event_type string, is_scheduled boolean, duration_hours double",
    )
    used = spark.createDataFrame([(a, D(d), h, 2, 2) for a, d, h in usage], "aircraft_msn string, date date, flight_hours double, takeoffs int, landings int")
    raised = spark.createDataFrame(
        [(a, c, datetime.fromisoformat(t), s) for a, c, t, s in alerts], "aircraft_msn string, component_id string, event_timestamp timestamp, severity string"
    )
    return maint, used, raised


def test_history_counts_events_before_they_meet_their_components(spark):
    maint, usage, _ = tables(
        spark,
        [("A1", "c1", "2024-01-10 05:00:00", "FAILURE", False), ("A1", "c1", "2024-01-11 05:00:00", "FAILURE", True), ("A1", "c1", "2024-02-01 05:00:00", "REPAIR", True),
         ("A2", "c2", "2024-01-12 05:00:00", "FAILURE", False), ("A9", "gone", "2024-01-12 05:00:00", "FAILURE", False), ("A9", None, "2024-01-12 05:00:00", "FAILURE", False)],
        [("A1", "2024-01-09", 10.0), ("A1", "2024-01-10", 6.0)],
    )
    comps = spark.createDataFrame([("c1", "A1"), ("c2", "A2"), ("c2", "A2"), (None, "A1")], "component_id string, aircraft_msn string")
    comps = comps.withColumns({"component_type": F.lit("t"), "manufacturer": F.lit("m")})
    history = reliability.reliability_history(maint.drop("aircraft_msn"), usage, comps)
    rows = history.select("component_id", F.month("calculation_timestamp"), "total_failures", "unscheduled_failures", "mtbf_hours").collect()
    # a repeated component has its row twice, and each counts the event joined with both
    assert sorted(map(tuple, rows)) == [("c1", 1, 2, 1, 8.0), ("c1", 2, 0, 0, None), ("c2", 1, 2, 2, None), ("c2", 1, 2, 2, None)]


def test_reliability_edges(spark):
    maint, usage, alerts = tables(
        spark, [("A2", "c2", "2024-01-10 05:00:00", "FAILURE", False), ("A3", "c3", "2024-01-10 05:00:00", "FAILURE", True)],
        [("A1", "2024-01-09", 10.0), ("A2", "2024-01-09", 0.0)],
    )
    comps = spark.createDataFrame(
        [("c1", "A1"), ("c2", "A2"), ("c3", "A3")], "component_id string, aircraft_msn string"
    ).withColumns({"component_name": F.lit("n"), "component_type": F.lit("t")})
    out = {r.component_id: r for r in reliability.component_reliability(maint, alerts, usage, comps, "2024-01-10", periods=(7,)).collect()}
    assert (out["c1"].mtbf_hours, out["c1"].failure_rate_per_1000_hours) == (None, 0.0)
    assert (out["c2"].mtbf_hours, out["c2"].failure_rate_per_1000_hours) == (0.0, None)
    assert (out["c3"].total_flight_hours, out["c3"].mtbf_hours, out["c3"].failure_rate_per_1000_hours) == (None, None, None)
    # a bare date as the end leaves out what happened during that day
    early = reliability.component_reliability(maint, alerts, usage, comps, "2024-01-10", periods=(7,), whole_last_day=False)
    assert early.agg(F.sum("total_failures")).first()[0] == 0


def test_intervals_of_single_and_same_day_events(spark):
    maint, *_ = tables(
        spark,
        [("A", "one", "2024-01-01 00:00:00", "CHECK", True), ("A", "same", "2024-01-01 01:00:00", "CHECK", True),
         ("A", "same", "2024-01-01 09:00:00", "CHECK", True), ("A", "two", "2024-01-01 12:00:00", "CHECK", True),
         ("A", "two", "2024-01-02 11:00:00", "CHECK", True), ("A", "two", "2024-01-04 11:00:00", "FAILURE", False)],
        [("A", "2024-01-01", 1.0)],
    )
    by_day = {(r.component_id, r.interval_days) for r in windows.day_intervals(maint, PART, "event_timestamp").collect()}
    assert by_day == {("two", 1), ("two", 2)}
    every = windows.event_intervals(maint, PART, "event_timestamp", ["event_type", "is_scheduled"]).collect()
    assert [(r.component_id, r.interval_days, r.event_type) for r in every] == [("two", 2, "FAILURE")]


def test_as_of_and_look_ahead(spark):
    rows = spark.createDataFrame([("A", "c", D("2024-01-10"))], "aircraft_msn string, component_id string, day date")
    events = lambda *days: spark.createDataFrame([("A", "c", D(d)) for d in days], "aircraft_msn string, component_id string, e date")
    since = lambda *days: joins.days_since_last(rows, events(*days), PART, "day", "e", "n").first().n
    assert since("2024-01-10") == 365
    assert since("2024-01-10", "2024-01-09", "2024-01-02") == 1
    ahead = lambda *days: joins.event_ahead(rows, events(*days), PART, "day", "e", "x").first().x
    assert ahead("2024-01-17") and not ahead("2024-01-18") and not ahead("2024-01-10")


def test_interval_totals_match_brute_force(spark):
    rng = np.random.default_rng(3)
    start = date(2024, 1, 1)
    facts = pd.DataFrame({"k": rng.integers(0, 3, 400), "d": [start + timedelta(days=int(x)) for x in rng.integers(0, 60, 400)], "v": rng.integers(1, 9, 400) * 1.0})
    spans = pd.DataFrame({"k": rng.integers(0, 4, 80), "i": range(80), "a": rng.integers(0, 70, 80), "n": rng.integers(0, 30, 80)})
    spans["s"] = [start + timedelta(days=int(x)) for x in spans.a]
    spans["e"] = [start + timedelta(days=int(x)) for x in spans.a + spans.n]
    got = joins.interval_totals(
        spark.createDataFrame(spans[["k", "i", "s", "e"]]), spark.createDataFrame(facts), ["k"], "s", "e", "d", {"v": F.sum("v"), "c": F.count("*")}, ["v"]
    ).collect()
    assert len(got) == 80
    for r in got:
        inside = facts[(facts.k == r.k) & (facts.d >= r.s) & (facts.d <= r.e)]
        assert (r.v, r.c) == (inside.v.sum() if len(inside) else None, len(inside))


def test_interval_totals_keep_every_digit(spark):
    """Hours of fractions after a day of 10^9, and one of 10^15, are summed as if those days did not exist."""
    start = date(2024, 1, 1)
    for first in (1e9, 1e15):
        values = [first, first / 7] + [0.1 + 0.013 * (i % 9) for i in range(60)]
        facts = spark.createDataFrame([("a", start + timedelta(days=i), v) for i, v in enumerate(values)], "k string, d date, v double")
        spans = [(2 + i, min(2 + i + n, 61)) for i in range(0, 55, 6) for n in (0, 3, 30)]
        df = spark.createDataFrame([("a", i, start + timedelta(days=s), start + timedelta(days=e)) for i, (s, e) in enumerate(spans)], "k string, i int, s date, e date")
        got = {r.i: r.v for r in joins.interval_totals(df, facts, ["k"], "s", "e", "d", {"v": F.sum("v")}).collect()}
        for i, (s, e) in enumerate(spans):
            # the far day is added as a double, and taken away again without a rest
            assert got[i] == float(sum((Decimal(repr(v)) for v in values[s : e + 1]), Decimal(0)).quantize(Decimal(10) ** -15))


def test_running_totals_cross_slices_and_ties(spark):
    rows = [(i % 2, datetime(2024, 1, 1) + timedelta(hours=7 * (i // 3)), i) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v long")
    for r in windows.running_totals(df.withColumn("raw", F.col("v")), ["k"], "t", {"upto": F.col("raw")}).collect():
        assert r.upto == sum(v for k, t, v in rows if k == r.k and t <= r.t)


@pytest.mark.parametrize("q", ["0.05", "0.5", "0.95", "1.0"])
def test_group_quantile_is_exact(spark, q):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "warm", "one"], 6000, p=[0.9, 0.0999, 0.0001]), "v": rng.normal(size=6000).round(3)})
    pdf.loc[pdf.sample(2500, random_state=1).index, "v"] = 0.25
    got = {r.g: r.x for r in windows.group_quantile(spark.createDataFrame(pdf), ["g"], "v", q, "x").collect()}
    for g, values in pdf.groupby("g").v:
        rank = max(1, int(np.ceil(round(float(q) * len(values), 9))))
        assert got[g] == sorted(values)[rank - 1]


def test_pages_number_every_row(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id")
    rows = paging.number_pages(df, [F.desc("k"), F.asc("id")], 30, partitions=5).orderBy("position").collect()
    assert [(r.k, r.id) for r in rows] == sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    assert all(r.position == i and r.page == i // 30 and r.total == 1000 for i, r in enumerate(rows))


def test_before_after_counts_every_pair(spark):
    rng = np.random.default_rng(8)
    stamp = lambda n: [datetime(2024, 1, 1) + timedelta(hours=int(h)) for h in rng.integers(0, 400, n)]
    m = pd.DataFrame({"c": rng.integers(0, 4, 120), "t": stamp(120), "v": rng.random(120), "ty": "x"})
    m.loc[::9, "v"] = None
    ch = pd.DataFrame({"c": rng.integers(0, 4, 12), "ct": stamp(12)})
    metrics = spark.createDataFrame(m).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    r = joins.split_before_after(metrics, spark.createDataFrame(ch), "c", "t", "ct", ["v"], ["ty"]).first()
    pairs = m.merge(ch, on="c")
    before, after = pairs[pairs.t < pairs.ct], pairs[pairs.t >= pairs.ct]
    assert (r.pairs_before, r.pairs_after) == (len(before), len(after))
    assert r.v_before == pytest.approx(before.v.mean()) and r.v_after == pytest.approx(after.v.mean())


def test_alert_of_a_part_without_work_is_lost_only_beside_other_work(spark):
    usage = spark.createDataFrame([("A",), ("B",), ("C",)], "aircraft_msn string")
    worked = spark.createDataFrame([("A", "p1", 3)], "aircraft_msn string, component_id string, events int")
    raised = spark.createDataFrame([("A", "p1", 1), ("A", "p2", 5), ("B", "p9", 2)], "aircraft_msn string, component_id string, alerts int")
    out = {(r.aircraft_msn, r.component_id, r.events, r.alerts) for r in joins.join_either_side(usage, worked, raised, *PART).collect()}
    assert out == {("A", "p1", 3, 1), ("B", "p9", None, 2)}


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, t int, v string")
    assert {r.v for r in joins.latest_per_key(df, ["k"], "t").collect()} == {"y", "z", "w"}


def test_guards_and_ladders(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (4.0, None)], "n double, d double")
    out = df.select(*[num.safe_ratio("n", "d", g).alias(g) for g in ("null", "zero", "floor")]).collect()
    assert [tuple(r) for r in out] == [(2.0, 2.0, 2.0), (None, 0.0, 4.0), (None, 0.0, 4.0)]
    steps = [r[0] for r in spark.createDataFrame([(5.0,), (5.1,), (2.0,)], "x double").select(num.ladder("x", [(5, "a"), (2, "b")], "c")).collect()]
    assert steps == ["b", "a", "c"]


def test_null_aware_filter(spark):
    df = spark.createDataFrame([("RESOLVED",), ("OPEN",), (None,)], "status string")
    assert {r.status for r in df.filter(filters.differs_or_null("status", "RESOLVED")).collect()} == {"OPEN", None}


def test_previous_month():
    assert cal.previous_month("2024-01-15") == (date(2023, 12, 1), date(2023, 12, 31))
    assert cal.previous_month("2024-03-01") == (date(2024, 2, 1), date(2024, 2, 29))


def test_component_analysis_matches_loops(spark):
    rng = np.random.default_rng(4)
    events = [("A", f"c{rng.integers(0, 4)}", str(datetime(2024, 1, 1) + timedelta(hours=int(h))), "REPAIR", bool(h % 2)) for h in rng.integers(0, 500, 40)]
    use = [("A", str(date(2024, 1, 1) + timedelta(days=i)), float(i % 5)) for i in range(0, 20, 2)]
    maint, usage, alerts = tables(spark, events, use, [("A", "c1", "2024-01-02 00:00:00", "INFO")])
    comps = spark.createDataFrame([(f"c{i}", "n", "A", 10) for i in range(5)], "component_id string, component_name string, aircraft_msn string, recommended_maintenance_interval int")
    got = {r.component_id: r for r in maintenance.component_analysis(maint, usage, alerts, comps).collect()}
    pdf = pd.DataFrame(events, columns=["a", "c", "t", "e", "s"]).assign(t=lambda x: pd.to_datetime(x.t)).sort_values("t")
    hours = {D(d): h for _, d, h in use}
    for c, g in pdf.groupby("c"):
        if len(g) < 2:
            assert c not in got
            continue
        pairs = list(zip(g.t[:-1], g.t[1:]))
        assert got[c].avg_actual_interval_days == pytest.approx(np.mean([(b - a).days for a, b in pairs]))
        flown = [sum(h for d, h in hours.items() if a.date() <= d <= b.date()) for a, b in pairs]
        assert got[c].avg_flight_hours_between_maintenance == pytest.approx(np.mean(flown))


def test_failure_frame_matches_loops(spark):
    rng = np.random.default_rng(6)
    at = lambda h: str(datetime(2024, 1, 1) + timedelta(hours=int(h)))
    events = [("A", f"c{i % 3}", at(h), "FAILURE" if h % 3 else "CHECK", bool(h % 2)) for i, h in enumerate(rng.integers(-100, 1100, 25))]
    alerts = [("A", f"c{i % 4}", at(h), "CRITICAL" if h % 2 else "INFO") for i, h in enumerate(rng.integers(0, 900, 25))]
    maint, usage, raised = tables(spark, events, [("A", "2024-01-03", 5.0), ("A", "2024-02-05", 6.0)], alerts)
    comps = spark.createDataFrame([(f"c{i}", "t", "m") for i in range(4)], "component_id string, component_type string, manufacturer string")
    fleet = spark.createDataFrame([("A", "X")], "aircraft_msn string, airline_code string")
    samples = spark.createDataFrame(
        [("A", "f1", datetime(2024, 1, 10, 5), 1.0), ("A", "f2", datetime(2024, 1, 10, 6), 3.0), ("A", "f2", datetime(2024, 1, 10, 7), 5.0)],
        "aircraft_msn string, flight_id string, event_timestamp timestamp, engine_1_temp double",
    )
    got = training.failure_frame(maint, comps, fleet, usage, samples, raised).collect()
    assert len(got) == 3 * 34
    day = lambda t: datetime.fromisoformat(t).date()
    for r in got:
        mine = [(day(t), e == "FAILURE" and not s) for _, c, t, e, s in events if c == r.component_id]
        earlier = [d for d, _ in mine if d < r.date]
        assert r.days_since_last_maintenance == ((r.date - max(earlier)).days if earlier else 365)
        assert r.failure_next_7d == any(bad and r.date < d <= r.date + timedelta(days=7) for d, bad in mine)
        raised_here = [s for _, c, t, s in alerts if c == r.component_id and day(t) == r.date]
        assert (r.total_alerts, r.critical_alerts) == (len(raised_here), raised_here.count("CRITICAL"))
        # one flight of mean 1, one of mean 4; known on one day and filled both ways
        assert r.avg_engine_1_temp == 2.5


def test_days_of_the_failure_frame_keep_repeated_use_and_gaps(spark):
    maint, usage, raised = tables(
        spark, [("A", "c1", "2024-03-20 00:00:00", "CHECK", True), ("B", "c2", "2024-01-05 00:00:00", "CHECK", True)],
        [("A", "2024-03-30", 5.0), ("A", "2024-03-30", 7.0), ("B", "2024-04-02", 1.0), ("C", "2024-01-03", 9.0)], [("A", "c1", "2024-04-01 00:00:00", "INFO")],
    )
    comps = spark.createDataFrame([(f"c{i}", "t", "m") for i in range(4)], "component_id string, component_type string, manufacturer string")
    fleet = spark.createDataFrame([("A", "X"), ("B", "Y")], "aircraft_msn string, airline_code string")
    samples = spark.createDataFrame([("A", "f1", datetime(2024, 2, 10), 2.0), ("A", "f2", datetime(2024, 4, 1), 4.0)], "aircraft_msn string, flight_id string, event_timestamp timestamp, engine_1_temp double")
    got = training.failure_frame(maint, comps, fleet, usage, samples, raised).collect()
    # from the first to the last known day, 3 January to 2 April; the day with two rows of use comes twice
    days = [date(2024, 1, 3) + timedelta(days=i) for i in range(91)]
    assert sorted((r.component_id, r.date) for r in got) == sorted([("c1", d) for d in [*days, date(2024, 3, 30)]] + [("c2", d) for d in days])
    used = {(r.component_id, r.date, r.flight_hours) for r in got if r.flight_hours}
    assert used == {("c1", date(2024, 3, 30), 5.0), ("c1", date(2024, 3, 30), 7.0), ("c2", date(2024, 4, 2), 1.0)}
    assert {(r.component_id, r.avg_engine_1_temp) for r in got if r.date < date(2024, 4, 1)} == {("c1", 2.0), ("c2", 0.0)}
    assert {r.avg_engine_1_temp for r in got if r.component_id == "c1" and r.date >= date(2024, 4, 1)} == {4.0}
    assert [(r.date, r.total_alerts) for r in got if r.total_alerts] == [(date(2024, 4, 1), 1)]


@pytest.mark.parametrize("d", [1, 2, 3, 4, 7])
def test_density_noise_matches_brute_force(spark, d):
    rng = np.random.default_rng(d)
    parts = []
    for g in range(2):
        x = np.vstack([rng.normal(0, 0.3, (120, d)), rng.normal(4, 1.5, (50, d)), np.repeat(rng.normal(8, 1, (2, d)), 6, axis=0), rng.uniform(-10, 10, (15, d))])
        parts.append(pd.DataFrame(x, columns=[f"x{i}" for i in range(d)]).assign(g=g))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["row"] = range(len(pdf))
    eps = {1: 0.15, 2: 0.4, 3: 0.7, 4: 1.0, 7: 1.5}[d]
    expected = {}
    for _, q in pdf.groupby("g"):
        x = q[[f"x{i}" for i in range(d)]].to_numpy()
        near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
        core = near.sum(1) >= 5
        expected.update(zip(q.row, ~core & ~(near & core[None]).any(1)))
    out = density.density_noise(spark.createDataFrame(pdf), ["g"], [f"x{i}" for i in range(d)], eps, 5).collect()
    assert {r.row: r.is_noise for r in out} == expected


def test_density_settles_small_groups_in_one_shuffle(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(np.vstack([rng.normal(0, 0.4, (150, 2)), rng.uniform(-6, 6, (60, 2))]), columns=["a", "b"])
    pdf["g"], pdf["row"] = np.where(np.arange(210) % 3 == 0, 1, 2), range(210)
    rows = [*pdf[["g", "row", "a", "b"]].itertuples(index=False, name=None), (None, 210, 9.0, 9.0), (1, 211, None, 2.0), (2, 212, 1.0, 50.0)]
    df = spark.createDataFrame([(None if g is None else int(g), int(r), a, b) for g, r, a, b in rows], "g int, row int, a double, b double")
    whole, cells, mixed = (density.density_noise(df, ["g"], ["a", "b"], 0.5, 5, min_rows=10, task_rows=n) for n in (500, 0, 100))
    found = [{r.row: r.is_noise for r in x.collect()} for x in (whole, cells, mixed)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 213
    assert found[0][212] and not found[0][210] and not found[0][211]
    # no row is copied into the cells around it
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_density_skips_small_groups(spark):
    rows = [("few", float(i), float(i)) for i in range(9)] + [("many", float(i % 2), 0.0) for i in range(10)]
    out = density.density_noise(spark.createDataFrame(rows, "g string, a double, b double"), ["g"], ["a", "b"], 0.5, 5, min_rows=10).collect()
    assert {(r.g, r.is_noise) for r in out} == {("few", None), ("many", False)} and len(out) == 19


def test_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(4000, 3)), columns=list("abc")).assign(g=np.arange(4000) % 4, row=range(4000))
    pdf.loc[[5, 6, 7, 8], ["a", "b", "c"]] = [9.0, -9.0, 9.0]
    history, recent = pdf[pdf.row >= 8], pdf[pdf.row < 400]
    make = lambda p: spark.createDataFrame(p)
    out = forest.isolation_outliers(make(history), make(recent), "g", list("abc")).toPandas()
    assert len(out) == 400
    assert set(out.sort_values("anomaly_score").head(4).row) == {5, 6, 7, 8}
    again = forest.isolation_outliers(make(history), make(recent), "g", list("abc")).toPandas()
    assert out.set_index("row").anomaly_score.round(9).to_dict() == again.set_index("row").anomaly_score.round(9).to_dict()


def test_preorder_forest_scores_like_a_walk_from_node_to_node():
    data = np.random.default_rng(3).normal(size=(300, 3))
    data[:40] = data[0]
    at, tree = forest.sampled(np.arange(300), np.zeros(300), 1.0, 5, 256, 1)
    assert np.bincount(tree).tolist() == [256] * 5 and all(len(set(at[tree == t])) == 256 for t in range(5))
    m, roots, feature, value, jump = forest.grow(data[at], tree, 5, 1)

    def reach(x, node):
        if feature[node] < 0:
            return node
        return reach(x, node + jump[node] if x[feature[node]] > value[node] else node + 1)

    paths = [np.mean([value[reach(x, r)] for r in roots]) for x in data]
    expected = -np.exp2(-np.array(paths) / forest.average_path(m))
    np.testing.assert_allclose(forest.outlier_score(data, m, roots, feature, value, jump), expected)
    # a tree's nodes lie together, and each has been reached from its root: n inner nodes and n + 1 leaves
    for t in range(5):
        of_tree = feature[roots[t] : (list(roots) + [len(feature)])[t + 1]]
        assert (of_tree >= 0).sum() + 1 == (of_tree < 0).sum()


def test_trees_draw_by_gaps_with_one_rate():
    n, trees, share = 200_000, 100, 384 / 200_000
    first = np.floor(np.log(forest.unit_hash(np.arange(n), 7, 9)) / np.log1p(-share))
    met = np.flatnonzero(first < trees)
    assert abs(len(met) / n - (1 - (1 - share) ** trees)) < 0.005
    at, tree = forest.draws(met, first[met], share, trees, 5)
    counts = np.bincount(tree, minlength=trees)
    assert counts.min() > 256 and abs(counts.mean() - 384) < 8 and len(set(zip(at, tree))) == len(at)


def test_forest_scores_do_not_depend_on_chunks(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(size=(900, 2)), columns=list("ab")).assign(g=0, row=range(900)))
    df = forest.numbered(df)
    forests = forest.fit_forests(df, "g", ["a", "b"], trees=20)
    one, many = [forest.score_forests(df, forests, "g", ["a", "b"], n).toPandas().set_index("row").raw_score.to_dict() for n in (10_000, 100)]
    assert one == many


def test_forests_are_kept_in_little_more_than_their_rows(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({c: rng.normal(size=1200) for c in "abcdefg"}).assign(k=np.arange(1200) % 2)
    forests, limits = forest.materialise_forests(forest.numbered(spark.createDataFrame(pdf)), "k", list("abcdefg"))
    sizes = [sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in forests.collect()]
    assert len(sizes) == 2 and limits.count() == 2
    # 600 rows of seven numbers
    assert max(sizes) < 2 * 600 * 8 * 8


def test_groups_in_one_task_are_judged_as_in_chunks(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(1500, 2)), columns=list("ab")).assign(g=np.repeat(["x", "y", None], 500), row=range(1500))
    pdf.loc[pdf.row % 50 == 0, "a"] = None
    df = spark.createDataFrame(pdf, "a double, b double, g string, row long").repartition(1)
    judge = lambda rows, n, least=1: forest.judge_themselves(rows, "g", ["a", "b"], 0.05, 20, 256, 42, 10_000, least, n)
    one, many, mixed = [
        {r.row: (r.g, r.a, r.anomaly_score, r.is_anomaly) for r in judge(rows, n).collect()}
        for rows, n in ((df, 1000), (df, 100), (df.filter("g = 'x' OR row < 550"), 100))
    ]
    # rows without a key belong to no group
    assert one == many and len(one) == 1000 and sum(v[3] for v in one.values()) in range(40, 60)
    assert len(mixed) == 550
    assert {r.is_anomaly for r in judge(df, 1000, 501).collect()} == {None}


def test_repeated_rows_are_all_scored(spark):
    """A large group of three distinct points beside a small random one: no row may be lost."""
    many = spark.range(1_000_000).selectExpr("'hot' AS g", "CAST(id % 3 AS DOUBLE) AS x", "CAST((id % 3) * 2 AS DOUBLE) AS y", "id AS row")
    few = spark.range(500).selectExpr("'few' AS g", "rand(1) AS x", "rand(2) AS y", "id AS row")
    df = many.unionByName(few)
    for out, column in (
        (clusters.kmeans_outliers(df, "g", ["x", "y"], components=2), "distance_to_center"),
        (forest.isolation_outliers(df, df, "g", ["x", "y"], trees=10), "anomaly_score"),
    ):
        got = {r.g: (r.n, r.scored) for r in out.groupBy("g").agg(F.count("*").alias("n"), F.count(column).alias("scored")).collect()}
        assert got == {"hot": (1_000_000, 1_000_000), "few": (500, 500)}


def test_rows_without_a_model_stay(spark):
    rows = [("a", float(i), float(i % 7), i) for i in range(200)]
    history, recent = [spark.createDataFrame(r, "g string, x double, y double, row long") for r in (rows, rows[:5] + [("new", 1.0, 1.0, 999)])]
    got = {r.row: r.is_anomaly for r in forest.isolation_outliers(history, recent, "g", ["x", "y"], trees=10).collect()}
    assert len(got) == 6 and got[999] is None and None not in [got[i] for i in range(5)]


def test_kmeans_finds_separate_groups_and_flags_a_twentieth(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0, 0], [20, 0, 0], [0, 20, 0], [0, 0, 20], [20, 20, 20]])
    pdf = pd.DataFrame(np.vstack([rng.normal(c, 1, (100, 3)) for c in centres]), columns=list("xyz")).assign(g="a", true=np.repeat(range(5), 100))
    few = pdf.head(50).assign(g="few")
    out = clusters.kmeans_outliers(spark.createDataFrame(pd.concat([pdf, few])), "g", list("xyz")).toPandas()
    assert set(out.g) == {"a"} and out.is_anomaly.sum() == pytest.approx(25, abs=1)
    assert out.groupby("true").cluster.nunique().max() == 1 and out.cluster.nunique() == 5


def test_kmeans_starts_come_from_all_rows(spark):
    """A far cluster of 12 rows beside 60 000 others gets a centre, however the rows are dealt; copies weigh as rows."""
    rng = np.random.default_rng(11)
    big = pd.DataFrame({"x": rng.normal(0, 1, 60_000), "y": rng.normal(0, 1, 60_000), "true": 0})
    far = pd.DataFrame({"x": rng.normal(5000, 1, 12), "y": rng.normal(0, 1, 12), "true": 1})
    copies = pd.DataFrame({"x": [0.0] * 30_000, "y": [9000.0] * 30_000, "true": 2})
    df = spark.createDataFrame(pd.concat([big, far, copies])).withColumn("g", F.lit("a"))
    odd = df.limit(1).select(F.lit(None).cast("double").alias("x"), F.lit(1.0).alias("y"), F.lit(3).alias("true"), "g")
    found = [clusters.grouped_kmeans(d, "g", ["x", "y"], 3).first()._centres for d in (df.repartition(3), df.repartition(17), df.unionByName(odd))]
    assert np.allclose(sorted(found[0]), sorted(found[1])) and np.allclose(sorted(found[0]), sorted(found[2]))
    assert np.allclose(sorted(found[0])[1:], [[0, 9000], [far.x.mean(), far.y.mean()]], atol=0.1) or np.allclose(sorted(found[0])[2], [far.x.mean(), far.y.mean()])
    sizes = clusters.assign(df, clusters.grouped_kmeans(df, "g", ["x", "y"], 3), "g", ["x", "y"], 3).groupBy("cluster", "true").count().collect()
    assert sorted((r["true"], r["count"]) for r in sizes) == [(0, 60_000), (1, 12), (2, 30_000)]


@pytest.mark.parametrize("task_points", [10_000, 0])
def test_kmeans_of_few_points_and_of_none(spark, task_points):
    df = spark.createDataFrame([("a", 1.0, 2.0)] * 4 + [("a", 3.0, 2.0)] + [("b", 7.0, 7.0)] + [("c", None, 1.0)], "g string, x double, y double")
    got = {r.g: sorted(r._centres) for r in clusters.grouped_kmeans(df, "g", ["x", "y"], task_points=task_points).collect()}
    assert got == {"a": [[1.0, 2.0], [3.0, 2.0]], "b": [[7.0, 7.0]]}
    placed = clusters.assign(df, clusters.grouped_kmeans(df, "g", ["x", "y"], task_points=task_points), "g", ["x", "y"]).collect()
    assert len(placed) == 7 and {r.g: r.distance_to_center for r in placed} == {"a": 0.0, "b": 0.0, "c": None}
    assert clusters.grouped_kmeans(df.limit(0), "g", ["x", "y"], task_points=task_points).count() == 0


def test_constant_feature_is_never_abnormal(spark):
    df = spark.createDataFrame([("a", 1.0, float(i)) for i in range(30)] + [("a", 1.0, 500.0)], "k string, same double, v double")
    out = anomaly.deviating_parameters(df, ["k"], ["same", "v"]).filter(F.size("abnormal_parameters") > 0).collect()
    assert [(r.v, [p.parameter for p in r.abnormal_parameters]) for r in out] == [(500.0, ["v"])]


def test_stratified_split_shares(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id < 900 AS INT) AS label")
    out = training.stratified_split(df, "label", ["id"]).groupBy("label").agg(F.count_if("is_train").alias("n")).collect()
    assert {r.label: r.n for r in out} == {1: 720, 0: 80}


def test_scores_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (2, 1)], "y int, p int")
    r = training.weighted_scores(df, "y", "p").first()
    assert (r.accuracy, r.weighted_precision, r.weighted_recall) == (0.5, 0.25, 0.5)
    assert r.weighted_f1 == pytest.approx(0.5 * 2 * 0.5 / 1.5)


def test_failure_classifier_learns_a_planted_signal(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x": rng.normal(size=600), "kind": rng.choice(["a", "b"], 600), "key": range(600)})
    pdf["bad"] = (pdf.x + (pdf.kind == "a") + rng.normal(0, 0.3, 600)) > 1
    df = spark.createDataFrame(pdf)
    for kind in ("forest", "boosted"):
        model = training.failure_classifier(df, ["x"], ["kind"], "bad", kind, sizes=(5,), depths=(3,), folds=2)
        out = training.predict_failures(model, df, ["key", "bad"], ["x"]).toPandas()
        assert out[out.bad].failure_probability.mean() > 0.6 > 0.4 > out[~out.bad].failure_probability.mean()


def test_forest_draws_and_walks_take_few_passes(monkeypatch):
    from tarmac.operators import forest

    rng, calls, real = np.random.default_rng(12), [], forest.unit_hash
    x = np.round(rng.normal(size=(600, 4)) * 9, 1)
    drawn = forest._drawn(np.arange(600), 1 - rng.random(600), x, 600, 100, 256, 7)
    monkeypatch.setattr(forest, "unit_hash", lambda *a: calls.append(1) or real(*a))
    at, tree = forest.draws(drawn["rows"], drawn["first"], drawn["share"], 100, 7)
    # several gaps of all rows at once, not one at a time; no tree draws a row twice
    assert len(calls) < 10 and len({*zip(at.tolist(), tree.tolist())}) == len(at) and abs(len(at) / 600 - 100 * drawn["share"]) < 3
    m, roots, feature, value, jump = forest.grown(drawn)
    paths = []
    for row in x[:40]:
        ends = []
        for node in roots:
            while feature[node] >= 0:
                node = node + (jump[node] if row[feature[node]] > value[node] else 1)
            ends.append(value[node])
        paths.append(-(2 ** -(np.mean(ends) / float(forest.average_path(m)))))
    assert np.allclose(forest.outlier_score(x, m, roots, feature, value, jump)[:40], paths)


def test_detection_chain_finds_planted_anomalies(spark, tmp_path):
    rng = np.random.default_rng(11)
    make = lambda n, g: pd.DataFrame(rng.normal(size=(n, 4)) * [1, 2, 3, 4] + [5, 6, 7, 8], columns=list("abcd")).assign(g=g)
    history = pd.concat([make(600, "x"), make(600, "y"), make(20, "few")])
    recent = pd.concat([make(80, "x"), make(80, "y"), make(5, "few")]).assign(row=range(165))
    recent.loc[recent.row.isin([3, 90]), ["a", "b", "c", "d"]] = [25.0, -30.0, 60.0, -70.0]
    old, new = spark.createDataFrame(history), spark.createDataFrame(recent)
    fitted = detection.fit_detectors(old, "g", list("abcd"))
    fitted.save(str(tmp_path / "detectors"))
    again = detection.Detectors.load(spark, str(tmp_path / "detectors"))
    out = [{r.row: r for r in detection.detect_anomalies(old, new, "g", list("abcd"), d, eps=2.0).collect()} for d in (fitted, again)]
    assert out[0] == out[1]
    assert out[0][3].detection_method == out[0][90].detection_method == "BOTH" and out[0][3].confidence_score == 0.95
    assert {p["parameter"] for p in __import__("json").loads(out[0][3].abnormal_parameters)} == set("abcd")
    assert not {r.g for r in out[0].values()} - {"x", "y"} and len(out[0]) < 60


def test_text_models_beat_the_majority(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from tarmac.operators import textmodels

    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        words = [f"w{rng.integers(60)}x" for _ in range(25)]
        if i % 4 == 0:
            words[int(rng.integers(25))] = "rotten"
        rows.append((i, " ".join(words), float(i % 4 == 0), bool(i % 2)))
    df = spark.createDataFrame(rows, "id int, text string, toxicity double, is_friends boolean")
    train, test = df.filter("id < 200"), df.filter("id >= 200")
    judge = BinaryClassificationEvaluator(labelCol="toxicity", rawPredictionCol="toxicity_score")
    network = lambda d: textmodels.fit_network(d, max_iter=20)
    for fit, least in ((textmodels.fit_fast, 0.8), (textmodels.fit_context, 0.8), (network, 0.6)):
        assert judge.evaluate(textmodels.scores(fit(train), test)) > least
