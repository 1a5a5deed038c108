import datetime

import pytest
from pyspark.sql import functions as F

from trailmark.operators.edges import edge_series
from trailmark.operators.referrers import nested_top_referrers, top_referrers
from trailmark.plans import explain, pageviews, reports
from trailmark.schema import as_anomalies

MONTHS = [f"2024-{m:02d}" for m in range(1, 9)]
FIELDS = "anomaly_id string, month string, prev string, curr string, type string, n bigint, baseline_median double, deviation_ratio double, z_score double, anomaly_type string, confidence double, forecast_n double, forecast_upper double, forecast_error double, forecast_flag boolean"


def row(id_, month="2024-04", prev="A", curr="B", kind="traffic_spike", ratio=2.0, z=0.0, conf=0.5, n=1234, median=10.0, **more):
    return (id_, month, prev, curr, "link", n, median, ratio, z, kind, conf, more.get("f", 0.0), more.get("up", 0.0), more.get("err", 0.0), more.get("flag", False))


@pytest.fixture
def table(spark):
    return lambda rows: as_anomalies(spark.createDataFrame(rows, FIELDS))


def ids(df):
    return [r["anomaly_id"] for r in df.collect()]


def test_two_tier_order(table):
    rows = [row("a", ratio=1.0, conf=0.99), row("b", ratio=3.0), row("c", ratio=9.0), row("d", ratio=0.2, conf=0.1), row("e", ratio=3.0, conf=0.9)]
    rows.append(row("x", ratio=None))
    assert ids(reports.browse_two_tier(table(rows))) == ["c", "e", "b", "a", "d"]
    assert ids(reports.browse_two_tier(table(rows), limit=2)) == ["c", "e"]


def test_browse_filters(table):
    rows = [row("a", conf=0.2), row("b", conf=0.8, kind="mix_shift"), row("c", month="2024-05", conf=0.9)]
    assert ids(reports.browse(table(rows))) == ["c", "b", "a"]
    assert ids(reports.browse(table(rows), month="2024-04", min_confidence=0.5)) == ["b"]
    assert ids(reports.browse(table(rows), anomaly_type="traffic_spike", limit=1)) == ["c"]
    assert ids(reports.browse(table(rows), limit=None, min_confidence=0)) == ["c", "b", "a"]


def test_interest_falls_back(spark, table):
    rows = table([row("a", ratio=4.0, conf=0.5), row("b", ratio=1.0, conf=1.0)])
    assert reports.most_interesting(rows, 1).first()["interest_score"] == 2.0
    assert reports.most_interesting(rows, 1, "weighted").first()["interest_score"] == pytest.approx(3.4)
    assert reports.most_interesting(rows.drop("confidence"), 1).first()["interest_score"] == 4.0
    assert reports.most_interesting(rows.drop("deviation_ratio"), 1).first()["interest_score"] == 1.0
    assert reports.most_interesting(rows.drop("deviation_ratio", "confidence"), 1).first()["interest_score"] == 1.0


def test_stats_of_an_empty_table(table):
    got = reports.anomaly_stats(table([row("a")]).limit(0)).collect()
    assert [tuple(r) for r in got] == [("total", "all", 0, 0.0)]
    assert reports.insights(table([row("a")]).limit(0)).count() == 0


def test_crosstab(table):
    rows = [row("a"), row("b", kind="mix_shift", flag=True), row("c", month="2024-05", kind="traffic_spike_forecast_spike")]
    got = [tuple(r) for r in reports.type_by_month(table(rows)).collect()]
    assert got == [("2024-04", 1, 1, 0, 1), ("2024-05", 0, 0, 0, 0)]
    assert reports.type_by_month(table(rows), flag_only=False).collect()[1]["forecast_spike"] == 1


def test_precision(spark, table):
    truth = spark.createDataFrame([("A",), ("Z",)], "page string")
    rows = table([row("a"), row("b", prev="Q", curr="Z"), row("c", prev="A", curr="Z"), row("d", prev="Q")])
    assert tuple(reports.precision_at_k(rows, truth, 50).first()) == (3, 0.06)
    assert tuple(reports.precision_at_k(rows, truth, 0).first()) == (0, 0.0)


def test_anomaly_graph(table):
    rows = table([row("a", prev="x" * 60, conf=0.9), row("b", conf=0.1)])
    nodes = {r["id"]: r["label"] for r in reports.graph_nodes(rows, k=1).collect()}
    assert nodes == {"x" * 60: "x" * 50, "B": "B"}
    assert reports.graph_edges(rows, k=1).first()["weight"] == 0.9
    assert ids(reports.anomaly_by_id(rows, "b")) == ["b"]


@pytest.mark.parametrize("kind, ratio, z, flag, style, expected", [
    ("other", 1.0, 0.0, False, "full", ["Anomaly Detected"]),
    ("other", 1.0, 0.0, False, "short", []),
    ("traffic_spike", 10.0, 3.5, True, "full", ["Traffic Spike", "Forecast Deviation", "High Deviation Ratio", "MAD-Z Score"]),
    ("mix_shift", 10.0, -3.5, False, "short", ["Mix Shift", "MAD-Z Score", "High Deviation"]),
    ("navigation_edge", 9.99, -3.6, False, "plain", ["Navigation Edge", "High Z-score"]),
])
def test_signals(table, kind, ratio, z, flag, style, expected):
    rows = table([row("a", kind=kind, ratio=ratio, z=z, flag=flag)])
    assert explain.signals(rows, style).first()["signals"] == expected


def test_graph_signal(table):
    rows = table([row("a")]).withColumns({"gnn_flag": F.lit(True), "gnn_score": F.lit(0.98765)})
    assert "GNN Outlier" in explain.signals(rows).first()["signals"]
    assert "(score: 0.988)" in explain.explanations(rows, site="page").first()["explanation"]


def test_explanation_text(table):
    rows = table([row("a", ratio=12.35, z=4.0, conf=0.875, flag=True, f=99.5, up=120.4)])
    assert explain.explanations(rows).first()["explanation"] == (
        "This anomaly detected in 2024-04 shows unusual traffic from 'A' to 'B'. "
        "Traffic spiked to 1,234 transitions (12.3x the baseline median of 10). "
        "Statistical analysis shows a robust Z-score of 4.00, indicating a significant deviation from normal patterns. "
        "Time-series forecasting predicted 100 transitions (upper bound: 120), but actual traffic was 1,234, exceeding the forecast. "
        "Overall confidence: 87.5%"
    )


@pytest.mark.parametrize("z, ratio, err, expected", [
    (3.5, 10.0, 20.1, ("anomaly", "anomaly", "anomaly")),
    (-2.0, 5.0, -15.0, ("elevated", "elevated", "elevated")),
    (1.9, 4.9, 10.0, ("normal", "normal", "normal")),
])
def test_status(table, z, ratio, err, expected):
    got = explain.signal_status(table([row("a", z=z, ratio=ratio, err=err)])).first()["detection_signals"]
    assert (got["z_score"]["status"], got["deviation_ratio"]["status"], got["forecast_error"]["status"]) == expected


def test_filled_series(table, clicks_of):
    clicks = clicks_of([("A", "B", "link", "2024-02", 20), ("A", "B", "link", "2024-04", 40)])
    rows = table([row("b", month="2024-05", median=9.0), row("a", median=7.0), row("u", prev="U", n=77)])
    series = edge_series(clicks, MONTHS)
    got = {(r["prev"], r["month"]): (r["traffic"], r["baseline_median"]) for r in explain.filled_series(rows, series, MONTHS).collect()}
    assert len(got) == 9 and got[("A", "2024-01")] == (0, 7.0) and got[("A", "2024-04")] == (40, 7.0)
    assert got[("U", "2024-04")] == (77, 10.0)
    present = explain.filled_series(rows, series, MONTHS, fill=False)
    assert sorted(r["month"] for r in present.collect() if r["prev"] == "A") == ["2024-02", "2024-04"]


def test_referrer_changes(clicks_of):
    rows = []
    for page, tops in {"P": "ABBAC", "Q": "AAAAA", "R": "A"}.items():
        for month, top in zip(MONTHS[-len(tops):], tops):
            rows += [(top, page, "link", month, 60), ("rest", page, "link", month, 40)]
    shares = nested_top_referrers(top_referrers(clicks_of(rows), MONTHS))
    got = {r["curr"]: (r["top_referrer_flip"], r["major_mix_shift"]) for r in explain.referrer_changes(shares).collect()}
    assert got == {"P": (True, True), "Q": (False, False), "R": (False, False)}


def test_usual_top_prefers_the_earliest(clicks_of):
    rows = [(top, "P", "link", month, 60) for month, top in zip(MONTHS[3:], "ABBAA")]
    shares = nested_top_referrers(top_referrers(clicks_of(rows), MONTHS))
    assert explain.referrer_changes(shares).first()["top_referrer_flip"] is False


def test_details(spark, table, clicks_of):
    clicks = clicks_of([("A", "B", "link", m, 10 * (i + 1)) for i, m in enumerate(MONTHS)])
    views = spark.createDataFrame(
        [("B", datetime.date(2024, 4, 14), 500), ("B", datetime.date(2024, 4, 1), 10), ("B", datetime.date(2024, 7, 1), 9)],
        "page string, date date, views bigint",
    )
    rows = table([row("a"), row("n", prev="new", curr="nowhere")])
    got = {r["anomaly_id"]: r for r in explain.anomaly_details(rows, clicks, MONTHS, views).collect()}
    assert [p["n"] for p in got["a"]["timeseries_6m"]] == [30, 40, 50, 60, 70, 80]
    assert len(got["a"]["referrer_shares"]) == 6
    assert got["a"]["daily_spike_match"] is True and [d["views"] for d in got["a"]["daily_pageviews"]] == [10, 500]
    assert got["n"]["timeseries_6m"] == [] and got["n"]["daily_pageviews"] == [] and got["n"]["daily_spike_match"] is False
    text = explain.detail_json(explain.anomaly_details(rows, clicks, MONTHS)).first()["detail"]
    assert text.startswith('{"anomaly_id":')


def test_pageview_joins(spark, table):
    views = spark.createDataFrame([("B", datetime.date(2024, 3, 2), 1), ("B", datetime.date(2024, 3, 1), 2), ("B", datetime.date(2024, 5, 1), 3)], "page string, date date, views bigint")
    rows = table([row("a"), row("b", curr="none")])
    around = pageviews.views_around(rows, views)
    assert sorted(r["views"] for r in around.collect()) == [1, 3]  # 30 days each way, both ends included
    joined = pageviews.with_pageviews(rows, views).collect()
    assert sorted((r["anomaly_id"], r["views"] or 0) for r in joined) == [("a", 1), ("a", 2), ("a", 3), ("b", 0)]


def test_edge_history_takes_what_is_there(table):
    rows = table([row("b", month="2024-05"), row("a"), row("z", prev="Z")])
    got = explain.edge_history(rows, "A", "B", "link")
    assert "baseline_mad" not in got.columns and [r["month"] for r in got.collect()] == ["2024-04", "2024-05"]
