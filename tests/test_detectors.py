import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.functions.scores import mix_confidence, robust_z, spike_confidence
from trailmark.operators import edges, kmeans
from trailmark.operators.clusters import centroid_distances, feature_vectors, kmeans_distances, navigation_edges
from trailmark.operators.mixshift import js_shift, mix_shifts
from trailmark.operators import referrers
from trailmark.operators.referrers import referrer_distribution
from trailmark.operators.spikes import spikes_against, traffic_spikes
from trailmark.plans.rolling import rolling_run

MONTHS = ["2024-01", "2024-02", "2024-03", "2024-04"]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_scalar_scores(spark):
    assert value(spark, robust_z(F.lit(100), F.lit(10), F.lit(2))) == pytest.approx(44.776, abs=1e-3)
    assert value(spark, robust_z(F.lit(5), F.lit(10), F.lit(2))) == pytest.approx(-2.488, abs=1e-3)
    assert value(spark, robust_z(F.lit(5), F.lit(10), F.lit(0), epsilon=0.0)) == 0.0
    high = value(spark, spike_confidence(F.lit(5.0), F.lit(15.0)))
    low = value(spark, spike_confidence(F.lit(0.5), F.lit(1.5)))
    assert high == pytest.approx(0.6140, abs=1e-4) and low == pytest.approx(0.2987, abs=1e-4)
    # missing parts count as zero; parts are bounded by ten
    assert value(spark, spike_confidence(F.lit(None).cast("double"), F.lit(None).cast("double"))) == pytest.approx(1 / (1 + math.e))
    assert value(spark, spike_confidence(F.lit(1e9), F.lit(1e9))) == pytest.approx(1 / (1 + math.exp(-9)))
    with pytest.raises(ValueError):
        spike_confidence(F.lit(1.0), F.lit(1.0), curve="other")


@pytest.mark.parametrize("changed, change, rule, expected", [
    (True, 0.01, "interpolated", 0.9), (False, 0.2, "interpolated", 0.5), (False, 1.0, "interpolated", 1.0),
    (False, 0.25, "proportional", 0.5), (False, 0.9, "proportional", 1.0),
])
def test_mix_confidence(spark, changed, change, rule, expected):
    assert value(spark, mix_confidence(F.lit(changed), F.lit(change), rule)) == pytest.approx(expected)


def steady(n=10, months=MONTHS, edge=("A", "B", "link")):
    return [(*edge, m, n) for m in months]


def test_baselines_leave_absent_months_out(clicks_of):
    rows = [("A", "B", "link", "2024-01", 10), ("A", "B", "link", "2024-01", 5), ("A", "B", "link", "2024-03", 30)]
    series = edges.edge_series(clicks_of(rows), MONTHS)
    assert series.first()["series"] == [15, None, 30, None]
    base = edges.edge_baselines(series).first()
    assert (base["baseline_median"], base["baseline_mean"], base["baseline_mad"]) == (15.0, 22.5, 7.5)
    assert base["baseline_std"] == pytest.approx(10.6066, abs=1e-4)
    single = edges.edge_baselines(edges.edge_series(clicks_of(rows[:1]), MONTHS)).first()
    assert single["baseline_std"] == 0.01 and single["baseline_mad"] == 0.0


def test_pairs_are_sums_over_types(clicks_of):
    rows = clicks_of(steady() + [("A", "B", "other", "2024-02", 7), ("C", "B", "other", "2024-02", 7)])
    own = sorted(map(tuple, edges.monthly_series(rows, ["curr", "prev"], MONTHS).collect()))
    assert sorted(map(tuple, edges.pairs_of(edges.edge_series(rows, MONTHS), MONTHS).collect())) == own


def test_period_baselines(spark, clicks_of):
    rows = clicks_of([("A", "B", "link", m, n) for m, n in zip(MONTHS, (1, 2, 3, 10))])
    got = edges.period_baselines(rows, ["prev", "curr"]).first()
    assert (got["baseline_median"], got["baseline_mean"], got["baseline_mad"]) == (2.0, 4.0, 2.5)


def test_zero_median_gives_ratio_zero(spark):
    traffic = spark.createDataFrame([("A", "B", "link", "2024-04", 50)], "prev string, curr string, type string, month string, n bigint")
    base = spark.createDataFrame([("A", "B", "link", 0.0, 1.0)], "prev string, curr string, type string, baseline_median double, baseline_mad double")
    spike = spikes_against(traffic, base).first()
    assert spike["deviation_ratio"] == 0.0 and spike["z_score"] == pytest.approx(50 / 1.01)
    assert spike["description"] == f"Statistical anomaly: Z-score = {50 / 1.01:.2f}"


def test_history_choices(clicks_of):
    rows = steady(10, MONTHS[:3]) + [("A", "B", "link", "2024-04", 200), ("N", "B", "link", "2024-04", 500)]
    series = edges.edge_series(clicks_of(rows), MONTHS)
    prior = traffic_spikes(series, MONTHS, history="prior").collect()
    assert [(r["prev"], r["deviation_ratio"]) for r in prior] == [("A", 20.0)]  # no history, no row
    assert prior[0]["description"] == "Traffic spike: 2024-04 traffic is 20.0x baseline"
    last_two = traffic_spikes(series, MONTHS, history=2).first()
    assert last_two["baseline_median"] == 10.0
    everything = traffic_spikes(series, MONTHS).collect()
    assert [r["prev"] for r in everything] == ["A"]
    assert everything[0]["z_score"] == pytest.approx(190 / 47.51, abs=1e-6)
    assert traffic_spikes(series, MONTHS, targets=["2024-02"]).count() == 0


def test_drops_count_as_spikes(clicks_of):
    rows = steady(1000, MONTHS[:3]) + [("A", "B", "link", "2024-04", 10)]
    found = traffic_spikes(edges.edge_series(clicks_of(rows), MONTHS), MONTHS, history="prior").first()
    assert found["z_score"] < -3.5 and found["deviation_ratio"] < 1


def ties():
    base = [(p, "P", "link", m, 50) for p in ("A", "B") for m in MONTHS[:3]]
    return base + [("A", "P", "link", "2024-04", 40), ("B", "P", "link", "2024-04", 40), ("C", "P", "link", "2024-04", 10)]


def test_mix_shift_ties(clicks_of):
    everything = mix_shifts(clicks_of(ties()), MONTHS, ties="all").collect()
    # two tops before, two now: the pairs of different names are changes
    assert sorted(r["description"] for r in everything) == [
        "Top referrer changed from A to B", "Top referrer changed from B to A",
    ]
    assert len({r["anomaly_id"] for r in everything}) == 2
    assert mix_shifts(clicks_of(ties()), MONTHS, ties="first").count() == 0
    with pytest.raises(ValueError):
        mix_shifts(clicks_of(ties()), MONTHS, ties="some")


def test_mix_shift_by_share(clicks_of):
    rows = [(p, "P", "link", m, n) for m in MONTHS[:3] for p, n in (("A", 60), ("B", 40))]
    rows += [("A", "P", "link", "2024-04", 90), ("B", "P", "link", "2024-04", 10)]
    found = mix_shifts(clicks_of(rows), MONTHS).first()
    assert found["prev"] == "A" and found["n"] == 100
    assert found["deviation_ratio"] == pytest.approx(0.3)
    assert found["confidence"] == pytest.approx(0.5625)
    assert found["description"] == "Top referrer proportion changed by 0.30"


def test_plan_does_not_grow_with_months(clicks_of):
    clicks = clicks_of(ties())
    long = [f"{y}-{m:02d}" for y in range(2017, 2025) for m in range(1, 13)]
    few, many = (mix_shifts(clicks, m)._jdf.queryExecution().optimizedPlan().toString().count("\n") for m in (MONTHS, long))
    assert few == many
    want = sorted(map(tuple, mix_shifts(clicks, MONTHS, targets=["2024-04"], min_baseline_months=1, use_js=True, js_threshold=0.0).collect()))
    assert want == sorted(map(tuple, mix_shifts(clicks, long, targets=["2024-04"], use_js=True, js_threshold=0.0).collect()))


def shift(clicks_of, before, now):
    rows = [(p, "P", "link", "2024-01", n) for p, n in before.items()]
    rows += [(p, "P", "link", "2024-04", n) for p, n in now.items()]
    return js_shift(clicks_of(rows), MONTHS).first()


def test_js_distance(clicks_of):
    apart = shift(clicks_of, {"A": 10, "B": 10}, {"C": 10, "D": 10})
    assert apart["js_distance"] == pytest.approx(math.sqrt(math.log(2)))
    assert apart["js_score"] == pytest.approx(0.41628, abs=1e-5)
    assert shift(clicks_of, {"A": 10, "B": 20, "C": 30}, {"A": 1, "B": 2, "C": 3})["js_distance"] == 0.0
    assert shift(clicks_of, {"A": 90, "B": 10}, {"A": 10, "B": 90})["js_distance"] == 0.0  # too few referrers


def test_shares_sum_to_one(clicks_of):
    rows = referrer_distribution(clicks_of(ties()))
    for total in rows.groupBy("curr", "month").agg(F.sum("proportion").alias("s")).collect():
        assert total["s"] == pytest.approx(1.0)


def test_rolling_run_equals_month_by_month(clicks_of):
    rows = ties() + steady(10, MONTHS[:3]) + [("A", "B", "link", "2024-04", 300)]
    months = [*MONTHS, "2024-05"]
    rows += [("C", "P", "link", "2024-05", 500)]
    clicks = clicks_of(rows)
    together = rolling_run(clicks, months, spikes={"history": "prior"})
    apart = []
    for i, month in enumerate(months[3:], start=3):
        known = clicks.filter(F.col("month").isin(months[: i + 1]))
        apart += rolling_run(known, months[: i + 1], min_baseline_months=i, spikes={"history": "prior"}).collect()
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart))
    assert {r["month"] for r in apart} == {"2024-04", "2024-05"}


def many_edges(clicks_of):
    rows = []
    for i in range(60):
        for j, m in enumerate(MONTHS):
            rows.append((f"p{i}", f"c{i % 7}", ("link", "external", "other")[i % 3], m, 20 + (i * 7 + j * 3) % 11))
    rows.append(("odd", "c0", "link", "2024-02", 5000))
    return edges.edge_series(clicks_of(rows), MONTHS)


def test_feature_vectors(clicks_of):
    row = feature_vectors(edges.edge_series(clicks_of([("A", "B", "link", "2024-02", 8)]), MONTHS), MONTHS).first()
    assert row["features_raw"] == [0, 0, 8, 1, 0, 0, 0, 0, 8, 8, 1, 0, 0]
    with pytest.raises(ValueError):
        feature_vectors(many_edges(clicks_of), [])


def test_kmeans_invariants(clicks_of):
    series = many_edges(clicks_of)
    scored = kmeans_distances(series, MONTHS, k=5).collect()
    assert len(scored) == 61 and all(r["distance_to_center"] >= 0 for r in scored)
    for cluster in {r["prediction"] for r in scored}:
        members = [r for r in scored if r["prediction"] == cluster]
        dims = range(len(members[0]["features"]))
        centre = [sum(r["features"][d] for r in members) / len(members) for d in dims]
        for r in members:
            away = math.sqrt(sum((r["features"][d] - centre[d]) ** 2 for d in dims))
            assert r["distance_to_center"] == pytest.approx(away, abs=1e-6)
    again = kmeans_distances(series, MONTHS, k=5).collect()
    assert sorted(r["distance_to_center"] for r in again) == sorted(r["distance_to_center"] for r in scored)
    found = navigation_edges(series, MONTHS, MONTHS[3:], k=5).collect()
    distances = [r["distance_to_center"] for r in scored]
    far = [d for d in distances if d >= np.percentile(distances, 95)]  # equal edges may tie at the threshold
    assert len(found) == len(far) >= 4
    assert all(0.5 <= r["confidence"] < 1 and r["anomaly_type"] == "navigation_edge" for r in found)
    as_of = navigation_edges(series, MONTHS, MONTHS[2:], k=5, scope="as_of")
    assert {r["month"] for r in as_of.collect()} == set(MONTHS[2:])
    with pytest.raises(ValueError):
        navigation_edges(series, MONTHS, MONTHS[3:], scope="never")


def test_centroid_distances(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0], 7), (2, [2.0, 0.0], 7), (3, [5.0, 5.0], 8)], "id int, v array<float>, c int")
    got = {r["id"]: r["distance_to_center"] for r in centroid_distances(rows, "id", "v", "c").collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0}


def brute_fit(raw, k, start_of, tolerance=1e-4, rounds=100):
    """Standardised features, and Lloyd's rounds from given centres, in plain numpy over all rows."""
    deviation = raw.std(axis=0, ddof=1)
    scaled = (raw - raw.mean(axis=0)) / np.where(deviation > 0, deviation, 1.0)
    centres = start_of(scaled)
    for _ in range(rounds):
        label = np.square(scaled[:, None] - centres[None]).sum(axis=2).argmin(axis=1)
        moved = np.array([scaled[label == c].mean(axis=0) if (label == c).any() else centres[c] for c in range(len(centres))])
        still = (np.linalg.norm(moved - centres, axis=1) <= tolerance).all()
        centres = moved
        if still:
            break
    label = np.square(scaled[:, None] - centres[None]).sum(axis=2).argmin(axis=1)
    return scaled, centres, label, np.linalg.norm(scaled - centres[label], axis=1)


def test_kmeans_does_not_depend_on_the_layout(clicks_of):
    series = many_edges(clicks_of)
    found = []
    for parts in (3, 17):
        rows = kmeans.with_draws(kmeans.as_of_rows(series.repartition(parts)), 42)
        found.append(kmeans.fit_spans(rows.repartition(parts), len(MONTHS), [2, len(MONTHS)], k=5))
    for a, b in zip(*found):
        assert a.span == b.span and (a.centres == b.centres).all() and (a.deviation == b.deviation).all()


def test_kmeans_against_brute_force(clicks_of):
    series = many_edges(clicks_of)
    vectors = {(r["prev"], r["curr"], r["type"]): r["features_raw"] for r in feature_vectors(series, MONTHS).collect()}
    names = sorted(vectors)
    rows = kmeans.with_draws(kmeans.as_of_rows(series), 42)
    fits = kmeans._standard(rows, len(MONTHS), [len(MONTHS)])
    kmeans._begin(rows, len(MONTHS), fits[0], 5, 42, 2)
    scaled, _, label, away = brute_fit(np.array([vectors[n] for n in names]), 5, lambda _: fits[0].centres / kmeans.STEP)
    got = {(r["prev"], r["curr"], r["type"]): r for r in kmeans_distances(series, MONTHS, k=5).collect()}
    for n, x, c, d in zip(names, scaled, label, away):
        assert got[n]["prediction"] == c and got[n]["distance_to_center"] == pytest.approx(d, abs=1e-5)
        assert got[n]["features"] == pytest.approx(list(x), abs=1e-5)


def test_as_of_features_are_those_of_the_months_so_far(clicks_of):
    rows = [("A", "B", "link", "2024-01", 4), ("A", "B", "link", "2024-03", 10), ("C", "B", "other", "2024-02", 6)]
    series = edges.edge_series(clicks_of(rows), MONTHS)
    stored = kmeans.as_of_rows(series).toArrow().combine_chunks().to_batches()[0]
    held = kmeans.Batch(stored, len(MONTHS))
    names = stored.column(stored.schema.get_field_index("prev")).to_pylist()
    for span in range(1, len(MONTHS) + 1):
        at, raw = held.features(span)
        part = series.withColumn("series", F.slice("series", 1, span)).filter(F.exists("series", lambda n: n.isNotNull()))
        want = {r["prev"]: r["features_raw"] for r in feature_vectors(part, MONTHS[:span]).collect()}
        assert {names[k]: list(x) for k, x in zip(at, raw)} == want
