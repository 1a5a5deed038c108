import numpy as np
import pandas as pd
import pytest

from trailmark.operators.edges import edge_series
from trailmark.operators.forecasts import arima_111, change_point_fit, change_point_forecast, dated_series, exact_innovations, forecast_metrics
from trailmark.plans.rolling import enrich_with_forecasts
from trailmark.schema import FORECASTS, as_anomalies

MONTHS = [f"2024-{m:02d}" for m in range(1, 9)]


def run(clicks_of, values, **options):
    rows = [("A", "B", "link", m, n) for m, n in zip(MONTHS, values) if n]
    months = MONTHS[: len(values)]
    return forecast_metrics(edge_series(clicks_of(rows), months), months, **options)


def test_moving_average_by_hand(clicks_of):
    got = run(clicks_of, [10, 20, 30, 40], method="moving_avg").first()
    assert got["forecast_n"] == pytest.approx(30)
    assert got["forecast_lower"] == pytest.approx(13.997, abs=1e-3)
    assert got["forecast_upper"] == pytest.approx(46.003, abs=1e-3)
    assert got["forecast_error"] == pytest.approx(10)
    assert got["forecast_ratio"] == pytest.approx(4 / 3)
    assert got["forecast_flag"] is False


@pytest.mark.parametrize("method", ["moving_avg", "trend", "exponential", "arima", "auto"])
def test_constant_series(clicks_of, method):
    got = run(clicks_of, [25] * 6, method=method).first()
    for name in ("forecast_n", "forecast_lower", "forecast_upper"):
        assert got[name] == pytest.approx(25, abs=1e-6)


@pytest.mark.parametrize("method", ["trend", "exponential", "arima"])
def test_rising_series_is_continued(clicks_of, method):
    got = run(clicks_of, [10 * i for i in range(1, 9)], method=method).first()
    assert got["forecast_n"] == pytest.approx(90, abs=2.5)


def test_short_series(clicks_of):
    assert run(clicks_of, [10, 20]).count() == 0
    got = run(clicks_of, [10, 20], min_history=2).first()
    assert (got["forecast_n"], got["forecast_lower"], got["forecast_upper"]) == (0.0, 0.0, 0.0)
    assert got["forecast_flag"] is True


def test_schema_and_missing_target(clicks_of):
    empty = run(clicks_of, [10, 20, 30, None])
    assert empty.count() == 0
    assert empty.schema.fieldNames() == FORECASTS.fieldNames()


def test_target_left_out_of_the_fit(clicks_of):
    got = run(clicks_of, [10, 10, 10, 500], method="moving_avg", include_target=False).first()
    assert got["forecast_n"] == 10 and got["forecast_flag"] is True
    assert got["forecast_ratio"] == pytest.approx(50, abs=1e-4)


def test_unknown_method(clicks_of):
    with pytest.raises(ValueError):
        run(clicks_of, [1, 2, 3], method="guess")


def dense_arima(steps, phi, theta):
    """Exact Gaussian likelihood, innovation variance and next step of an ARMA(1,1), by its whole covariance matrix."""
    n = len(steps)
    gamma = [(1 + 2 * phi * theta + theta**2) / (1 - phi**2), (1 + phi * theta) * (phi + theta) / (1 - phi**2)]
    for _ in range(n):
        gamma.append(phi * gamma[-1])
    cov = np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])
    solved = np.linalg.solve(cov, steps)
    variance = max(steps @ solved / n, 1e-12)
    ahead = np.array([gamma[n - j] for j in range(n)])
    left = gamma[0] - ahead @ np.linalg.solve(cov, ahead)
    return -0.5 * (n * (np.log(2 * np.pi * variance) + 1) + np.linalg.slogdet(cov)[1]), variance, ahead @ solved, left


def test_exact_likelihood_against_the_whole_covariance():
    rng = np.random.default_rng(2)
    for n in (2, 5, 30):
        steps = rng.normal(size=(4, n)) * 20
        phi, theta = rng.uniform(-0.9, 0.9, (4, 3)), rng.uniform(-0.9, 0.9, (4, 3))
        got = exact_innovations(steps, phi, theta)
        for i in range(4):
            for j in range(3):
                want = dense_arima(steps[i], phi[i, j], theta[i, j])
                assert [x[i, j] for x in got] == pytest.approx(list(want), rel=1e-6)


def test_arima_finds_the_most_likely_parameters():
    rng = np.random.default_rng(1)
    series = [list(rng.integers(10, 200, size=n).astype(float)) for n in (3, 5, 8, 8, 40)]
    got = arima_111(pd.Series([*series, [1.0], None]))
    for i, y in enumerate(series):
        steps = np.diff(y)
        grid = [(phi, theta) for phi in np.linspace(-0.99, 0.99, 67) for theta in np.linspace(-0.99, 0.99, 67)]
        found = [(*dense_arima(steps, *p), p) for p in grid]
        top = max(found, key=lambda f: f[0])
        if i == 4:  # a long series has one clear best
            assert got["n"][i] == pytest.approx(max(y[-1] + top[2], 0), abs=2)
            assert got["upper"][i] == pytest.approx(y[-1] + top[2] + 1.96 * np.sqrt(top[1] * top[3]), rel=0.02)
        assert got["lower"][i] <= got["n"][i] <= got["upper"][i]
    assert got["n"][5:].isna().all()


def test_a_planted_break_is_found_within_a_month():
    rng = np.random.default_rng(3)
    x = np.arange(60) * 30.0
    for broken in (18, 27, 36):
        y = 100 + 2.0 * np.arange(60) + np.where(np.arange(60) > broken, 9.0 * (np.arange(60) - broken), 0) + rng.normal(size=60) * 2
        intercept, slope, changes, places, deviation = change_point_fit(x[None], y[None])
        centre = (changes[0] * places[0]).sum() / changes[0].sum()  # of the change of slope
        assert abs(centre - 30.0 * broken) <= 30.0 and changes[0].sum() * 30 == pytest.approx(9, abs=0.5)
        assert deviation[0] < 6
        ahead = change_point_forecast(pd.Series([[{"x": a, "y": b, "next": a + 30.0} for a, b in zip(x, y)]]))
        assert ahead["n"][0] == pytest.approx(100 + 2 * 60 + 9 * (60 - broken), abs=8)


def brute_bent_line(x, y, penalty_of, sweeps=4000):
    """The same convex problem for one series and a fixed penalty, by small proximal steps over all parameters."""
    t, z = (x - x[0]) / (x[-1] - x[0]), y / np.abs(y).max()
    inner = int(np.floor(len(x) * 0.8)) - 1
    at = np.unique(np.round(np.linspace(0, inner, min(25, inner) + 1)[1:]).astype(int))
    line = np.stack([np.ones_like(t), t], axis=1)
    bends = np.maximum(t[:, None] - t[at][None, :], 0)
    free = bends - line @ np.linalg.lstsq(line, bends, rcond=None)[0]
    left = z - line @ np.linalg.lstsq(line, z, rcond=None)[0]
    changes, rate = np.zeros(len(at)), 1 / np.linalg.norm(free, 2) ** 2
    for _ in range(sweeps):
        moved = changes + rate * free.T @ (left - free @ changes)
        changes = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty_of, 0)
    residual = left - free @ changes
    return 0.5 * residual @ residual + penalty_of * np.abs(changes).sum(), changes * np.abs(y).max() / (x[-1] - x[0])


def test_change_points_solve_the_penalised_problem():
    rng = np.random.default_rng(4)
    x = np.arange(24) * 30.0
    y = 50 + 3 * np.arange(24) + np.where(np.arange(24) > 10, -5 * (np.arange(24) - 10), 0) + rng.normal(size=24)
    z = y / np.abs(y).max()
    line = np.stack([np.ones(24), x], axis=1)
    first = z - line @ np.linalg.lstsq(line, z, rcond=None)[0]
    penalty = np.mean(first**2) / 0.05
    got = change_point_fit(np.stack([x, x]), np.stack([y, y]), outer=1, sweeps=3000)[2]
    _, want = brute_bent_line(x, y, penalty, 60_000)
    assert np.allclose(got[0], got[1]) and np.allclose(got[0], want, atol=2e-3)


def test_straight_series_has_no_break(clicks_of):
    got = run(clicks_of, [10 * i for i in range(1, 9)], method="change_points").first()
    assert got["forecast_n"] == pytest.approx(90, abs=2.5)
    assert run(clicks_of, [25] * 6, method="change_points").first()["forecast_n"] == pytest.approx(25, abs=1e-6)


def test_dated_series(clicks_of):
    rows = dated_series(edge_series(clicks_of([("A", "B", "link", "2024-03", 4), ("A", "B", "link", "2024-01", 2)]), MONTHS), MONTHS)
    assert [(p["month"], str(p["date"]), p["n"]) for p in rows.first()["points"]] == [
        ("2024-01", "2024-01-01", 2), ("2024-03", "2024-03-01", 4),
    ]


def test_enrichment_defaults_and_tag(spark, clicks_of):
    anomalies = as_anomalies(
        spark.createDataFrame(
            [("1", "2024-04", "A", "B", "link", "traffic_spike"), ("2", "2024-04", "Z", "B", "link", "mix_shift")],
            "anomaly_id string, month string, prev string, curr string, type string, anomaly_type string",
        )
    )
    forecasts = run(clicks_of, [10, 10, 10, 500], method="moving_avg", include_target=False)
    got = {r["anomaly_id"]: r for r in enrich_with_forecasts(anomalies, forecasts).collect()}
    assert got["1"]["anomaly_type"] == "traffic_spike_forecast_spike" and got["1"]["forecast_n"] == 10
    assert got["2"]["anomaly_type"] == "mix_shift"
    assert (got["2"]["forecast_n"], got["2"]["forecast_ratio"], got["2"]["forecast_flag"]) == (0.0, 1.0, False)
