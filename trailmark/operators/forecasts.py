"""Forecasts of edge series and the comparison of actual traffic with them."""

from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.schema import EDGE

METHODS = ("auto", "trend", "change_points", "arima", "exponential", "moving_avg")
FLOOR = 0.1  # counts are raised to this before fitting
NORMAL_95 = 1.96
NORMAL_80 = 1.2815515655446004
# All pairs of smoothing factors 0.1 .. 0.9.
SMOOTHING_GRID = """flatten(transform(sequence(1, 9), a ->
    transform(sequence(1, 9), b -> named_struct('a', a / 10D, 'b', b / 10D))))"""
ARIMA_GRID = np.round(np.arange(-0.95, 0.951, 0.1), 2)


def _day(month: str, ahead: int = 0) -> int:
    year, number = int(month[:4]), int(month[5:7]) - 1 + ahead
    return (date(year + number // 12, number % 12 + 1, 1) - date(1970, 1, 1)).days


def series_points(months: list[str]) -> Column:
    """Present months of ``series`` as (x = day of month start, y = floored count, next)."""
    days = ", ".join(f"named_struct('x', {_day(m)}D, 'next', {_day(m, 1)}D)" for m in months)
    return F.expr(
        f"""transform(
            filter(transform(series, (n, i) -> named_struct('d', get(array({days}), i), 'n', n)), p -> p.n IS NOT NULL),
            p -> named_struct('x', p.d.x, 'y', greatest(CAST(p.n AS DOUBLE), {FLOOR}D), 'next', p.d.next))"""
    )


def dated_series(series: DataFrame, months: list[str]) -> DataFrame:
    """Each edge's series as an ordered list of (month, date, n)."""
    dated = "transform(_points, p -> named_struct('month', p.month, 'date', to_date(p.month || '-01'), 'n', p.n))"
    return series.withColumn("_points", S.named_points(months)).select(*EDGE, F.expr(dated).alias("points"))


def _clamped_band(centre: str, half: str) -> Column:
    return F.expr(
        f"""named_struct('n', greatest({centre}, 0D), 'lower', greatest({centre} - {half}, 0D),
                         'upper', greatest({centre} + {half}, 0D))"""
    )


def _moving_average(df: DataFrame) -> DataFrame:
    recent = S.last("transform(_points, p -> p.y)", 3)
    df = df.withColumn("_recent", recent).withColumn("_avg", S.mean("_recent"))
    df = df.withColumn("_half", NORMAL_95 * S.population_std("_recent", "_avg"))
    return df.withColumn("_forecast", _clamped_band("_avg", "_half")).drop("_recent", "_avg", "_half")


def _trend(df: DataFrame) -> DataFrame:
    """Least-squares line over calendar days, read at the next month start; 80 % band."""
    fold = "aggregate(_points, 0D, (acc, p) -> acc + {})".format
    rows = "nullif(size(_points), 0)"
    df = df.withColumns({"_mx": F.expr(f"{fold('p.x')} / {rows}"), "_my": F.expr(f"{fold('p.y')} / {rows}")})
    df = df.withColumns(
        {
            "_sxx": F.expr(fold("(p.x - _mx) * (p.x - _mx)")),
            "_sxy": F.expr(fold("(p.x - _mx) * (p.y - _my)")),
            "_syy": F.expr(fold("(p.y - _my) * (p.y - _my)")),
        }
    )
    df = df.withColumn("_slope", F.expr("CASE WHEN _sxx > 0 THEN _sxy / _sxx ELSE 0D END"))
    df = df.withColumns(
        {
            "_half": F.expr(f"{NORMAL_80} * sqrt(greatest(_syy - _slope * _sxy, 0D) / {rows})"),
            "_ahead": F.expr("_my + _slope * (try_element_at(_points, -1).next - _mx)"),
        }
    )
    band = F.expr("named_struct('n', _ahead, 'lower', _ahead - _half, 'upper', _ahead + _half)")
    return df.withColumn("_forecast", band).drop("_mx", "_my", "_sxx", "_sxy", "_syy", "_slope", "_half", "_ahead")


# Holt's recursion for one pair g of smoothing factors.
_SMOOTH = """aggregate(
    slice(_y, 2, size(_y)),
    named_struct('level', _y[0], 'trend', _slope, 'sum', 0D, 'squares', 0D),
    (s, v) -> named_struct(
        'level', s.level + s.trend + g.a * (v - (s.level + s.trend)),
        'trend', s.trend + g.a * g.b * (v - (s.level + s.trend)),
        'sum', s.sum + (v - (s.level + s.trend)),
        'squares', s.squares + (v - (s.level + s.trend)) * (v - (s.level + s.trend))),
    s -> named_struct('squares', s.squares, 'ahead', s.level + s.trend, 'sum', s.sum))"""


def _exponential(df: DataFrame) -> DataFrame:
    """Holt's level and additive trend; smoothing pair with the least squared error."""
    df = df.withColumn("_y", F.expr("transform(_points, p -> p.y)"))
    df = df.withColumn("_slope", F.expr("_y[1] - _y[0]"))
    df = df.withColumn("_fit", F.expr(f"array_min(transform({SMOOTHING_GRID}, g -> {_SMOOTH}))"))
    bias = "_fit.sum / size(_y)"
    half = f"{NORMAL_95} * sqrt(greatest(_fit.squares / size(_y) - ({bias}) * ({bias}), 0D))"
    df = df.withColumn("_half", F.expr(half))
    return df.withColumn("_forecast", _clamped_band("_fit.ahead", "_half")).drop("_y", "_slope", "_fit", "_half")


def exact_innovations(steps: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """The Kalman filter of an ARMA(1,1) over rows of ``steps``, for each row and parameter pair.

    Returns the logarithm of the exact likelihood with the innovation variance at its best, that variance, and the
    forecast of the next step.  A step's forecast error has the variance r times that of the innovations; r falls from the
    stationary variance to 1 as the start is forgotten.
    """
    r = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    expected = np.zeros(np.broadcast_shapes(phi.shape, (len(steps), 1)))
    r = np.broadcast_to(r, expected.shape)
    squares, logs = np.zeros_like(expected), np.zeros_like(expected)
    for t in range(steps.shape[1]):
        error = steps[:, [t]] - expected
        squares += error * error / r
        logs += np.log(r)
        expected = phi * steps[:, [t]] + theta / r * error
        r = 1 + theta**2 - theta**2 / r
    count = steps.shape[1]
    variance = np.maximum(squares / count, 1e-24)
    return -0.5 * (count * (np.log(2 * np.pi * variance) + 1) + logs), variance, expected, r


def arima_111(values: pd.Series) -> pd.DataFrame:
    """ARIMA(1,1,1) one step ahead by exact maximum likelihood, many series at once.

    A coarse grid over both parameters is refined around its best pair until steps are below 1e-5.
    """
    out = np.full((len(values), 3), np.nan)
    lengths = values.map(lambda v: 0 if v is None else len(v)).to_numpy()
    phi0, theta0 = (g.ravel() for g in np.meshgrid(ARIMA_GRID, ARIMA_GRID))
    around = np.linspace(-1.0, 1.0, 5)
    dphi, dtheta = (g.ravel() for g in np.meshgrid(around, around))
    for size in np.unique(lengths[lengths >= 3]):
        rows = np.flatnonzero(lengths == size)
        y = np.stack([np.asarray(values.iloc[r], dtype=float) for r in rows])
        steps, at = np.diff(y, axis=1), np.arange(len(rows))
        best = exact_innovations(steps, phi0[None, :], theta0[None, :])[0].argmax(axis=1)
        phi, theta, wide = phi0[best], theta0[best], 0.1
        while wide > 1e-5:
            near = [np.clip(p[:, None] + wide * d[None, :], -0.999, 0.999) for p, d in ((phi, dphi), (theta, dtheta))]
            best = exact_innovations(steps, *near)[0].argmax(axis=1)
            phi, theta, wide = near[0][at, best], near[1][at, best], wide / 2
        _, variance, ahead, r = (x[:, 0] for x in exact_innovations(steps, phi[:, None], theta[:, None]))
        sigma, centre = np.sqrt(variance * r), y[:, -1] + ahead
        out[rows, 0], out[rows, 1], out[rows, 2] = centre, centre - NORMAL_95 * sigma, centre + NORMAL_95 * sigma
    return pd.DataFrame(np.maximum(out, 0.0), columns=["n", "lower", "upper"])


#: Change points are looked for at so many places at most, in the first part of a series.
CHANGES, CHANGE_RANGE = 25, 0.8
#: Expected size of a change of slope, in heights of the series per its length.
CHANGE_SCALE = 0.05


def change_point_fit(x: np.ndarray, y: np.ndarray, scale: float = CHANGE_SCALE, outer: int = 4, sweeps: int = 40):
    """Piecewise straight lines through rows of points, with an L1 penalty on the changes of slope.

    Rows of ``x`` ascend.  Intercept and slope are free: they are projected out, the changes follow by coordinate
    descent for all rows at once, with the penalty in proportion to the variance left.  Returns
    (intercept, slope, changes, places, deviation) in the given units.
    """
    rows, size = y.shape
    start, length = x[:, :1], np.maximum(x[:, -1:] - x[:, :1], 1e-9)
    height = np.maximum(np.abs(y).max(axis=1, keepdims=True), 1e-9)
    t, z = (x - start) / length, y / height
    inner = max(int(np.floor(size * CHANGE_RANGE)) - 1, 0)
    at = np.unique(np.round(np.linspace(0, inner, min(CHANGES, inner) + 1)[1:]).astype(int)) if inner else np.empty(0, dtype=int)
    places = t[:, at]
    bends = np.maximum(t[:, :, None] - places[:, None, :], 0.0)
    line = np.stack([np.ones_like(t), t], axis=2)
    inverse = np.linalg.pinv(line)
    out_of = lambda m: m - line @ (inverse @ m)
    free, left = out_of(bends), out_of(z[:, :, None])[:, :, 0]
    norms = np.maximum(np.square(free).sum(axis=1), 1e-12)
    changes = np.zeros((rows, len(at)))
    for _ in range(outer):
        penalty = np.maximum(np.square(left).mean(axis=1), 1e-8) / scale
        for _ in range(sweeps):
            for j in range(len(at)):
                column = free[:, :, j]
                pull = (column * left).sum(axis=1) + norms[:, j] * changes[:, j]
                moved = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0.0) / norms[:, j]
                left = left - column * (moved - changes[:, j])[:, None]
                changes[:, j] = moved
    rest = z - (bends @ changes[:, :, None])[:, :, 0]
    base = (inverse @ rest[:, :, None])[:, :, 0]
    slope = base[:, 1] * height[:, 0] / length[:, 0]
    intercept = base[:, 0] * height[:, 0] - slope * start[:, 0]
    deviation = np.sqrt(np.square(left).mean(axis=1)) * height[:, 0]
    return intercept, slope, changes * height / length, places * length + start, deviation


def change_point_forecast(points: pd.Series) -> pd.DataFrame:
    """The bent line of each series at the next month start, with an 80 % band of what it leaves over."""
    out = np.full((len(points), 3), np.nan)
    lengths = points.map(lambda v: 0 if v is None else len(v)).to_numpy()
    for size in np.unique(lengths[lengths >= 3]):
        for rows in np.array_split(np.flatnonzero(lengths == size), -(-int((lengths == size).sum()) // 500)):
            x, y, ahead = (np.array([[p[name] for p in points.iloc[r]] for r in rows], dtype=float) for name in ("x", "y", "next"))
            intercept, slope, changes, places, deviation = change_point_fit(x, y)
            then = ahead[:, -1]
            centre = intercept + slope * then + (changes * np.maximum(then[:, None] - places, 0.0)).sum(axis=1)
            half = NORMAL_80 * deviation
            out[rows, 0], out[rows, 1], out[rows, 2] = centre, centre - half, centre + half
    return pd.DataFrame(out, columns=["n", "lower", "upper"])


def _change_points(df: DataFrame) -> DataFrame:
    forecast = F.pandas_udf(change_point_forecast, "n double, lower double, upper double")
    return df.withColumn("_forecast", forecast("_points"))


def _arima(df: DataFrame) -> DataFrame:
    forecast = F.pandas_udf(arima_111, "n double, lower double, upper double")
    return df.withColumn("_forecast", forecast(F.expr("transform(_points, p -> p.y)")))


_FITTERS = {
    "moving_avg": _moving_average,
    "trend": _trend,
    "exponential": _exponential,
    "arima": _arima,
    "change_points": _change_points,
}


def fit_series(df: DataFrame, method: str = "auto") -> DataFrame:
    """Add ``_forecast`` (n, lower, upper) for the ``_points`` of each row.

    Fewer than three points give zeros; a fit without a result falls back to the
    moving average.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    chosen = "trend" if method == "auto" else method
    fitted = _FITTERS[chosen](df)
    if chosen in ("arima", "change_points"):
        fitted = _moving_average(fitted.withColumnRenamed("_forecast", "_tried"))
        usable = F.col("_tried.n").isNotNull() & ~F.isnan("_tried.n")
        fitted = fitted.withColumn("_forecast", F.when(usable, F.col("_tried")).otherwise(F.col("_forecast")))
    zero = F.expr("named_struct('n', 0D, 'lower', 0D, 'upper', 0D)")
    return fitted.withColumn("_forecast", F.when(F.size("_points") < 3, zero).otherwise(F.col("_forecast")))


def forecast_metrics(
    series: DataFrame,
    months: list[str],
    targets: list[str] | None = None,
    method: str = "auto",
    min_history: int = 3,
    ratio_threshold: float = 2.0,
    include_target: bool = True,
) -> DataFrame:
    """Forecast each edge and compare it with the actual count of each target month.

    ``targets`` defaults to the last month.  ``include_target`` fits on the whole
    series, target and later months included; without it the fit uses earlier
    months only, one step ahead.  Edges with less history or without traffic in
    the target month give no row.  Row-wise work on the edge series: no shuffle.
    """
    targets = months[-1:] if targets is None else targets
    wanted = [i for i, m in enumerate(months) if m in targets]
    rows = series.withColumn("_points", series_points(months))
    if include_target:
        rows = fit_series(rows.filter(F.size("_points") >= min_history), method)
    rows = rows.select("*", F.posexplode("series").alias("_pos", "_n")).filter(
        F.col("_n").isNotNull() & F.col("_pos").isin(wanted)
    )
    if not include_target:
        rows = rows.withColumn("_start", F.get(S.number_array([_day(m) for m in months]), "_pos"))
        rows = rows.withColumn("_points", F.expr("filter(_points, p -> p.x < _start)"))
        rows = fit_series(rows.filter(F.size("_points") >= min_history), method)
    return rows.selectExpr(
        *EDGE,
        "_pos",
        "CAST(_n AS DOUBLE) AS _actual",
        "_forecast.n AS forecast_n",
        "_forecast.lower AS forecast_lower",
        "_forecast.upper AS forecast_upper",
        "CAST(_n AS DOUBLE) / (_forecast.n + 1e-6D) AS forecast_ratio",
    ).select(
        *EDGE,
        S.month_at("_pos", months).alias("month"),
        "forecast_n",
        "forecast_lower",
        "forecast_upper",
        F.expr("_actual - forecast_n").alias("forecast_error"),
        "forecast_ratio",
        F.expr(f"_actual > forecast_upper OR forecast_ratio >= {float(ratio_threshold)}D").alias("forecast_flag"),
    )
