"""The rolling run: every target month, every detector, one table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.lineage import cut_lineage
from trailmark.operators.clusters import navigation_edges
from trailmark.operators.edges import edge_series, pairs_of
from trailmark.operators.forecasts import forecast_metrics
from trailmark.operators.mixshift import mix_shifts, target_months
from trailmark.operators.spikes import traffic_spikes
from trailmark.schema import EDGE, FORECAST_DEFAULTS, as_anomalies, with_defaults


def tag_forecast_spikes(anomalies: DataFrame) -> DataFrame:
    """Append ``_forecast_spike`` to the type of flagged anomalies."""
    tagged = F.concat_ws("_", "anomaly_type", F.lit("forecast_spike"))
    return anomalies.withColumn(
        "anomaly_type", F.when(F.col("forecast_flag"), tagged).otherwise(F.col("anomaly_type"))
    )


def enrich_with_forecasts(anomalies: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Left-join forecasts on edge and month, fill defaults, retag flagged rows.

    Forecast columns come from here only.  Keys are near unique on both sides.
    """
    bare = anomalies.drop(*FORECAST_DEFAULTS)
    typed = forecasts.withColumn("month", F.col("month").cast("string"))
    joined = bare.withColumn("month", F.col("month").cast("string")).join(typed, [*EDGE, "month"], "left")
    return as_anomalies(tag_forecast_spikes(with_defaults(joined, FORECAST_DEFAULTS)))


def enrich_stored(
    anomalies: DataFrame, clicks: DataFrame, months: list[str], method: str = "auto", min_history: int = 3
) -> DataFrame:
    """Forecast the edges of stored anomalies and compare each with its own month.

    Edges without anomalies leave early, by a semi join that carries keys only.
    """
    keys = anomalies.select(*EDGE).distinct()
    series = edge_series(clicks, months).join(keys, EDGE, "left_semi")
    return enrich_with_forecasts(anomalies, forecast_metrics(series, months, months, method, min_history))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def rolling_run(
    clicks: DataFrame,
    months: list[str],
    min_baseline_months: int = 3,
    spikes: dict | None = None,
    mix: dict | None = None,
    clusters: dict | None = None,
    forecasts: dict | None = None,
) -> DataFrame:
    """All anomalies of all target months.

    The clicks are read once, into a stored table of edge series; all
    detectors and forecasts work on that.  Each detector takes its options as a dict.  ``clusters=None`` leaves the
    clustering detector out (fitting it runs Spark jobs), ``forecasts=None``
    leaves out the forecast columns' values.
    """
    targets = target_months(months, min_baseline_months)
    series = cut_lineage(edge_series(clicks, months))
    parts = [
        traffic_spikes(series, months, targets, **(spikes or {})),
        mix_shifts(clicks, months, targets, **{"pairs": pairs_of(series, months), **(mix or {})}),
    ]
    if clusters is not None:
        parts.append(navigation_edges(series, months, targets, **clusters))
    found = union_all(parts)
    if forecasts is None:
        return found
    return enrich_with_forecasts(found, forecast_metrics(series, months, **{"targets": targets, **forecasts}))
