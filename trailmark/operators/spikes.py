"""Traffic spikes: an edge's month against the edge's history."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.functions.scores import guarded_ratio, robust_z, spike_confidence
from trailmark.functions.text import fixed
from trailmark.operators.edges import BASELINE_COLUMNS, with_stats
from trailmark.schema import EDGE, anomaly_id, as_anomalies


def is_spike(z_threshold: float = 3.5, ratio_threshold: float = 10.0) -> Column:
    """Drops count as well as rises: the z-score is taken by size."""
    return (F.col("deviation_ratio") >= ratio_threshold) | (F.abs("z_score") >= z_threshold)


def add_scores(
    traffic: DataFrame,
    z_threshold: float = 3.5,
    ratio_threshold: float = 10.0,
    epsilon: float = 0.01,
    ratio_rule: str = "median",
    curve: str = "gentle",
) -> DataFrame:
    """Ratio, z-score and confidence of rows that carry ``n`` and baseline columns."""
    n, median = F.col("n"), F.col("baseline_median")
    if ratio_rule == "median":
        ratio = guarded_ratio(n, median)
    elif ratio_rule == "plus_epsilon":
        ratio = n / (median + F.lit(epsilon))
    else:
        raise ValueError(f"unknown ratio_rule: {ratio_rule}")
    scored = traffic.withColumns(
        {
            "deviation_ratio": ratio,
            "z_score": robust_z(n, median, F.col("baseline_mad"), epsilon),
        }
    )
    confidence = spike_confidence(
        F.col("z_score"), F.col("deviation_ratio"), z_threshold, ratio_threshold, curve
    )
    return scored.withColumn("confidence", confidence)


def score_traffic(
    traffic: DataFrame, z_threshold: float = 3.5, ratio_threshold: float = 10.0, **scoring
) -> DataFrame:
    """Only the rows that are spikes, scored."""
    scored = add_scores(traffic, z_threshold, ratio_threshold, **scoring)
    return scored.filter(is_spike(z_threshold, ratio_threshold))


def _as_spikes(scored: DataFrame, ratio_threshold: float) -> DataFrame:
    ratio, z = F.col("deviation_ratio"), F.col("z_score")
    # The two description texts.
    text = F.when(
        ratio >= ratio_threshold,
        F.concat(F.lit("Traffic spike: "), F.col("month"), F.lit(" traffic is "), fixed(ratio, 1), F.lit("x baseline")),
    ).otherwise(F.concat(F.lit("Statistical anomaly: Z-score = "), fixed(z, 2)))
    kind = F.lit("traffic_spike")
    return as_anomalies(
        scored.withColumns(
            {
                "anomaly_type": kind,
                "description": text,
                "anomaly_id": anomaly_id(kind, "month", *EDGE),
            }
        )
    )


def traffic_spikes(
    series: DataFrame,
    months: list[str],
    targets: list[str] | None = None,
    history: str | int = "all",
    min_baseline_months: int = 3,
    mad: str = "mean_abs",
    ratio_threshold: float = 10.0,
    **scoring,
) -> DataFrame:
    """Spikes of every target month in one pass over the edge series.

    ``history``: ``"all"`` months (the target's own included), ``"prior"`` months
    only, or an integer for that many prior months.  Targets default to every
    month with at least ``min_baseline_months`` before it.  The baseline travels
    with the series row, so no join and no shuffle is added.
    """
    wanted = [i for i, m in enumerate(months) if (i >= min_baseline_months if targets is None else m in targets)]
    if history == "all":
        keep = [c for c in series.columns if c != "series"]
        source = with_stats(series, mad=mad)
        rows = source.select(*keep, *BASELINE_COLUMNS, F.posexplode("series").alias("_pos", "n"))
        rows = rows.filter(F.col("n").isNotNull() & F.col("_pos").isin(wanted))
    else:
        # the statistics are part of the exploded array: no filter can pull them apart
        kind = series.schema["series"].dataType.elementType.simpleString()
        found = S.rolling_stats(F.col("series"), history, mad, kind)
        found = F.filter(found, lambda p: p["pos"].isin(wanted) & (p["stats"]["months"] > 0))
        keep = [c for c in series.columns if c != "series"]
        rows = series.select(*keep, F.inline(found).alias("_pos", "n", "_stats")).select(
            *keep,
            "_pos",
            "n",
            F.col("_stats.median").alias("baseline_median"),
            F.col("_stats.mean").alias("baseline_mean"),
            F.coalesce("_stats.std", F.lit(0.01)).alias("baseline_std"),
            F.col("_stats.mad").alias("baseline_mad"),
        )
    rows = rows.withColumn("month", S.month_at("_pos", months))
    return _as_spikes(score_traffic(rows, ratio_threshold=ratio_threshold, **scoring), ratio_threshold)


def spikes_against(
    traffic: DataFrame, baselines: DataFrame, ratio_threshold: float = 10.0, **scoring
) -> DataFrame:
    """Spikes of edge-month rows against a stored baseline table.

    Edges without a baseline drop out.  Keys are near unique on both sides.
    """
    joined = traffic.join(baselines, EDGE, "inner")
    return _as_spikes(score_traffic(joined, ratio_threshold=ratio_threshold, **scoring), ratio_threshold)
