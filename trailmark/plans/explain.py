"""Explanations, signals and detail documents of anomalies."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.functions.skew import salted_join
from trailmark.functions.text import fixed, grouped, percent
from trailmark.operators.edges import edge_series
from trailmark.operators.referrers import nested_top_referrers, top_referrers
from trailmark.plans.pageviews import daily_profiles
from trailmark.schema import ANOMALIES, EDGE, FORECAST_DEFAULTS, existing

# Signal names by style, and the label of each anomaly type.
TYPE_LABELS = {"traffic_spike": "Traffic Spike", "mix_shift": "Mix Shift", "navigation_edge": "Navigation Edge"}
SIGNAL_NAMES = {
    "full": {"ratio": "High Deviation Ratio", "z": "MAD-Z Score"},
    "short": {"ratio": "High Deviation", "z": "MAD-Z Score"},
    "plain": {"ratio": "High Deviation", "z": "High Z-score"},
}


def _flag(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else F.lit(False)


def explanations(anomalies: DataFrame, site: str = "Wikipedia") -> DataFrame:
    """Add ``explanation``: the parts that apply, joined by blanks.

    A graph part appears if the table carries ``gnn_flag`` and ``gnn_score``.
    """
    kind, n = F.col("anomaly_type"), grouped(F.col("n"))
    ratio, z = F.col("deviation_ratio"), F.col("z_score")
    # The sentence forms.
    parts = [
        F.concat(
            F.lit("This anomaly detected in "), "month", F.lit(" shows unusual traffic from '"), "prev",
            F.lit("' to '"), "curr", F.lit("'."),
        ),
        F.when(
            (kind == "traffic_spike") | (ratio > 10),
            F.concat(
                F.lit("Traffic spiked to "), n, F.lit(" transitions ("), fixed(ratio, 1),
                F.lit("x the baseline median of "), fixed(F.col("baseline_median"), 0), F.lit(")."),
            ),
        ),
        F.when(
            F.abs(z) > 3.5,
            F.concat(
                F.lit("Statistical analysis shows a robust Z-score of "), fixed(z, 2),
                F.lit(", indicating a significant deviation from normal patterns."),
            ),
        ),
    ]
    if "forecast_n" in anomalies.columns:
        parts.append(
            F.when(
                _flag(anomalies, "forecast_flag"),
                F.concat(
                    F.lit("Time-series forecasting predicted "), fixed(F.col("forecast_n"), 0),
                    F.lit(" transitions (upper bound: "), fixed(F.col("forecast_upper"), 0),
                    F.lit("), but actual traffic was "), n, F.lit(", exceeding the forecast."),
                ),
            )
        )
    parts.append(
        F.when(
            kind == "mix_shift",
            F.lit(
                "The referrer distribution for this page changed significantly, indicating a shift in how users "
                "are discovering or navigating to this content."
            ),
        )
    )
    if "gnn_flag" in anomalies.columns:
        parts.append(
            F.when(
                _flag(anomalies, "gnn_flag"),
                F.concat(
                    F.lit("Graph-based analysis flagged this edge as anomalous (score: "), fixed(F.col("gnn_score"), 3),
                    F.lit(f"), suggesting unusual navigation patterns in the {site} link graph."),
                ),
            )
        )
    parts.append(F.concat(F.lit("Overall confidence: "), percent(F.col("confidence"), 1)))
    return anomalies.withColumn("explanation", F.concat_ws(" ", *parts))


def signals(anomalies: DataFrame, style: str = "full") -> DataFrame:
    """Add ``signals``: the names of all checks that fired.

    ``full`` lists the ratio before the z-score, knows graph flags and falls back
    to ``Anomaly Detected``; ``short`` and ``plain`` are the serving forms.
    """
    names = SIGNAL_NAMES[style]
    kind = F.col("anomaly_type")
    label = F.when(kind == "traffic_spike", F.lit(TYPE_LABELS["traffic_spike"]))
    for name in ("mix_shift", "navigation_edge"):
        label = label.when(kind == name, F.lit(TYPE_LABELS[name]))
    ratio = F.when(F.col("deviation_ratio") >= 10, F.lit(names["ratio"]))
    z = F.when(F.abs("z_score") >= 3.5, F.lit(names["z"]))
    found = [label, F.when(_flag(anomalies, "forecast_flag"), F.lit("Forecast Deviation"))]
    if style == "full":
        found += [F.when(_flag(anomalies, "gnn_flag"), F.lit("GNN Outlier")), ratio, z]
    else:
        found += [z, ratio]
    fired = F.array_compact(F.array(*found))
    if style == "full":
        fired = F.when(F.size(fired) == 0, F.array(F.lit("Anomaly Detected"))).otherwise(fired)
    return anomalies.withColumn("signals", fired)


def _status(value: Column, high: Column, raised: Column) -> Column:
    return F.when(high, F.lit("anomaly")).when(raised, F.lit("elevated")).otherwise(F.lit("normal"))


def signal_status(anomalies: DataFrame) -> DataFrame:
    """Add ``detection_signals``: value, status and label of each measure."""
    z, ratio, error = F.col("z_score"), F.col("deviation_ratio"), F.coalesce("forecast_error", F.lit(0.0))
    median = F.col("baseline_median")

    def measure(name: str, value: Column, high: Column, raised: Column, label: str) -> Column:
        return F.struct(
            value.cast("double").alias("value"), _status(value, high, raised).alias("status"), F.lit(label).alias("label")
        ).alias(name)

    # Thresholds and labels.
    return anomalies.withColumn(
        "detection_signals",
        F.struct(
            measure("z_score", z, F.abs(z) >= 3.5, F.abs(z) >= 2, "Robust Z-score (σ-MAD)"),
            measure("deviation_ratio", ratio, ratio >= 10, ratio >= 5, "Deviation Ratio"),
            measure("forecast_error", error, F.abs(error) > median * 2, F.abs(error) > median, "Forecast Error"),
        ),
    )


def edge_history(rows: DataFrame, prev: str, curr: str, kind: str) -> DataFrame:
    """One edge's rows by month, with whichever measure columns the table has."""
    wanted = [
        "month", "n", "baseline_median", "baseline_mad", "deviation_ratio", "z_score",
        "forecast_n", "forecast_lower", "forecast_upper",
    ]
    edge = rows.filter((F.col("prev") == prev) & (F.col("curr") == curr) & (F.col("type") == kind))
    return existing(edge, wanted).orderBy("month")


def edge_lookup(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of many edges at once."""
    return rows.join(keys.select(*EDGE).distinct(), EDGE, "left_semi")


def filled_series(
    anomalies: DataFrame, series: DataFrame, months: list[str], fill: bool = True, keys: list[str] = EDGE
) -> DataFrame:
    """Monthly series of every anomalous edge with its baseline and forecast lines.

    The lines come from the edge's earliest anomaly.  ``fill`` puts 0 in months
    without traffic, otherwise those months are left out.  Edges without any
    clicks show their anomaly rows instead.
    """
    lines = ["baseline_median", "forecast_n", "forecast_lower", "forecast_upper"]
    first = anomalies.groupBy(*keys).agg(
        F.min_by(F.struct(*lines), F.struct("month", "anomaly_id")).alias("_line")
    )
    joined = first.join(series, keys, "left")
    known = joined.filter(F.col("series").isNotNull()).select(*keys, "_line", F.posexplode("series").alias("_pos", "n"))
    if not fill:
        known = known.filter(F.col("n").isNotNull())
    known = known.select(
        *keys,
        S.month_at("_pos", months).alias("month"),
        F.coalesce("n", F.lit(0)).alias("traffic"),
        *[F.col(f"_line.{c}").alias(c) for c in lines],
    )
    unseen = anomalies.join(series.select(*keys), keys, "left_anti")
    return known.unionByName(unseen.select(*keys, "month", F.col("n").alias("traffic"), *lines))


def referrer_changes(shares: DataFrame) -> DataFrame:
    """``top_referrer_flip`` and ``major_mix_shift`` of each page, from its nested shares.

    The last listed month is compared with the earlier ones: with their most
    frequent top referrer (the earliest seen among equals), and with the largest
    earlier share of the current top referrer (more than 0.2 apart).
    """
    last = F.element_at("referrer_shares", -1)
    earlier = F.slice("referrer_shares", F.lit(1), F.size("referrer_shares") - 1)
    tops = F.transform(earlier, lambda m: m["referrers"][0]["prev"])
    ranked = F.transform(
        tops,
        lambda t, i: F.struct(F.size(F.filter("_tops", lambda x: x == t)).alias("count"), (-i).alias("first"), t.alias("prev")),
    )
    rows = shares.withColumns({"_tops": tops, "_last": last["referrers"][0], "_earlier": F.flatten(F.transform(earlier, lambda m: m["referrers"]))})
    rows = rows.withColumn("_usual", F.array_max(ranked)["prev"])
    same = F.filter("_earlier", lambda r: r["prev"] == F.col("_last.prev"))
    before = F.coalesce(F.array_max(F.transform(same, lambda r: r["proportion"])), F.lit(0.0))
    several = F.size("referrer_shares") >= 2
    return rows.select(
        "curr",
        "referrer_shares",
        F.when(several, F.col("_usual") != F.col("_last.prev")).otherwise(F.lit(False)).alias("top_referrer_flip"),
        F.when(several, F.abs(F.col("_last.proportion") - before) > 0.2).otherwise(F.lit(False)).alias("major_mix_shift"),
    )


def anomaly_details(
    anomalies: DataFrame, clicks: DataFrame, months: list[str], views: DataFrame | None = None, style: str = "short"
) -> DataFrame:
    """One nested record per anomaly: series, forecast, referrers, signals, daily views.

    Page-level records are built once per page and joined in salted form, since
    one page may hold many anomalies.  All lists are bounded by months, days or
    the ten referrers kept.
    """
    # only anomalous edges have a series here
    known = clicks.join(anomalies.select(*EDGE).distinct(), EDGE, "left_semi")
    series = edge_series(known, months).withColumn("_points", S.named_points(months))
    recent = series.select(*EDGE, S.last("_points", 6).alias("timeseries_6m"))
    pages = referrer_changes(nested_top_referrers(top_referrers(clicks, months)))
    rows = signal_status(signals(anomalies, style)).join(recent, EDGE, "left")
    rows = salted_join(rows, pages, ["curr"], ["anomaly_id"], how="left")
    match, daily = F.lit(False), F.array().cast("array<struct<date:date,views:bigint>>")
    if views is not None:
        profiles = daily_profiles(anomalies, views).select(
            F.col("page").alias("curr"), "month", F.col("daily_pageviews").alias("_daily"), "daily_spike_match"
        )
        rows = salted_join(rows, profiles, ["curr", "month"], ["anomaly_id"], how="left")
        match = F.coalesce("daily_spike_match", match)
        daily = F.coalesce("_daily", daily)
    return rows.select(
        "anomaly_id",
        F.struct(*[f.name for f in ANOMALIES]).alias("anomaly"),
        F.coalesce("timeseries_6m", F.array().cast("array<struct<month:string,n:bigint>>")).alias("timeseries_6m"),
        F.struct(*FORECAST_DEFAULTS).alias("forecast_values"),
        "referrer_shares",
        "detection_signals",
        daily.alias("daily_pageviews"),
        match.alias("daily_spike_match"),
        F.coalesce("top_referrer_flip", F.lit(False)).alias("top_referrer_flip"),
        F.coalesce("major_mix_shift", F.lit(False)).alias("major_mix_shift"),
        "signals",
    )


def detail_json(details: DataFrame) -> DataFrame:
    """The nested records as JSON text."""
    return details.select("anomaly_id", F.to_json(F.struct(*details.columns)).alias("detail"))
