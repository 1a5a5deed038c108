"""The registered queries: each operator over the whole given tables."""

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.functions.lineage import cut_lineage, scratch_path
from trailmark.functions.text import decode_title, encode_title
from trailmark.operators import clusters, edges, forecasts, graph, mixshift, referrers, sketches, spikes
from trailmark.operators.cleaning import clean_clicks, page_category
from trailmark.plans import explain, pageviews, reports, rolling
from trailmark.schema import EDGE
from trailmark.sources import derived
from trailmark.sources.anomalies import read_anomalies, write_anomalies, write_flat
from trailmark.sources.clicks import clean_or_load, read_months
from trailmark.sources.pageviews import flatten_responses, land_daily_views, read_daily_views
from trailmark.sources.truth import ground_truth_pages
from trailmark.streaming import replay, windows

_MONTHS: dict[str, list[str]] = {}


def months(spark: SparkSession, folder: str) -> list[str]:
    """The months of the data, in order; read once per folder."""
    if folder not in _MONTHS:
        found = derived.order_clicks(spark, folder).filter("n >= 10").select("month").distinct().collect()
        _MONTHS[folder] = sorted(r.month for r in found)
    return _MONTHS[folder]


def targets(spark: SparkSession, folder: str) -> list[str]:
    return months(spark, folder)[3:]


def last_month(spark: SparkSession, folder: str) -> str:
    return months(spark, folder)[-1]


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return clean_clicks(derived.order_clicks(spark, folder)).select(*EDGE, "n", "month")


def series(spark, folder):
    return edges.edge_series(clicks(spark, folder), months(spark, folder))


def pair_rows(spark, folder):
    return referrers.pair_targets(referrers.pair_series(clicks(spark, folder), months(spark, folder)), months(spark, folder), targets(spark, folder))


def anomalies_run(spark, folder):
    return rolling.rolling_run(clicks(spark, folder), months(spark, folder))


def enriched_run(spark, folder):
    return rolling.rolling_run(clicks(spark, folder), months(spark, folder), forecasts={"method": "trend"})


def as_stored(spark, rows: DataFrame) -> DataFrame:
    """Written to an anomaly table and read back, so that reports do not detect again."""
    path = scratch_path(spark, "anomalies")
    write_anomalies(rows, path, mode="overwrite")
    return read_anomalies(spark, path)


def anomalies(spark, folder):
    return as_stored(spark, anomalies_run(spark, folder))


def enriched(spark, folder):
    return as_stored(spark, enriched_run(spark, folder))


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that the last bits do not matter."""
    return df.selectExpr(
        *[f"round(`{f.name}`, 6) AS `{f.name}`" if f.dataType == T.DoubleType() else f"`{f.name}`" for f in df.schema]
    )


BASE = [
    "anomaly_id", "month", *EDGE, "n", "anomaly_type", "description",
    "baseline_median", "deviation_ratio", "z_score", "confidence",
]


def found(df: DataFrame) -> DataFrame:
    return rounded(df.select(*BASE))


def read_raw_months(spark, folder):
    path = scratch_path(spark, "raw")
    raw = derived.order_clicks(spark, folder)
    raw.write.partitionBy("month").option("sep", "\t").option("header", True).csv(path)
    return read_months(spark, [(f"{path}/month={m}", m) for m in months(spark, folder)])


def clean(spark, folder):
    return clean_clicks(derived.order_clicks(spark, folder))


def page_categories(spark, folder):
    category = page_category(F.col("prev")).alias("prev_category")
    return clicks(spark, folder).groupBy(category).agg(F.count("*").alias("rows"), F.sum("n").alias("n"))


def title_codec(spark, folder):
    title = F.concat("p_name", F.lit(" ~"), "p_type", F.lit("*é/"), "p_brand")
    coded = derived.table(spark, folder, "part").select("p_partkey", encode_title(title).alias("encoded"))
    return coded.withColumn("decoded", decode_title(F.col("encoded")))


def median_abs(spark, folder):
    return rounded(
        edges.edge_baselines(series(spark, folder), mad="median_abs").select(*EDGE, "baseline_median", "baseline_mad")
    )


def spikes_against(spark, folder):
    traffic = edges.edge_month(clicks(spark, folder).filter(F.col("month").isin(targets(spark, folder))))
    return found(spikes.spikes_against(traffic, edges.edge_baselines(series(spark, folder))))


def spikes_variant(spark, folder, **options):
    return found(spikes.traffic_spikes(series(spark, folder), months(spark, folder), **options))


def mix_variant(spark, folder, **options):
    return found(mixshift.mix_shifts(clicks(spark, folder), months(spark, folder), **options))


def stored_anomalies(spark, folder):
    path = scratch_path(spark, "anomalies")
    write_anomalies(anomalies_run(spark, folder), path, mode="overwrite")
    return found(read_anomalies(spark, path, {"month": "1998-07", "anomaly_type": "mix_shift"}))


def flat_anomalies(spark, folder):
    path = scratch_path(spark, "flat")
    write_flat(anomalies_run(spark, folder), path)
    return found(spark.read.parquet(path))


def clean_table(spark, folder):
    """Raw months to the cleaned table, which is then found and read."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    derived.order_clicks(spark, folder).write.partitionBy("month").option("sep", "\t").option("header", True).csv(raw)
    files = [(f"{raw}/month={m}", m) for m in months(spark, folder)]
    clean_or_load(spark, path, files)
    return clean_or_load(spark, path, [])


def truth_pages(spark, folder):
    path = scratch_path(spark, "truth")
    pages = derived.known_pages(spark, folder)
    pages.unionAll(pages).write.parquet(path)
    return ground_truth_pages(spark, path)


def centroid_outliers(spark, folder):
    vectors = derived.table(spark, folder, "embeddings")
    return rounded(clusters.centroid_outliers(vectors, "vec_id", "embedding", "label"))


def kmeans_outliers(spark, folder):
    return found(clusters.navigation_edges(series(spark, folder), months(spark, folder), targets(spark, folder), k=50))


def kmeans_as_of(spark, folder):
    """Each target month's outliers among clusters of the months up to it."""
    rows = series(spark, folder)
    return found(clusters.navigation_edges(rows, months(spark, folder), targets(spark, folder), k=10, max_iterations=20, scope="as_of"))


def full_run(spark, folder):
    run = rolling.rolling_run(clicks(spark, folder), months(spark, folder), clusters={"k": 50}, forecasts={"method": "trend"})
    return rounded(run)


def forecast(spark, folder, every=False, **options):
    """Forecasts of the last month, or of every target month."""
    if every:
        options["targets"] = targets(spark, folder)
    return rounded(forecasts.forecast_metrics(series(spark, folder), months(spark, folder), **options))


def dated_series(spark, folder):
    rows = forecasts.dated_series(series(spark, folder), months(spark, folder))
    text = F.transform("points", lambda p: F.concat(p["date"].cast("string"), F.lit("="), p["n"].cast("string")))
    return rows.select(*EDGE, F.array_join(text, ",").alias("points"))


def enrich_stored(spark, folder):
    stored = anomalies(spark, folder)
    return rounded(rolling.enrich_stored(stored, clicks(spark, folder), months(spark, folder), method="trend"))


def month_graphs(spark, folder):
    """The graph of each target month."""
    return cut_lineage(graph.page_graph(clicks(spark, folder).filter(F.col("month").isin(targets(spark, folder))), by="month"))


def heaviest_edges(spark, folder):
    rows = clicks(spark, folder).filter(F.col("month").isin(targets(spark, folder)))
    return graph.page_graph(rows, max_edges=50, by="month")


def pagerank(spark, folder):
    return rounded(graph.pagerank(month_graphs(spark, folder), tol=1e-12, by="month"))


def graph_method(spark, folder, **options):
    return rounded(graph.graph_scores(clicks(spark, folder), targets(spark, folder), **options))


def walks(spark, folder):
    return cut_lineage(graph.random_walks(month_graphs(spark, folder), by="month"))


def random_walks(spark, folder):
    """How often each walk was taken."""
    return walks(spark, folder).groupBy("month", "start", F.array_join("path", ">").alias("path")).agg(F.count("*").alias("walks"))


def _by_dimension(vectors):
    return rounded(vectors.select("month", "node", F.posexplode("embedding").alias("i", "x")))


def context_embeddings(spark, folder):
    return _by_dimension(graph.context_embeddings(walks(spark, folder), by="month"))


def walk_embeddings(spark, folder):
    return _by_dimension(graph.skip_gram_embeddings(walks(spark, folder), by="month"))


def browse_two_tier(spark, folder):
    rows = reports.browse_two_tier(anomalies(spark, folder), limit=5000)
    # the page itself is at most 5000 rows, so numbering it in one task is bounded
    ordered = rows.select("anomaly_id", F.monotonically_increasing_id().alias("_place"))
    from pyspark.sql import Window

    return ordered.select(F.row_number().over(Window.orderBy("_place")).alias("position"), "anomaly_id")


def interest(spark, folder, rule):
    return rounded(reports.most_interesting(anomalies(spark, folder), rule=rule).select("anomaly_id", "interest_score"))


KNOWN_EDGE = ("NATION_1", "ECONOMY", "link")


def edge_history(spark, folder):
    rows = edges.edge_month(clicks(spark, folder)).join(edges.edge_baselines(series(spark, folder)), EDGE)
    return rounded(explain.edge_history(rows, *KNOWN_EDGE))


def page_distribution(spark, folder):
    shares = referrers.referrer_distribution(clicks(spark, folder))
    return referrers.page_distribution(shares, KNOWN_EDGE[1], months(spark, folder)[-3:])


def known_anomaly(spark, folder):
    rows = anomalies(spark, folder)
    first = reports.top_by_confidence(rows, 1).select(F.col("anomaly_id").alias("_known"))
    return found(reports.anomaly_by_id(rows, first.scalar()))


def joined_signals(spark, folder, style):
    rows = explain.signals(enriched(spark, folder), style)
    return rows.select("anomaly_id", F.array_join("signals", ", ").alias("signals"))


def signal_status(spark, folder):
    rows = explain.signal_status(enriched(spark, folder))
    short = {"z_score": "z", "deviation_ratio": "ratio", "forecast_error": "error"}
    columns = [
        F.col(f"detection_signals.{name}.{part}").alias(f"{prefix}_{part}")
        for name, prefix in short.items()
        for part in ("value", "status")
    ]
    return rounded(rows.select("anomaly_id", *columns))


def filled_series(spark, folder):
    return rounded(explain.filled_series(enriched(spark, folder), series(spark, folder), months(spark, folder)))


def referrer_changes(spark, folder):
    shares = referrers.nested_top_referrers(referrers.top_referrers(clicks(spark, folder), months(spark, folder)))
    return explain.referrer_changes(shares).drop("referrer_shares")


def details(spark, folder):
    return explain.anomaly_details(
        enriched(spark, folder), clicks(spark, folder), months(spark, folder), derived.daily_views(spark, folder)
    )


def anomaly_details(spark, folder):
    point = F.transform("timeseries_6m", lambda p: F.concat(p["month"], F.lit(":"), p["n"].cast("string")))
    name = lambda r: F.concat(r["prev"], F.lit(":"), r["n"].cast("string"))
    month = F.transform(
        "referrer_shares",
        lambda m: F.concat(
            m["month"], F.lit("/"), m["total"].cast("string"), F.lit("/"), F.array_join(F.transform(m["referrers"], name), ",")
        ),
    )
    views = F.aggregate("daily_pageviews", F.lit(0).cast("bigint"), lambda acc, d: acc + d["views"])
    return details(spark, folder).select(
        "anomaly_id",
        F.array_join(point, ",").alias("series"),
        F.array_join(month, ";").alias("referrers"),
        F.array_join("signals", ", ").alias("signals"),
        "daily_spike_match",
        "top_referrer_flip",
        "major_mix_shift",
        F.size("daily_pageviews").alias("days"),
        views.alias("total_views"),
    )


def dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string"))


def response_views(spark, folder):
    """Daily views packed into one response per page and month, then flattened again."""
    item = F.struct(F.date_format("date", "yyyyMMdd'00'").alias("timestamp"), "views")
    packed = derived.daily_views(spark, folder).groupBy("page", F.trunc("date", "month")).agg(F.collect_list(item).alias("items"))
    return dates_as_text(flatten_responses(packed.select("page", F.to_json(F.struct("items")).alias("body"))))


def landed_views(spark, folder):
    """Daily views landed as JSON files and read back."""
    path = scratch_path(spark, "landed")
    land_daily_views(derived.daily_views(spark, folder), path)
    return dates_as_text(read_daily_views(spark, path))


def edge_lookup(spark, folder):
    """All months of the edges of the most confident anomalies."""
    keys = reports.top_by_confidence(anomalies(spark, folder), 100)
    return explain.edge_lookup(edges.edge_month(clicks(spark, folder)), keys)


def stream_updates(spark, folder):
    """What update mode last said of each window, open ones included."""
    out = scratch_path(spark, "updates")
    replay.run_to_end(replay.put_batches(replayed(spark, folder, end=False), out, scratch_path(spark, "stream"), "update"))
    rows = spark.read.parquet(out).groupBy("window_start", "prev", "curr").agg(F.max_by("n", "batch").alias("n"))
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


def anomalies_pageviews(spark, folder):
    joined = pageviews.with_pageviews(anomalies(spark, folder), derived.daily_views(spark, folder))
    return dates_as_text(joined.select("anomaly_id", "page", "date", "views"))


def event_transitions(spark, folder):
    moves = derived.event_transitions(spark, folder)
    return moves.groupBy("prev", "curr", F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


def hourly_baselines(spark, folder):
    return edges.period_baselines(windows.window_counts(derived.event_transitions(spark, folder)), ["prev", "curr"])


def sketch_baselines(spark, folder):
    """Baselines of event windows from stored month sketches, the last month put in by itself.

    Medians differ from run to run within the sketch's error, so the query tells whether their rank is in bounds.
    """
    keys, path = ["prev", "curr"], scratch_path(spark, "sketches")
    history = windows.window_counts(derived.event_transitions(spark, folder))
    history = cut_lineage(history.select(*keys, "n", F.date_format("window_start", "yyyy-MM").alias("month")))
    last = history.agg(F.max("month").alias("m")).first().m
    for part in (F.col("month") < last, F.col("month") == last):
        sketches.keep_months(sketches.month_sketches(history.filter(part), keys), path)
    rows = sketches.merged_baselines(sketches.read_sketches(spark, path), keys)
    below, upto = (F.avg((history["n"] < F.col("m")).cast("double")), F.avg((history["n"] <= F.col("m")).cast("double")))
    ranks = history.join(rows.select(*keys, F.col("baseline_median").alias("m")), keys).groupBy(*keys).agg(
        ((below <= 0.5 + sketches.RANK_ERROR) & (upto >= 0.5 - sketches.RANK_ERROR)).alias("median_in_bounds")
    )
    return rounded(rows.join(ranks, keys).select(*keys, "baseline_mean", "baseline_std", "median_in_bounds"))


def replayed(spark, folder, end=True):
    """The event transitions as a stream: written week by week, then read back in order.

    The delay of ten days covers a week's files in any order, so nothing is dropped.
    """
    path = scratch_path(spark, "replay")
    week = F.date_trunc("week", "day").cast("date").cast("string")
    rows = derived.event_transitions(spark, folder).withColumn("day", week)
    rows = cut_lineage(rows.select("ts", "prev", "curr", F.col("n").cast("bigint").alias("n"), "day"))
    replay.write_replay(rows, path, "day", files_per_slice=2)
    if end:
        replay.end_replay(rows, path, "ts")
    return windows.window_counts(replay.open_replay(spark, path, rows.schema, 2), delay="10 days")


def streamed(spark, stream):
    out, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "stream")
    replay.run_to_end(replay.append_to(stream, out, checkpoint))
    return spark.read.schema(stream.schema).parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


def stream_window_counts(spark, folder):
    return streamed(spark, replayed(spark, folder)).select("window_start", "prev", "curr", "n")


def stream_alerts(spark, folder):
    base = cut_lineage(hourly_baselines(spark, folder))
    rows = streamed(spark, windows.alerts(windows.score_windows(replayed(spark, folder), base)))
    return rounded(rows.select("window_start", "prev", "curr", "n", "deviation_ratio", "z_score"))


def stream_running_scores(spark, folder):
    """Hourly windows as a stream, week by week, scored against each edge's own running baseline."""
    path, out = scratch_path(spark, "replay"), scratch_path(spark, "scores")
    rows = windows.window_counts(derived.event_transitions(spark, folder)).select("prev", "curr", "window_start", "n")
    rows = cut_lineage(rows.withColumn("week", F.date_trunc("week", "window_start").cast("date").cast("string")))
    replay.write_replay(rows, path, "week")
    stream = windows.running_scores(replay.open_replay(spark, path, rows.schema), delay="8 days", keep="3650 days")
    replay.run_to_end(replay.put_batches(stream, out, scratch_path(spark, "stream")))
    found = spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))
    return rounded(found.select("prev", "curr", "window_start", "n", "seen", "baseline_mean", "baseline_std", "z_score"))


def _on(rows, make):
    """A query that applies ``make`` to the rows of another."""
    return lambda spark, folder: make(rows(spark, folder))


def _monthly(rows, make):
    """As ``_on``, with the months of the data."""
    return lambda spark, folder: make(rows(spark, folder), months(spark, folder))


def queries():
    by = functools.partial
    trend = {"method": "trend"}
    q = {
        "read_raw_months": read_raw_months,
        "clean_clicks": clean,
        "page_categories": page_categories,
        "title_codec": title_codec,
        "edge_month": _on(clicks, edges.edge_month),
        "month_pivot": _monthly(series, lambda s, m: edges.month_pivot(s, m)),
        "edge_baselines": _on(series, lambda s: rounded(edges.edge_baselines(s))),
        "edge_baselines_median_abs": median_abs,
        "raw_row_baselines": _on(clicks, lambda c: rounded(edges.raw_row_baselines(c))),
        "referrer_distribution": _on(clicks, referrers.referrer_distribution),
        "pooled_distribution": _on(pair_rows, referrers.pooled_distribution),
        "aligned_distributions": _on(
            pair_rows,
            lambda r: referrers.aligned_distributions(r).select("curr", "prev", "month", "proportion", "baseline_proportion"),
        ),
        "js_shift": _monthly(clicks, lambda c, m: rounded(mixshift.js_shift(c, m))),
        "traffic_spikes": spikes_variant,
        "spikes_against_baselines": spikes_against,
        "spikes_prior_history": by(spikes_variant, history="prior"),
        "spikes_last_six": by(spikes_variant, history=6, mad="median_abs"),
        "spikes_plus_epsilon_ratio": by(spikes_variant, ratio_rule="plus_epsilon", curve="steep"),
        "mix_shifts_all_ties": by(mix_variant, ties="all"),
        "mix_shifts_first": by(mix_variant, confidence="proportional"),
        "mix_shifts_with_js": by(mix_variant, use_js=True, js_threshold=0.1),
        "all_anomalies": _on(anomalies_run, found),
        "all_stored_anomalies": _on(anomalies, found),
        "flat_anomalies": flat_anomalies,
        "clean_table": clean_table,
        "truth_pages": truth_pages,
        "stored_anomalies": stored_anomalies,
        "edge_features": _monthly(series, lambda s, m: rounded(edges.edge_features(s, m))),
        "centroid_outliers": centroid_outliers,
        "stream_running_scores": stream_running_scores,
        "landed_views": landed_views,
        "edge_lookup": edge_lookup,
        "stream_updates": stream_updates,
        "sketch_baselines": sketch_baselines,
        "kmeans_outliers": kmeans_outliers,
        "kmeans_as_of": kmeans_as_of,
        "full_run": full_run,
        "last_six_months": _monthly(series, lambda s, m: edges.last_months(s, m)),
        "top_ten_referrers": _monthly(clicks, lambda c, m: referrers.top_referrers(c, m)),
        "dated_series": dated_series,
        "forecast_moving_average": by(forecast, every=True, method="moving_avg"),
        "forecast_trend": by(forecast, every=True, **trend),
        "forecast_smoothing": by(forecast, every=True, method="exponential"),
        "forecast_arima": by(forecast, every=True, method="arima"),
        "forecast_change_points": by(forecast, every=True, method="change_points"),
        "forecast_ahead": by(forecast, method="moving_avg", include_target=False, every=True),
        "forecast_flag_counts": _monthly(series, lambda s, m: reports.flagged_counts(forecasts.forecast_metrics(s, m, targets=m[3:], **trend))),
        "enriched_anomalies": _on(enriched_run, rounded),
        "enriched_stored_anomalies": enrich_stored,
        "node_degree": lambda s, f: graph.node_degrees(month_graphs(s, f), "month"),
        "pagerank": pagerank,
        "heaviest_edges": heaviest_edges,
        "structural_scores": by(graph_method, method="deepwalk", tol=1e-12),
        "neighbour_scores": by(graph_method, method="gnn"),
        "walk_scores": by(graph_method, method="node2vec"),
        "random_walks": random_walks,
        "context_embeddings": context_embeddings,
        "walk_embeddings": walk_embeddings,
        "anomaly_stats": _on(anomalies, lambda a: rounded(reports.anomaly_stats(a))),
        "type_by_month": _on(enriched, lambda a: reports.type_by_month(a, flag_only=False)),
        "top_confident": _on(anomalies, lambda a: found(reports.top_by_confidence(a, 10))),
        "browse": _on(anomalies, lambda a: found(reports.browse(a, limit=1000, min_confidence=0.6))),
        "browse_two_tier": browse_two_tier,
        "interest_product": by(interest, rule="product"),
        "interest_weighted": by(interest, rule="weighted"),
        "insights": _on(anomalies, reports.insights),
        "value_counts": _on(anomalies, lambda a: reports.value_counts(a, "curr")),
        "deviation_summary": _on(anomalies, lambda a: rounded(reports.deviation_summary(a))),
        "mean_confidence": _on(anomalies, lambda a: rounded(reports.mean_confidence(a, anomaly_type="mix_shift"))),
        "months_with_anomalies": _on(anomalies, reports.months_with_anomalies),
        "anomaly_by_id": known_anomaly,
        "graph_nodes": _on(anomalies, reports.graph_nodes),
        "graph_edges": _on(anomalies, lambda a: rounded(reports.graph_edges(a))),
        "precision_at_k": lambda s, f: rounded(reports.precision_at_k(anomalies(s, f), derived.known_pages(s, f), 50)),
        "explanations": _on(enriched, lambda a: explain.explanations(a).select("anomaly_id", "explanation")),
        "signals": by(joined_signals, style="full"),
        "signals_short": by(joined_signals, style="short"),
        "signal_status": signal_status,
        "edge_history": edge_history,
        "page_distribution": page_distribution,
        "filled_series": filled_series,
        "referrer_changes": referrer_changes,
        "anomaly_details": anomaly_details,
        "detail_json": _on(details, explain.detail_json),
        "daily_views": lambda s, f: dates_as_text(derived.daily_views(s, f)),
        "response_views": response_views,
        "views_around": lambda s, f: dates_as_text(pageviews.views_around(anomalies(s, f), derived.daily_views(s, f))),
        "daily_spike_match": lambda s, f: rounded(pageviews.daily_spike_match(anomalies(s, f), derived.daily_views(s, f))),
        "anomalies_pageviews": anomalies_pageviews,
        "event_transitions": event_transitions,
        "hourly_baselines": _on(hourly_baselines, rounded),
        "stream_window_counts": stream_window_counts,
        "stream_alerts": stream_alerts,
    }
    return q
