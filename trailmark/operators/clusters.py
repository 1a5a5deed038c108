"""Navigation edges that lie far from the centre of their cluster."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.lineage import cut_lineage
from trailmark.functions.quantile import exact_percentile, exact_percentiles
from trailmark.functions.scores import edge_outlier_confidence, euclidean, guarded_ratio
from trailmark.functions.skew import salted_join
from trailmark.functions.text import fixed
from trailmark.operators.edges import with_stats
from trailmark.operators.kmeans import as_of_rows, distances, fit_spans, with_draws
from trailmark.schema import EDGE, anomaly_id, as_anomalies


def feature_vectors(series: DataFrame, months: list[str]) -> DataFrame:
    """Edges with ``features_raw``: (count, ratio) per month, median, mean, type one-hots.

    Edges with a missing part are skipped.
    """
    if not months:
        raise ValueError("no feature columns")
    median = F.col("baseline_median")
    counts = F.transform("series", lambda n: F.coalesce(n, F.lit(0)).cast("double"))
    monthly = F.flatten(F.transform(counts, lambda n: F.array(n, guarded_ratio(n, median))))
    kinds = [(F.col("type") == t).cast("double") for t in ("link", "external", "other")]
    rest = F.array(median, F.col("baseline_mean"), *kinds)
    rows = with_stats(series).select(*EDGE, "baseline_median", F.concat(monthly, rest).alias("features_raw"))
    return rows.filter(F.forall("features_raw", lambda x: x.isNotNull() & ~F.isnan(x)))


def kmeans_distances(
    series: DataFrame, months: list[str], k: int = 50, max_iterations: int = 100, seed: int = 42
) -> DataFrame:
    """Cluster the edges and give each its distance to its centre, as a stored table with the standardised ``features``."""
    rows = with_draws(as_of_rows(series), seed)
    fits = fit_spans(rows, len(months), [len(months)], k, max_iterations, seed)
    return cut_lineage(distances(rows, len(months), fits, with_features=True).drop("span"))


def navigation_edges(
    series: DataFrame,
    months: list[str],
    targets: list[str],
    k: int = 50,
    percentile: float = 95.0,
    max_iterations: int = 100,
    seed: int = 42,
    scope: str = "all_months",
) -> DataFrame:
    """Edges at or beyond the distance percentile, reported for each target month.

    ``scope="all_months"`` fits once on all months, so every target repeats the
    same edges; ``"as_of"`` fits each target on the months up to it, all of them in the same passes over the rows.
    """
    if scope == "all_months":
        return outlier_anomalies(kmeans_distances(series, months, k, max_iterations, seed), percentile, targets)
    if scope != "as_of":
        raise ValueError(f"unknown scope: {scope}")
    spans = {months.index(t) + 1: t for t in targets}
    rows = with_draws(as_of_rows(series), seed)
    fits = fit_spans(rows, len(months), [*spans, len(months)], k, max_iterations, seed)
    scored = cut_lineage(distances(rows, len(months), [f for f in fits if f.span in spans]))
    limits = exact_percentiles(scored, "span", "distance_to_center", percentile / 100)
    if not limits:
        return outlier_anomalies(scored, percentile, targets).limit(0)
    table = scored.sparkSession.createDataFrame([(s, spans[s], v) for s, v in limits.items()], "span int, month string, limit double")
    far = scored.join(F.broadcast(table), "span").filter("distance_to_center >= limit")  # one row for each target month
    return _as_outliers(far, F.col("limit"))


def outlier_anomalies(scored: DataFrame, percentile: float, targets: list[str]) -> DataFrame:
    threshold = exact_percentile(scored, "distance_to_center", percentile / 100)
    limit = float("inf") if threshold is None else threshold
    far = scored.filter(F.col("distance_to_center") >= limit)
    return _as_outliers(far.withColumn("month", F.explode(F.array(*[F.lit(t) for t in targets]))), F.lit(limit))


def _as_outliers(rows: DataFrame, limit: Column) -> DataFrame:
    kind, distance = F.lit("navigation_edge"), F.col("distance_to_center")
    return as_anomalies(
        rows.select(
            anomaly_id(kind, "month", *EDGE).alias("anomaly_id"),
            "month",
            *EDGE,
            F.col("baseline_median").alias("n"),
            "baseline_median",
            F.lit(1.0).alias("deviation_ratio"),
            F.lit(0.0).alias("z_score"),
            kind.alias("anomaly_type"),
            edge_outlier_confidence(distance, limit).alias("confidence"),
            # Fixed value: the description text.
            F.concat(F.lit("Navigation edge anomaly: distance to cluster center = "), fixed(distance, 4)).alias(
                "description"
            ),
        )
    )


def centroid_distances(rows: DataFrame, key: str, features: str, cluster: str) -> DataFrame:
    """Distance of each row to the mean of its given cluster.

    Means are partial sums per task; a cluster that holds most of the rows is
    split over salts when the means are joined back.
    """
    vectors = rows.select(key, cluster, F.transform(features, lambda x: x.cast("double")).alias("_x"))
    means = vectors.groupBy(cluster).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col("_x")))).alias("_centre")
    )
    joined = salted_join(vectors, means, [cluster], [key])
    return joined.select(key, cluster, euclidean(F.col("_x"), F.col("_centre")).alias("distance_to_center"))


def centroid_outliers(
    rows: DataFrame, key: str, features: str, cluster: str, percentile: float = 95.0
) -> DataFrame:
    """Rows at or beyond the distance percentile of their given clusters."""
    scored = cut_lineage(centroid_distances(rows, key, features, cluster))
    threshold = exact_percentile(scored, "distance_to_center", percentile / 100)
    limit = float("inf") if threshold is None else threshold
    far = scored.filter(F.col("distance_to_center") >= limit)
    return far.withColumn("confidence", edge_outlier_confidence(F.col("distance_to_center"), limit))
