"""Ranking, counting and summary queries over the anomaly table.

Every ordering ends in the anomaly id, so results do not depend on partitioning.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.text import fixed

TYPES = ["traffic_spike", "mix_shift", "navigation_edge"]


def matching(
    anomalies: DataFrame,
    month: str | None = None,
    anomaly_type: str | None = None,
    min_confidence: float | None = None,
) -> DataFrame:
    """Conjunction of the filters that are set; month and type prune partitions."""
    if month:
        anomalies = anomalies.filter(F.col("month") == month)
    if anomaly_type:
        anomalies = anomalies.filter(F.col("anomaly_type") == anomaly_type)
    if min_confidence:
        anomalies = anomalies.filter(F.col("confidence") >= min_confidence)
    return anomalies


def top_by_confidence(anomalies: DataFrame, k: int) -> DataFrame:
    return anomalies.orderBy(F.desc("confidence"), "anomaly_id").limit(k)


def browse(anomalies: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """Filtered anomalies, most confident first."""
    found = matching(anomalies, **filters).orderBy(F.desc("confidence"), "anomaly_id")
    return found.limit(limit) if limit else found


def browse_two_tier(anomalies: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """Ratios above 1 first, by ratio then confidence; the rest by confidence.

    Rows without a ratio drop out.
    """
    ratio = F.col("deviation_ratio")
    rows = matching(anomalies, **filters).filter(ratio.isNotNull())
    ordered = rows.orderBy(
        (ratio > 1).desc(), F.when(ratio > 1, ratio).desc(), F.desc("confidence"), "anomaly_id"
    )
    return ordered.limit(limit) if limit else ordered


def interest_score(columns: list[str], rule: str = "product") -> Column:
    """How interesting an anomaly is, from the columns there are."""
    if rule not in ("product", "weighted"):
        raise ValueError(f"unknown rule: {rule}")
    ratio, confidence = F.col("deviation_ratio"), F.col("confidence")
    if "deviation_ratio" in columns and "confidence" in columns:
        if rule == "product":
            return confidence * ratio
        clipped = F.greatest(F.least(confidence, F.lit(1.0)), F.lit(0.0))
        return 0.7 * ratio + 0.3 * clipped * ratio
    if "deviation_ratio" in columns:
        return ratio
    return confidence if "confidence" in columns else F.lit(1.0)


def most_interesting(anomalies: DataFrame, k: int = 5, rule: str = "product") -> DataFrame:
    scored = anomalies.withColumn("interest_score", interest_score(anomalies.columns, rule))
    return scored.orderBy(F.desc("interest_score"), "anomaly_id").limit(k)


def anomaly_stats(anomalies: DataFrame) -> DataFrame:
    """Counts and mean confidence in total, by type and by month (scope, value).

    One aggregation by type and month; the coarser levels are rolled up from its
    small result.  The total row is there (with zeros) for an empty table too.
    """
    cells = anomalies.groupBy("anomaly_type", "month").agg(
        F.count("*").alias("c"), F.sum("confidence").alias("s"), F.count("confidence").alias("k")
    )
    measures = [
        F.coalesce(F.sum("c"), F.lit(0)).alias("count"),
        F.coalesce(F.try_divide(F.sum("s"), F.sum("k")), F.lit(0.0)).alias("avg_confidence"),
    ]
    total = cells.agg(*measures).select(F.lit("total").alias("scope"), F.lit("all").alias("value"), "count", "avg_confidence")
    levels = [
        cells.groupBy(F.col(c).alias("value")).agg(*measures).select(F.lit(name).alias("scope"), "value", "count", "avg_confidence")
        for name, c in (("type", "anomaly_type"), ("month", "month"))
    ]
    return total.unionByName(levels[0]).unionByName(levels[1])


def type_by_month(anomalies: DataFrame, flag_only: bool = True) -> DataFrame:
    """Counts per month and type, 0 where none, months ascending.

    ``forecast_spike`` counts flagged rows, or with ``flag_only=False`` also rows
    whose type mentions a forecast.
    """
    forecast = F.coalesce(F.col("forecast_flag"), F.lit(False))
    if not flag_only:
        forecast = forecast | F.col("anomaly_type").ilike("%forecast%")
    counts = [F.count_if(F.col("anomaly_type") == t).alias(t) for t in TYPES]
    return anomalies.groupBy("month").agg(*counts, F.count_if(forecast).alias("forecast_spike")).orderBy("month")


def value_counts(anomalies: DataFrame, column: str) -> DataFrame:
    return anomalies.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def most_frequent(anomalies: DataFrame, column: str) -> DataFrame:
    return value_counts(anomalies, column).limit(1)


def largest_deviation(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("deviation_ratio").isNotNull()).orderBy(
        F.desc("deviation_ratio"), "anomaly_id"
    ).limit(1)


def insights(anomalies: DataFrame) -> DataFrame:
    """Up to four sentences (position, insight); none for an empty table."""
    count = F.col("count").cast("string")
    # The four sentence forms.
    largest = largest_deviation(anomalies).select(
        F.lit(1).alias("position"),
        F.concat(
            F.lit("In "), "month", F.lit(", "), "prev", F.lit(" → "), "curr",
            F.lit(" had the largest spike ("), fixed(F.col("deviation_ratio"), 1), F.lit("x baseline)."),
        ).alias("insight"),
    )
    page = most_frequent(anomalies, "curr").select(
        F.lit(2).alias("position"),
        F.concat(F.lit("'"), "curr", F.lit("' appears in "), count, F.lit(" anomaly records, the most of any page.")).alias("insight"),
    )
    month = most_frequent(anomalies, "month").select(
        F.lit(3).alias("position"),
        F.concat("month", F.lit(" had "), count, F.lit(" anomalies, the highest count of any month.")).alias("insight"),
    )
    referrer = most_frequent(anomalies, "prev").select(
        F.lit(4).alias("position"),
        F.concat(F.lit("'"), "prev", F.lit("' was the most common referrer source ("), count, F.lit(" occurrences).")).alias("insight"),
    )
    return largest.unionByName(page).unionByName(month).unionByName(referrer).orderBy("position")


def deviation_summary(anomalies: DataFrame, above: float = 5.0) -> DataFrame:
    ratio = F.col("deviation_ratio")
    return anomalies.agg(
        F.count_if(ratio > above).alias("rows_above"),
        F.max(ratio).alias("max_ratio"),
        F.min(ratio).alias("min_ratio"),
        F.avg(ratio).alias("avg_ratio"),
    )


def flagged_counts(rows: DataFrame) -> DataFrame:
    """Rows and forecast-flagged rows of a forecast or anomaly table."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("forecast_flag")).alias("flagged"))


def mean_confidence(anomalies: DataFrame, **filters) -> DataFrame:
    rows = matching(anomalies, **filters)
    return rows.agg(
        F.count("*").alias("count"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence")
    )


def months_with_anomalies(anomalies: DataFrame) -> DataFrame:
    return anomalies.select("month").distinct().orderBy("month")


def anomaly_by_id(anomalies: DataFrame, wanted: str | int | Column) -> DataFrame:
    key = wanted if isinstance(wanted, Column) else F.lit(str(wanted))
    return anomalies.filter(F.col("anomaly_id") == key)


def graph_edges(anomalies: DataFrame, k: int = 100, **filters) -> DataFrame:
    """The k most confident anomalies as graph edges."""
    top = top_by_confidence(matching(anomalies, **filters), k)
    return top.select(
        F.col("prev").alias("source"),
        F.col("curr").alias("target"),
        F.col("confidence").alias("weight"),
        "anomaly_type",
        "anomaly_id",
    )


def graph_nodes(anomalies: DataFrame, k: int = 100, **filters) -> DataFrame:
    """Distinct endpoints of those edges, with a label of at most 50 characters."""
    edges = graph_edges(anomalies, k, **filters)
    nodes = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return nodes.select("id", F.substring("id", 1, 50).alias("label"))


def precision_at_k(anomalies: DataFrame, truth: DataFrame, k: int = 50) -> DataFrame:
    """Share of the k most confident anomalies with an endpoint among the known pages.

    Divides by k even if there are fewer rows; k <= 0 gives 0.
    """
    if k <= 0:
        return anomalies.limit(0).agg(F.count("*").alias("hits")).select("hits", F.lit(0.0).alias("precision"))
    ends = top_by_confidence(anomalies, k).select(
        "anomaly_id", F.explode(F.array("prev", "curr")).alias("page")
    )
    hits = ends.join(truth.select("page"), "page", "left_semi").select("anomaly_id").distinct()
    return hits.agg(F.count("*").alias("hits")).select("hits", (F.col("hits") / F.lit(k)).alias("precision"))
