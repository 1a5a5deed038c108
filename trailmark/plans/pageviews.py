"""Anomalies next to daily page views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.skew import salted_join


def with_pageviews(anomalies: DataFrame, views: DataFrame) -> DataFrame:
    """Each anomaly with every daily view row of its page; unmatched anomalies stay."""
    named = views.select(F.col("page").alias("curr"), F.col("page"), "date", "views")
    return salted_join(anomalies, named, ["curr"], ["anomaly_id"], how="left", salts=4)


def views_around(anomalies: DataFrame, views: DataFrame, before: int = 30, after: int = 30) -> DataFrame:
    """Daily views from ``before`` days ahead of the anomaly month to ``after`` days into it.

    Works on distinct page-months.  The range join runs on (page, calendar month
    of the view), so each page-month meets only the months its range touches.
    """
    start = F.to_date(F.concat("month", F.lit("-01")))
    wanted = anomalies.select(F.col("curr").alias("page"), "month").distinct()
    ranged = wanted.withColumns({"_from": F.date_sub(start, before), "_to": F.date_add(start, after)})
    months = F.sequence(F.trunc("_from", "month"), F.trunc("_to", "month"), F.expr("interval 1 month"))
    keyed = ranged.withColumn("_bucket", F.explode(months))
    days = views.select("page", "date", "views", F.trunc("date", "month").alias("_bucket"))
    joined = keyed.join(days, ["page", "_bucket"])
    return joined.filter(F.col("date").between(F.col("_from"), F.col("_to"))).select("page", "month", "date", "views")


def daily_profiles(
    anomalies: DataFrame, views: DataFrame, before: int = 30, after: int = 30, near: int = 7, factor: float = 1.5
) -> DataFrame:
    """Per anomalous page-month: its daily views in order, and whether they spike too.

    A spike is a day near mid-month above ``factor`` times the mean of the range.
    The list is bounded by the days of the range.
    """
    rows = views_around(anomalies, views, before, after)
    middle = F.to_date(F.concat("month", F.lit("-15")))
    close = F.abs(F.datediff("date", middle)) <= near
    stats = rows.groupBy("page", "month").agg(
        F.sort_array(F.collect_list(F.struct("date", "views"))).alias("daily_pageviews"),
        F.max(F.when(close, F.col("views"))).alias("peak_views"),
        F.avg("views").alias("mean_views"),
    )
    match = F.coalesce(F.col("peak_views") > F.col("mean_views") * factor, F.lit(False))
    return stats.withColumn("daily_spike_match", match)


def daily_spike_match(anomalies: DataFrame, views: DataFrame, **window) -> DataFrame:
    return daily_profiles(anomalies, views, **window).drop("daily_pageviews")
