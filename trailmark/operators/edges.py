"""Per-edge monthly series, baselines and features."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.functions.skew import salted_join
from trailmark.schema import EDGE

def edge_month(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*EDGE, "month").agg(F.sum("n").alias("n"))


def monthly_series(clicks: DataFrame, keys: list[str], months: list[str]) -> DataFrame:
    """One row per key with ``series``: monthly sums in list order, null where absent.

    Raw rows are summed map-side per key and month, so those of a hot key never
    meet in one task; the plan does not grow with the months.
    """
    position = F.array_position(S.text_array(months), F.col("month"))
    rows = clicks.filter(F.col("month").isin(months)).select(*keys, position.alias("_m"), "n")
    return _assembled(rows, keys, months)


def _assembled(rows: DataFrame, keys: list[str], months: list[str]) -> DataFrame:
    """``series`` of each key from rows (keys, _m counted from 1, n)."""
    summed = rows.groupBy(*keys, "_m").agg(F.sum("n").alias("n"))
    found = summed.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_m", "n"))).alias("_found")
    )
    slots = F.sequence(F.lit(1).cast("bigint"), F.lit(len(months)).cast("bigint"))
    return found.select(*keys, F.transform(slots, lambda m: F.col("_found")[m]).alias("series"))


def pairs_of(series: DataFrame, months: list[str]) -> DataFrame:
    """The series of (curr, prev) from those of edges, summed over the types."""
    points = series.select("curr", "prev", F.posexplode("series").alias("_pos", "n")).filter(F.col("n").isNotNull())
    rows = points.select("curr", "prev", (F.col("_pos") + 1).cast("bigint").alias("_m"), "n")
    return _assembled(rows, ["curr", "prev"], months)


def edge_series(clicks: DataFrame, months: list[str]) -> DataFrame:
    return monthly_series(clicks, EDGE, months)


def month_pivot(series: DataFrame, months: list[str]) -> DataFrame:
    """One column per month, 0 where the edge had no traffic."""
    return series.selectExpr(*EDGE, *[f"coalesce(series[{i}], 0) AS `{m}`" for i, m in enumerate(months)])


def with_stats(df: DataFrame, history: str = "series", mad: str = "mean_abs") -> DataFrame:
    """Add median, mean, deviation and absolute deviation of a history array.

    Months without traffic are not zeros: they are left out.
    """
    if mad not in ("mean_abs", "median_abs"):
        raise ValueError(f"unknown mad: {mad}")
    deviation = S.mean_abs_dev if mad == "mean_abs" else S.median_abs_dev
    prepared = df.withColumn("_values", S.present(history)).withColumns(
        {"_median": S.lower_median("_values"), "_mean": S.mean("_values")}
    )
    return prepared.withColumns(
        {
            "baseline_median": F.expr("coalesce(CAST(_median AS DOUBLE), 0D)"),
            "baseline_mean": F.expr("coalesce(_mean, 0D)"),
            "baseline_std": F.coalesce(S.sample_std("_values", "_mean"), F.lit(0.01)),
            "baseline_mad": F.coalesce(deviation("_values", "_median"), F.lit(0.01)),
            "history_months": F.size("_values"),
        }
    ).drop("_values", "_median", "_mean")


BASELINE_COLUMNS = ["baseline_median", "baseline_mean", "baseline_std", "baseline_mad"]


def edge_baselines(series: DataFrame, mad: str = "mean_abs") -> DataFrame:
    """Baseline statistics of each edge over its whole series."""
    return with_stats(series, mad=mad).select(*EDGE, *BASELINE_COLUMNS)


def period_baselines(history: DataFrame, keys: list[str]) -> DataFrame:
    """Baselines per key over any number of periods (rows with ``n``), e.g. hours.

    The long form for when periods do not fit an array: a sketch median, then
    the deviation from it.
    """
    stats = history.groupBy(*keys).agg(
        F.percentile_approx("n", 0.5).cast("double").alias("baseline_median"),
        F.avg("n").alias("baseline_mean"),
        F.stddev_samp("n").alias("_std"),
    )
    centred = salted_join(history, stats.select(*keys, "baseline_median"), keys, history.columns)
    deviation = centred.groupBy(*keys).agg(F.avg(F.abs(F.col("n") - F.col("baseline_median"))).alias("baseline_mad"))
    return stats.join(deviation, keys).select(
        *keys, "baseline_median", "baseline_mean", F.coalesce("_std", F.lit(0.01)).alias("baseline_std"), "baseline_mad"
    )


def raw_row_baselines(clicks: DataFrame) -> DataFrame:
    """Exact median, mean and deviation over raw rows, not monthly sums.

    Rows are first reduced to value counts, so a hot edge sends each distinct
    count once; the windows run over those counts and can spill.
    """
    by_edge = Window.partitionBy(*EDGE)
    counts = clicks.groupBy(*EDGE, "n").agg(F.count("*").alias("c"))
    ranked = counts.select(
        *EDGE,
        "n",
        "c",
        F.sum("c").over(by_edge.orderBy("n")).alias("upto"),
        F.sum("c").over(by_edge).alias("rows"),
        (F.sum(F.col("n") * F.col("c")).over(by_edge) / F.sum("c").over(by_edge)).alias("mean"),
    )

    def at(rank):
        return F.min(F.when(F.col("upto") >= rank, F.col("n")))

    stats = ranked.groupBy(*EDGE).agg(
        ((at(F.floor((F.col("rows") + 1) / 2)) + at(F.floor((F.col("rows") + 2) / 2))) / 2).alias(
            "baseline_median"
        ),
        F.first("mean").alias("baseline_mean"),
        F.sum(F.col("c") * F.pow(F.col("n") - F.col("mean"), F.lit(2.0))).alias("_squares"),
        F.first("rows").alias("_rows"),
    )
    deviation = edge_month(clicks).join(stats, EDGE).groupBy(*EDGE).agg(
        F.first("baseline_median").alias("baseline_median"),
        F.first("baseline_mean").alias("baseline_mean"),
        F.first("_squares").alias("_squares"),
        F.first("_rows").alias("_rows"),
        F.avg(F.abs(F.col("n") - F.col("baseline_median"))).alias("baseline_mad"),
    )
    std = F.when(F.col("_rows") > 1, F.sqrt(F.col("_squares") / (F.col("_rows") - 1)))
    return deviation.select(
        *EDGE,
        "baseline_median",
        "baseline_mean",
        F.coalesce(std, F.lit(0.01)).alias("baseline_std"),
        "baseline_mad",
    )


def edge_features(series: DataFrame, months: list[str]) -> DataFrame:
    """Monthly counts, their ratio to the median, baselines and one-hot edge type."""
    counts = [f"coalesce(series[{i}], 0) AS `{m}`" for i, m in enumerate(months)]
    ratios = [
        f"CASE WHEN baseline_median > 0 THEN coalesce(series[{i}], 0) / baseline_median ELSE 0D END AS `ratio_{m}`"
        for i, m in enumerate(months)
    ]
    kinds = [f"CASE WHEN type = '{t}' THEN 1D ELSE 0D END AS type_{t}" for t in ("link", "external", "other")]
    return with_stats(series).selectExpr(
        *EDGE, "baseline_median", "baseline_mean", "baseline_mad", *counts, *ratios, *kinds
    )


def last_months(series: DataFrame, months: list[str], k: int = 6) -> DataFrame:
    """The last k months in which each edge had traffic, one row per month."""
    points = series.withColumn("_points", S.named_points(months))
    return points.select(*EDGE, F.inline(S.last("_points", k)).alias("month", "n"))
