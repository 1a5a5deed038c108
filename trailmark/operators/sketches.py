"""Baselines kept up month by month: sketches of what has been seen, merged instead of read again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a quantile sketch; the rank of a quantile is off by about RANK_ERROR of the values at most.
SKETCH_SIZE, RANK_ERROR = 400, 0.01
#: Quantiles from which the mean deviation is read.
QUANTILES = 200


def month_sketches(history: DataFrame, keys: list[str], by: str = "month") -> DataFrame:
    """(keys, by, values, total, squares, sketch): what is kept of the counts ``n`` of a key in a month.

    ``n`` is a whole number; null counts are left out.  Map-side sketches of a hot key are merged, its rows never meet.
    """
    n = F.col("n").cast("bigint")
    return (
        history.filter("n IS NOT NULL")
        .groupBy(*keys, by)
        .agg(
            F.count("*").alias("values"),
            F.sum(n.cast("double")).alias("total"),
            F.sum(n.cast("double") * n).alias("squares"),
            F.kll_sketch_agg_bigint(n, F.lit(SKETCH_SIZE)).alias("sketch"),
        )
    )


def keep_months(sketches: DataFrame, path: str, by: str = "month") -> None:
    """Put months into a stored table of sketches; a month that is already there is replaced, so a repeated run changes nothing."""
    rows = sketches.repartition(by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_sketches(spark: SparkSession, path: str, by: str = "month") -> DataFrame:
    return spark.read.parquet(path).withColumn(by, F.col(by).cast("string"))


def merged_baselines(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Baselines of each key over all months of its sketches, with the columns of ``period_baselines``.

    Mean and deviation are exact up to rounding.  The median's rank is within RANK_ERROR of the middle; the mean
    deviation is that of QUANTILES evenly spaced quantiles of the sketch.
    """
    merged = sketches.groupBy(*keys).agg(
        F.sum("values").alias("_n"),
        F.sum("total").alias("_total"),
        F.sum("squares").alias("_squares"),
        F.kll_merge_agg_bigint("sketch").alias("_sketch"),
    )
    ranks = F.array(*[F.lit((k + 0.5) / QUANTILES) for k in range(QUANTILES)])
    known = merged.select(
        *keys,
        "_n",
        (F.col("_total") / F.col("_n")).alias("baseline_mean"),
        "_total",
        "_squares",
        F.kll_sketch_get_quantile_bigint("_sketch", F.lit(0.5)).cast("double").alias("baseline_median"),
        F.kll_sketch_get_quantile_bigint("_sketch", ranks).alias("_quantiles"),
    )
    spread = (F.col("_squares") - F.col("_total") * F.col("_total") / F.col("_n")) / (F.col("_n") - 1)
    std = F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0))))
    off = F.aggregate("_quantiles", F.lit(0.0), lambda total, q: total + F.abs(q - F.col("baseline_median"))) / QUANTILES
    return known.select(*keys, "baseline_median", "baseline_mean", F.coalesce(std, F.lit(0.01)).alias("baseline_std"), off.alias("baseline_mad"))
