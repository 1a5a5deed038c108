"""Known anomalous pages."""

from pyspark.sql import DataFrame, SparkSession


def ground_truth_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page").distinct()
