"""Monthly click files and the cleaned table."""

import logging
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.operators.cleaning import clean_clicks
from trailmark.schema import RAW_CLICKS

log = logging.getLogger(__name__)

MONTH_IN_NAME = r"(\d{4}-\d{2})[^/]*$"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) matches anything, on any file system Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(target)
    return matches is not None and len(matches) > 0


def _tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated text with a header; malformed counts become null."""
    return (
        spark.read.schema(RAW_CLICKS)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    return _tsv(spark, path).withColumn("month", F.lit(month))


def read_months(spark: SparkSession, files: Iterable[tuple[str, str]]) -> DataFrame:
    """Read (path, month) pairs; absent files are skipped with a warning.

    Files whose name carries their month are read in one scan that takes the
    month from the file name; the others are read one by one and unioned.
    """
    found = []
    for path, month in files:
        if path_exists(spark, path):
            found.append((path, month))
        else:
            log.warning("no file for %s: %s", month, path)
    if not found:
        raise ValueError("no click files found")
    named, other = [], []
    for path, month in found:
        match = re.search(MONTH_IN_NAME, path)
        (named if match and match.group(1) == month and path.count(month) == 1 else other).append((path, month))
    parts = []
    if named:
        scan = _tsv(spark, [path for path, _ in named])
        from_name = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2})(?=[^/]*(/part-[^/]*)?$)", 1)
        parts.append(scan.withColumn("month", from_name))
    parts += [read_month(spark, path, month) for path, month in other]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _writer(df: DataFrame, mode: str, partitions: list[str], fmt: str):
    if fmt not in ("parquet", "delta"):
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.format(fmt).mode(mode).partitionBy(*partitions)
    return writer.option("compression", "snappy") if fmt == "parquet" else writer


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", replace_months_only: bool = False) -> None:
    """Overwrite the cleaned table, or only the months present in ``df``."""
    writer = _writer(df, "overwrite", ["month"], fmt)
    if replace_months_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def read_clean(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def clean_or_load(
    spark: SparkSession, path: str, files: Iterable[tuple[str, str]], min_transitions: int = 10
) -> DataFrame:
    """The cleaned table: as stored if a write of it was finished, else read, cleaned and stored."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_clean(clean_clicks(read_months(spark, files), min_transitions), path)
    return read_clean(spark, path)
