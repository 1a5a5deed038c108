"""The stored anomaly table, partitioned by month and anomaly type."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.schema import ANOMALIES
from trailmark.sources.clicks import _writer


def write_anomalies(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Append to, overwrite, or replace months of the table; ``df`` must not be read from ``path``.

    ``mode="replace"`` puts the months of ``df`` in place of what the table holds of them, other months stay: a
    repeated run leaves one copy.  It is for Parquet; types that a month no longer has are removed after the
    others are written.
    """
    if mode != "replace":
        _writer(df, mode, ["month", "anomaly_type"], fmt).save(path)
        return
    if fmt != "parquet":
        raise ValueError("only Parquet tables have their months replaced")
    parts = {(r.month, r.anomaly_type) for r in df.select("month", "anomaly_type").distinct().collect()}
    _writer(df, "overwrite", ["month", "anomaly_type"], fmt).option("partitionOverwriteMode", "dynamic").save(path)
    context = df.sparkSession.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(context._jsc.hadoopConfiguration())
    for month in {m for m, _ in parts}:
        for status in system.listStatus(place(path, f"month={month}")):
            kind = status.getPath().getName().removeprefix("anomaly_type=")
            if status.isDirectory() and (month, kind) not in parts:
                system.delete(status.getPath(), True)


def read_anomalies(
    spark: SparkSession, path: str, filters: dict | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read with equality filters; those on month and type prune partitions."""
    if fmt not in ("parquet", "delta"):
        raise ValueError(f"unsupported format: {fmt}")
    df = spark.read.format(fmt).load(path)
    for name, value in (filters or {}).items():
        df = df.filter(F.col(name) == value)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ANOMALIES if f.name in df.columns])


def write_flat(df: DataFrame, path: str) -> None:
    """Unpartitioned Parquet; enriched copies go to a new path, never onto their input."""
    df.write.mode("errorifexists").parquet(path)
