"""Checkpoints and scratch folders in the storage all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session may fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="trailmark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Lost executors do not matter to a stored table, and later plans start from
    its true size: a checkpointed DataFrame would keep the size estimate of its
    old plan, which grows without end in a loop.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, columns: list[str], buckets: int | None = None) -> tuple[DataFrame, str]:
    """The rows, written once in buckets of the columns' hash, and the name of the table, for ``drop_bucketed``.

    A join on just these columns leaves the stored side where it is and shuffles only the other.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"trailmark_{uuid.uuid4().hex}"
    dealt = df.repartition(count, *columns)
    dealt.write.bucketBy(count, *columns).sortBy(*columns).option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return spark.table(name), name


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; its files go with the shared folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
