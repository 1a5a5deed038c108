"""Replay of a historical table as a stream, and the stream's sinks."""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmark.functions.lineage import scratch_path


def write_replay(df: DataFrame, path: str, slice_column: str, files_per_slice: int = 1, newest_first: bool = False) -> None:
    """Write event-time slices in one job, so that a stream reads them one after the other; every row is in one.

    ``newest_first`` is for trying out late rows.

    The slices are the distinct values of ``slice_column`` (days, weeks, ...), which may not be
    null.  A file source reads files in the order of their times: each slice's files get a time of their own, a
    second after the slice before, as the slices' order says.  Rows are safe from
    the watermark if its delay covers one slice, or if a slice is one file (or
    all files of a slice are read in one trigger).  The folder must keep file times that are set, as HDFS and local disks do.
    """
    spark = df.sparkSession
    staging = scratch_path(spark, "slices")
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_slice))
    marked = df.withColumn("_slice", F.col(slice_column)).withColumn("_part", part)
    marked.repartition("_slice", "_part").write.partitionBy("_slice", "_part").parquet(staging)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = place(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().getName(), s.getPath()) for s in system.listStatus(place(staging)) if s.isDirectory()]
    if any(name == "_slice=__HIVE_DEFAULT_PARTITION__" for name, _ in found):
        raise ValueError(f"rows without {slice_column} belong to no slice")
    found.sort(key=lambda f: f[0], reverse=newest_first)
    system.mkdirs(place(path))
    # earlier replays into the same folder come first
    times = [s.getModificationTime() for s in system.listStatus(place(path)) if s.isFile()]
    now = max([int(time.time() * 1000) - 1000 * len(found), *times])
    for k, (_, folder) in enumerate(found):
        for status in system.listStatus(folder):
            for file in system.listStatus(status.getPath()):
                name = place(path, f"slice-{uuid.uuid4().hex}.parquet")
                system.rename(file.getPath(), name)
                system.setTimes(name, now + 1000 * (k + 1), -1)
    system.delete(place(staging), True)


def end_replay(df: DataFrame, path: str, time: str, ahead: str = "30 days") -> None:
    """Repeat the last row far ahead in event time, as a slice after all others.

    It moves the watermark past every real window, so that append mode gives
    them all out; its own window stays open and is never reported.
    """
    last = df.agg(F.max_by(F.struct(*df.columns), time).alias("_row")).select("_row.*")
    last = last.withColumn(time, F.col(time) + F.expr(f"interval {ahead}"))
    write_replay(last.withColumn("_end", F.lit(1)), path, "_end")


def open_replay(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Closed windows to Parquet, each exactly once; ends with the available input."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def put_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Each batch to a folder of its own; a batch that is repeated after a failure replaces what it had written."""

    def put(rows: DataFrame, batch: int) -> None:
        put_batch(rows, batch, path)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def put_batch(rows: DataFrame, batch: int, path: str) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def show_updates(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Changed windows of every batch to the console, unshortened."""
    return (
        stream.writeStream.outputMode("update")
        .format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query; stop it if the wait is interrupted."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped in the recent batches."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
