"""A local session for checks, tests and the benchmark."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trailmark")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        # call sites cost several round trips per column function while a plan is built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trailmark-"))
    return spark
