"""Navigation tables derived from order lines and click events."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Known layouts: reading with a schema spares a job per table to look at footers.
LAYOUTS = {
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{folder}/{name}.parquet")


def order_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier nation -> part type moves, one raw row per order line."""
    lines = table(spark, folder, "lineitem")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    joined = (
        lines.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(nations, F.col("n_nationkey") == F.col("s_nationkey"))
        .join(parts, F.col("p_partkey") == F.col("l_partkey"))
    )
    kind = (
        F.when(F.col("l_returnflag") == "R", F.lit("link"))
        .when(F.col("l_returnflag") == "A", F.lit("external"))
        .otherwise(F.lit("other"))
    )
    return joined.select(
        F.when(F.col("s_nationkey") % 6 == 0, F.concat(F.lit("other-"), F.col("n_name")))
        .otherwise(F.col("n_name"))
        .alias("prev"),
        F.col("p_type").alias("curr"),
        kind.alias("type"),
        F.col("l_quantity").cast("int").alias("n"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
    )


def event_transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Each user event with the type of the event before it (``other-empty`` if first).

    The look-back runs per user and day; the first event of a user's day takes
    the last type of the user's previous active day from a small aggregate.  So
    one very active user is split over days.
    """
    events = table(spark, folder, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("day")
    )
    within = Window.partitionBy("user_id", "day").orderBy("ts", "event_id")
    lagged = events.withColumn("_before", F.lag("event_type").over(within))
    day_ends = events.groupBy("user_id", "day").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("_end")
    )
    across = Window.partitionBy("user_id").orderBy("day")
    carried = day_ends.select("user_id", "day", F.lag("_end").over(across).alias("_carried"))
    joined = lagged.join(carried, ["user_id", "day"])
    return joined.select(
        F.coalesce("_before", "_carried", F.lit("other-empty")).alias("prev"),
        F.col("event_type").alias("curr"),
        F.lit(1).alias("n"),
        "ts",
        "day",
    )


def daily_views(spark: SparkSession, folder: str) -> DataFrame:
    """Views per part type and day."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("page"))
    return (
        lines.join(parts, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy("page", F.to_date("l_shipdate").alias("date"))
        .agg(F.sum(F.col("l_quantity").cast("int")).alias("views"))
    )


def known_pages(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").filter(F.col("n_regionkey") == 0)
    return nations.select(
        F.when(F.col("n_nationkey") % 6 == 0, F.concat(F.lit("other-"), F.col("n_name")))
        .otherwise(F.col("n_name"))
        .alias("page")
    )
