"""Daily page views landed as JSON."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.lineage import scratch_path
from trailmark.functions.text import decode_title

FILE_NAME = r"([^/]+)_(\d{8})_(\d{8})\.json$"
VIEW_SCHEMA = "date string, views bigint"
RESPONSE_SCHEMA = "items array<struct<timestamp string, views bigint>>"


def read_daily_views(spark: SparkSession, path: str) -> DataFrame:
    """Files ``{Title}_{start}_{end}.json``, each an array of {date, views}.

    Ranges overlap: a page-day is kept once.
    """
    raw = spark.read.schema(VIEW_SCHEMA).option("multiLine", True).json(path)
    title = F.regexp_extract(decode_title(F.col("_metadata.file_path")), FILE_NAME.replace("_", " "), 1)
    rows = raw.select(
        F.replace(title, F.lit(" "), F.lit("_")).alias("page"),
        F.to_date(F.try_to_timestamp("date", F.lit("yyyyMMdd"))).alias("date"),
        "views",
    )
    return one_per_day(rows)


def land_daily_views(views: DataFrame, path: str) -> None:
    """Write (page, date, views) as files that ``read_daily_views`` takes, one for each page, in one job.

    The driver gives each page's file its name; a page's days are one JSON array.
    """
    spark = views.sparkSession
    staging = scratch_path(spark, "views")
    day = F.struct(F.date_format("date", "yyyyMMdd").alias("date"), "views")
    pages = views.groupBy("page").agg(F.sort_array(F.collect_list(day)).alias("days"))
    span = F.concat_ws("_", F.col("days")[0]["date"], F.element_at("days", -1)["date"])
    named = pages.select(F.concat_ws("_", F.regexp_replace("page", " ", "_"), span).alias("name"), F.to_json("days").alias("value"))
    named.repartition("name").write.partitionBy("name").text(staging)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = place(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place(path))
    for folder in system.listStatus(place(staging)):
        if folder.isDirectory():
            for file in system.listStatus(folder.getPath()):
                system.rename(file.getPath(), place(path, folder.getPath().getName().removeprefix("name=") + ".json"))
    system.delete(place(staging), True)


def one_per_day(rows: DataFrame) -> DataFrame:
    """Page-days once each; should fetches disagree, the larger count stands."""
    return rows.filter(F.col("date").isNotNull()).groupBy("page", "date").agg(F.max("views").alias("views"))


def flatten_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Raw responses (``page``, JSON text) to rows (page, date, views).

    The first eight characters of an item's timestamp are its day; missing
    views count as 0; a response without items gives no rows.
    """
    items = responses.select("page", F.explode(F.from_json(body, RESPONSE_SCHEMA)["items"]).alias("item"))
    day = F.substring(F.col("item.timestamp"), 1, 8)
    return items.select(
        "page",
        F.to_date(F.try_to_timestamp(day, F.lit("yyyyMMdd"))).alias("date"),
        F.coalesce("item.views", F.lit(0)).alias("views"),
    )
