"""What several operators need: word counts, stored steps, distributed running totals."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions.lineage import cut_lineage

#: The white space that separates words, \x20 and \x09 to \x0D.
SPACES = " \t\n\x0b\f\r"

#: A table of at most so many narrow rows may be sent to every executor.
SMALL_ROWS = 10_000

#: Rows that one task orders when running totals are formed.
BUCKET_ROWS = 4_000


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


#: Spark deletes the shuffle files of a query at its end, not only when the driver collects its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder once and read from there; the shuffles behind them are deleted."""
    conf = df.sparkSession.conf
    before = conf.get(_TIDY, None)
    conf.set(_TIDY, "true")
    try:
        return cut_lineage(df)
    finally:
        conf.set(_TIDY, before or "false")


def discard(*tables: DataFrame) -> None:
    """Delete stored tables from the shared folder; no later plan may read them."""
    for df in tables:
        spark = df.sparkSession
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast only if it has at most SMALL_ROWS rows."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def drawn(chance: Column, share: float) -> Column:
    """Whether a row is in a sample of about `share` of all; `chance` is a 64-bit hash of the row."""
    return F.pmod(chance, F.lit(2**40)) < int(min(share, 1.0) * 2**40)


def fraction(digest: Column) -> Column:
    """A number in [0, 1) that rises with a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def running_total(
    df: DataFrame, by: list[str], digest: str, order: list[str], value: str, rows: Column, name: str
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the same `by` that come earlier.

    Rows are ordered by `digest` (hex, spread evenly), then `order`.  A group of
    any size is cut into ranges of the digest of about BUCKET_ROWS rows each;
    only sums per range are brought together.  `rows` is the row count of the
    group.  Keys in `by` must not be null.
    """
    cut = F.floor(fraction(F.col(digest)) * F.ceil(F.greatest(rows, F.lit(1)) / BUCKET_ROWS)).cast("long")
    df = df.withColumn("_range", cut)
    keys = [*by, "_range"]
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(*keys).orderBy(digest, *order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, keys)
        .withColumn(name, (F.col("_start") + F.coalesce(F.sum(value).over(within), F.lit(0))).cast("long"))
        .drop("_range", "_start")
    )
