"""Exact percentiles that never bring all values to one task."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges in which values are counted at a time; so many rows come to the driver, whatever the data.
BINS = 1_000
#: The same for each of several groups.
GROUP_BINS = 100


def _order_statistic(values: DataFrame, rank: int, low: float, high: float) -> tuple[float, int]:
    """The value at a rank counted from 0, and how many values do not exceed it.

    Values are counted in equal ranges between ``low`` and ``high``; the range that
    holds the rank, shrunk to the least and largest value in it, is taken next.
    """
    below = 0
    while True:
        place = F.floor((F.col("v") - F.lit(low)) / F.lit(high - low) * BINS) if high > low else F.lit(0)
        bins = (
            values.filter(F.col("v").between(low, high))
            .groupBy(F.least(place, F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        for row in sorted(bins.collect(), key=lambda r: r["bin"]):
            if below + row["n"] > rank:
                low, high = row["low"], row["high"]
                break
            below += row["n"]
        if low == high:
            return low, below + row["n"]


def exact_percentile(df: DataFrame, value: str, p: float) -> float | None:
    """Percentile with linear interpolation; ``p`` in 0..1, null values left out.

    ``df`` is read a few times: hand in a stored table if it is costly.
    """
    values = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    head = values.agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if head["rows"] == 0:
        return None
    rank = p * (head["rows"] - 1)
    first, second = math.floor(rank), math.ceil(rank)
    at_first, upto = _order_statistic(values, first, head["low"], head["high"])
    if second < upto:
        return float(at_first)
    at_second = values.filter(F.col("v") > at_first).agg(F.min("v")).first()[0]
    return float(at_first + (rank - first) * (at_second - at_first))


def exact_percentiles(df: DataFrame, by: str, value: str, p: float) -> dict:
    """``exact_percentile`` of every group of ``by``, all groups in the same rounds.

    The driver holds one range for each group (a month, not a page) and gets GROUP_BINS counts of it
    in a round.  Groups without values are left out.
    """
    values = df.select(F.col(by).alias("k"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    heads = values.groupBy("k").agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    ranges = {r.k: [r.low, r.high, 0, math.floor(p * (r.rows - 1))] for r in heads}
    found: dict = {}
    spark = df.sparkSession
    schema = values.select("k", F.col("v").alias("low"), F.col("v").alias("high")).schema
    while ranges:
        table = F.broadcast(spark.createDataFrame([(k, low, high) for k, (low, high, *_) in ranges.items()], schema))
        place = F.when(F.col("high") > F.col("low"), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * GROUP_BINS))
        bins = (
            values.join(table, values["k"].eqNullSafe(table["k"]))
            .filter(F.col("v").between(F.col("low"), F.col("high")))
            .groupBy(values["k"], F.least(F.coalesce(place, F.lit(0)), F.lit(GROUP_BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        )
        for row in sorted(bins.collect(), key=lambda r: r.bin):
            state = ranges.get(row.k)
            if state is None or len(state) > 4:
                continue
            if state[2] + row.n > state[3]:
                state[0], state[1] = row.least, row.most
                state.append(row.n)  # the range that holds the rank: later ones of this round do not count
            else:
                state[2] += row.n
        for k, state in list(ranges.items()):
            n = state.pop()
            if state[0] == state[1]:
                found[k] = (state[0], state[2] + n)
                del ranges[k]
    out, after = {}, {}
    for r in heads:
        rank, (at, upto) = p * (r.rows - 1), found[r.k]
        out[r.k] = float(at)
        if math.ceil(rank) >= upto:
            after[r.k] = (at, rank - math.floor(rank))
    if after:
        table = F.broadcast(spark.createDataFrame([(k, at, at) for k, (at, _) in after.items()], schema))
        nexts = values.join(table, values["k"].eqNullSafe(table["k"])).filter(F.col("v") > F.col("low")).groupBy(values["k"]).agg(F.min("v").alias("v"))
        for r in nexts.collect():
            at, part = after[r.k]
            out[r.k] = float(at + part * (r.v - at))
    return out
