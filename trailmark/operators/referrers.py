"""Referrer distributions of pages."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.operators.edges import monthly_series


def referrer_distribution(clicks: DataFrame) -> DataFrame:
    """Share of each referrer in a page's traffic of a month.

    Totals are aggregated and joined back: a window per page-month would put all
    referrers of a hot page in one task, while a join of sorted sides is split
    where adaptive execution measures skew.
    """
    counts = clicks.groupBy("curr", "prev", "month").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("curr", "month").agg(F.sum("n").alias("total_n"))
    joined = counts.join(totals, ["curr", "month"])
    return joined.select(
        "curr", "prev", "month", "n", (F.col("n") / F.col("total_n")).alias("proportion"), "total_n"
    )


def page_distribution(distribution: DataFrame, page: str, months: list[str]) -> DataFrame:
    """One page's distribution over some months, largest share first."""
    rows = distribution.filter((F.col("curr") == page) & F.col("month").isin(months))
    return rows.select("month", "prev", "proportion", "n").orderBy("month", F.desc("proportion"), "prev")


def pair_series(clicks: DataFrame, months: list[str]) -> DataFrame:
    return monthly_series(clicks, ["curr", "prev"], months)


def pair_targets(pairs: DataFrame, months: list[str], targets: list[str]) -> DataFrame:
    """One row per pair and target month: its count then (``n``, null if absent) and
    its count pooled over all earlier months (``base_n``, 0 if absent).

    A pair's running sums are folded in one pass over its months; the plan is the
    same for any number of months.
    """
    wanted = [i for i, m in enumerate(months) if m in targets]
    slots = F.expr(
        """aggregate(series, named_struct('sum', 0L, 'pos', 0, 'out', CAST(array() AS array<struct<_pos: int, n: bigint, base_n: bigint>>)),
            (acc, n) -> named_struct('sum', acc.sum + coalesce(n, 0L), 'pos', acc.pos + 1,
                                     'out', concat(acc.out, array(named_struct('_pos', acc.pos, 'n', n, 'base_n', acc.sum))))
        ).out"""
    )
    rows = pairs.select("curr", "prev", F.inline(slots)).filter(F.col("_pos").isin(wanted))
    rows = rows.filter(F.col("n").isNotNull() | (F.col("base_n") > 0))
    return rows.select("curr", "prev", S.month_at("_pos", months).alias("month"), "n", "base_n")


def page_tops(rows: DataFrame) -> DataFrame:
    """Each page-month's totals and largest counts, then and before, with the alphabetically first referrer that has them.

    One aggregation, combined map-side; page-months without traffic on either side are left out.
    """

    def top(count, name):
        return F.min(F.when(F.col(count) > 0, F.struct((-F.col(count)).alias("n"), "prev"))).alias(name)

    tops = rows.groupBy("curr", "month").agg(
        F.sum("n").alias("total_n"), F.sum("base_n").alias("base_total"), top("n", "_top"), top("base_n", "_base_top")
    )
    return tops.filter("total_n > 0 AND base_total > 0").select(
        "curr",
        "month",
        "total_n",
        "base_total",
        (-F.col("_top.n")).alias("top_n"),
        (-F.col("_base_top.n")).alias("base_top_n"),
        F.col("_top.prev").alias("top_ref"),
        F.col("_base_top.prev").alias("base_top_ref"),
    )


def aligned_distributions(rows: DataFrame) -> DataFrame:
    """Target and pooled baseline share of each referrer, side by side (0 if absent)."""
    totals = rows.groupBy("curr", "month").agg(
        F.sum("n").alias("total_n"), F.sum("base_n").alias("base_total")
    )
    joined = rows.join(totals, ["curr", "month"])
    share = F.when(F.col("total_n") > 0, F.coalesce(F.col("n"), F.lit(0)) / F.col("total_n"))
    base = F.when(F.col("base_total") > 0, F.col("base_n") / F.col("base_total"))
    return joined.select(
        "curr",
        "prev",
        "month",
        F.coalesce(share, F.lit(0.0)).alias("proportion"),
        F.coalesce(base, F.lit(0.0)).alias("baseline_proportion"),
        "n",
        "base_n",
        "total_n",
        "base_total",
    )


def pooled_distribution(rows: DataFrame) -> DataFrame:
    """Share of each referrer over all months before the target month."""
    pooled = aligned_distributions(rows).filter(F.col("base_n") > 0)
    return pooled.select("curr", "prev", "month", "base_n", "baseline_proportion")


def top_referrers(clicks: DataFrame, months: list[str], last: int = 6, k: int = 10) -> DataFrame:
    """The k largest referrers of each page in each of the last months of the data.

    ``months`` is the ordered month list; the last ones in it are taken.  The
    rank filter is applied per map task before the shuffle, so a hot page sends
    k rows per task.
    """
    recent = clicks.filter(F.col("month").isin(months[-last:]))
    counts = recent.groupBy("curr", "month", "prev").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("curr", "month").orderBy(F.desc("n"), "prev")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    totals = counts.groupBy("curr", "month").agg(F.sum("n").alias("total"))
    joined = best.join(totals, ["curr", "month"])
    return joined.select(
        "curr", "month", "rank", "prev", "n", "total", (F.col("n") / F.col("total")).alias("proportion")
    )


def nested_top_referrers(tops: DataFrame) -> DataFrame:
    """One row per page: its months in order, each with total and ranked referrers.

    Both lists are bounded, by the referrers kept per month and the months kept.
    """
    monthly = tops.groupBy("curr", "month").agg(
        F.first("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("rank", "prev", "n", "proportion"))).alias("_ranked"),
    )
    plain = F.transform(
        "_ranked", lambda r: F.struct(r["prev"].alias("prev"), r["n"].alias("n"), r["proportion"].alias("proportion"))
    )
    monthly = monthly.withColumn("referrers", plain)
    return monthly.groupBy("curr").agg(
        F.sort_array(F.collect_list(F.struct("month", "total", "referrers"))).alias("referrer_shares")
    )
