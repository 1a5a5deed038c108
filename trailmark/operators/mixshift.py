"""Mix shifts: a page's referrers this month against all earlier months."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.scores import divergence_term, mix_confidence
from trailmark.functions.text import fixed
from trailmark.operators.referrers import aligned_distributions, page_tops, pair_series, pair_targets
from trailmark.schema import anomaly_id, as_anomalies


def target_months(months: list[str], min_baseline_months: int = 3) -> list[str]:
    return months[min_baseline_months:]


def js_shift(
    clicks: DataFrame, months: list[str], targets: list[str] | None = None, min_referrers: int = 3
) -> DataFrame:
    """Jensen-Shannon distance of a page's referrer shares in a month and in all months before.

    ``js_score`` is half the distance (0 to about 0.416); fewer referrers than
    ``min_referrers`` in the union give 0.
    """
    targets = target_months(months) if targets is None else targets
    return js_of_rows(pair_targets(pair_series(clicks, months), months, targets), min_referrers)


def js_of_rows(rows: DataFrame, min_referrers: int = 3) -> DataFrame:
    """``js_shift`` from rows of ``pair_targets``."""
    p, q = F.col("proportion"), F.col("baseline_proportion")
    both = aligned_distributions(rows).filter("total_n > 0 AND base_total > 0")
    sums = both.groupBy("curr", "month").agg(
        F.count("*").alias("referrers"),
        F.sum("n").alias("total_n"),
        F.sum(divergence_term(p, q)).alias("_p"),
        F.sum(divergence_term(q, p)).alias("_q"),
    )
    distance = F.when(F.col("referrers") >= min_referrers, F.sqrt(F.greatest((F.col("_p") + F.col("_q")) / 2, F.lit(0.0))))
    return sums.withColumn("js_distance", F.coalesce(distance, F.lit(0.0))).select(
        "curr", "month", "referrers", "total_n", "js_distance", (F.col("js_distance") / 2).alias("js_score")
    )


def top_pairings(rows: DataFrame, ties: str) -> DataFrame:
    """Top referrer of each page now and before, with the page's totals.

    ``first``: the alphabetically first of equally large ones on each side;
    ``all``: a row per combination of them, which grows with the product of the ties.
    """
    tops = page_tops(rows)
    if ties == "first":
        return tops
    held = rows.join(tops.drop("top_ref", "base_top_ref"), ["curr", "month"])
    now = held.filter("n = top_n").drop("n", "base_n").withColumnRenamed("prev", "top_ref")
    before = held.filter("base_n = base_top_n").select("curr", "month", F.col("prev").alias("base_top_ref"))
    return now.join(before, ["curr", "month"])


def mix_shifts(
    clicks: DataFrame,
    months: list[str],
    targets: list[str] | None = None,
    min_baseline_months: int = 3,
    share_change: float = 0.2,
    ties: str = "first",
    confidence: str = "interpolated",
    use_js: bool = False,
    js_threshold: float = 0.3,
    min_referrers: int = 3,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Pages whose top referrer changed or whose top share moved, for all targets at once.

    ``ties``: ``"first"`` takes the alphabetically first of tied top referrers, a row per
    page-month; ``"all"`` gives a row per combination of them.  ``pairs`` are the
    series of (curr, prev) if they are at hand; ``clicks`` is then not read.  ``use_js`` also reports pages
    whose divergence score reaches ``js_threshold``.
    """
    if ties not in ("all", "first"):
        raise ValueError(f"unknown ties: {ties}")
    targets = target_months(months, min_baseline_months) if targets is None else targets
    rows = pair_targets(pair_series(clicks, months) if pairs is None else pairs, months, targets)
    tops = top_pairings(rows, ties)
    compared = tops.withColumns(
        {
            "_share": F.col("top_n") / F.col("total_n"),
            "_base_share": F.col("base_top_n") / F.col("base_total"),
            "_changed": F.col("top_ref") != F.col("base_top_ref"),
        }
    ).withColumn("_change", F.abs(F.col("_share") - F.col("_base_share")))
    shifted = F.col("_changed") | (F.col("_change") >= share_change)
    if use_js:
        scores = js_of_rows(rows, min_referrers).select("curr", "month", "js_score")
        compared = compared.join(scores, ["curr", "month"], "left")
        shifted = shifted | F.coalesce(F.col("js_score") >= js_threshold, F.lit(False))
    # The two description texts.
    text = F.when(
        F.col("_changed"),
        F.concat(F.lit("Top referrer changed from "), F.col("base_top_ref"), F.lit(" to "), F.col("top_ref")),
    ).otherwise(F.concat(F.lit("Top referrer proportion changed by "), fixed(F.col("_change"), 2)))
    kind = F.lit("mix_shift")
    found = compared.filter(shifted)
    return as_anomalies(
        found.select(
            anomaly_id(kind, "month", "top_ref", "curr", F.lit("link"), "base_top_ref").alias("anomaly_id"),
            "month",
            F.col("top_ref").alias("prev"),
            "curr",
            F.lit("link").alias("type"),
            F.col("total_n").alias("n"),
            F.lit(0.0).alias("baseline_median"),
            F.col("_change").alias("deviation_ratio"),
            F.lit(0.0).alias("z_score"),
            kind.alias("anomaly_type"),
            mix_confidence(F.col("_changed"), F.col("_change"), confidence).alias("confidence"),
            text.alias("description"),
        )
    )
