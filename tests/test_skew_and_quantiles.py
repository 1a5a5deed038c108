"""Hot keys and large inputs give the same results as small ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.functions import quantile
from trailmark.functions.lineage import cut_lineage, scratch_path, shared_folder
from trailmark.functions.skew import salted_join
from trailmark.operators.mixshift import js_shift, mix_shifts

MONTHS = ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_salted_join_equals_join(spark):
    large = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = sorted(map(tuple, salted_join(large, small, ["k"], ["id"], how).select("k", "id", "v").collect()), key=str)
        assert got == sorted(map(tuple, large.join(small, "k", how).select("k", "id", "v").collect()), key=str)
    with pytest.raises(ValueError):
        salted_join(large, small, ["k"], ["id"], "full")


@pytest.mark.parametrize("p", [0.0, 0.013, 0.5, 0.95, 0.999, 1.0])
@pytest.mark.parametrize("shape", ["distinct", "ties"])
def test_percentile_is_exact(spark, p, shape):
    number = F.pmod(F.xxhash64("id"), F.lit(1_000_003 if shape == "distinct" else 13)) / 7
    df = spark.range(60_000).select(number.alias("v"))
    want = np.percentile(np.array([r["v"] for r in df.collect()]), 100 * p)
    assert quantile.exact_percentile(df, "v", p) == pytest.approx(want, rel=1e-12)


def test_percentile_edges(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert quantile.exact_percentile(df, "v", 0.5) == 1.5
    assert quantile.exact_percentile(df.limit(0), "v", 0.5) is None


def test_checkpoints_use_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert scratch_path(spark, "x").startswith(folder.rstrip("/") + "/x-")
    assert cut_lineage(spark.range(5)).count() == 5


def hot_page(clicks_of):
    """One page with a third of all rows and many referrers, next to small pages."""
    rows = []
    for i in range(400):
        for j, m in enumerate(MONTHS):
            rows.append((f"r{i}", "hot", "link", m, 10 + (i * 31 + j * 17) % 97))
            rows.append((f"r{i}", f"cold{i % 100}", "link", m, 10 + (i * 13 + j * 29) % 89))
            rows.append((f"s{i}", f"cold{i % 100}", "link", m, 10 + (i * 7 + j * 5) % 83))
    return rows


def test_hot_page_against_brute_force(clicks_of):
    rows = hot_page(clicks_of)
    clicks = clicks_of(rows)
    got = js_shift(clicks, MONTHS).filter("curr = 'hot'").first()
    now, before = {}, {}
    for prev, curr, _, month, n in rows:
        if curr == "hot":
            side = now if month == "2024-04" else before
            side[prev] = side.get(prev, 0) + n
    p = np.array([now[k] for k in sorted(now)]) / sum(now.values())
    q = np.array([before[k] for k in sorted(now)]) / sum(before.values())
    m = (p + q) / 2
    want = np.sqrt(0.5 * np.sum(p * np.log(p / m)) + 0.5 * np.sum(q * np.log(q / m)))
    assert got["js_distance"] == pytest.approx(want, rel=1e-9)
    found = {r["prev"] for r in mix_shifts(clicks, MONTHS, ties="all").filter("curr = 'hot'").collect()}
    top = max(now.values())
    leaders = {k for k, v in now.items() if v == top}
    usual = {k for k, v in before.items() if v == max(before.values())}
    assert found == {k for k in leaders if usual - {k}}


def test_results_without_broadcasts(spark, clicks_of):
    clicks = clicks_of(hot_page(clicks_of))
    want = sorted(map(tuple, mix_shifts(clicks, MONTHS, use_js=True, js_threshold=0.05).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, mix_shifts(clicks, MONTHS, use_js=True, js_threshold=0.05).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
