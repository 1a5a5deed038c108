import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import sketches
from trailmark.operators.edges import period_baselines

KEYS = ["prev", "curr"]


@pytest.fixture
def history(spark):
    rng = np.random.default_rng(8)
    rows = [("a", "b", f"2024-{m:02d}", int(n)) for m in range(1, 5) for n in rng.lognormal(4, 1, 3000)]
    rows += [("c", "d", "2024-02", 7), ("c", "d", "2024-03", None), ("hot", "d", "2024-04", 5)] + [("hot", "d", "2024-01", 9)] * 50
    return spark.createDataFrame(rows, "prev string, curr string, month string, n int").repartition(5)


def test_merged_months_agree_with_all_rows(spark, history, tmp_path):
    path = str(tmp_path / "kept")
    sketches.keep_months(sketches.month_sketches(history.filter("month < '2024-04'"), KEYS), path)
    sketches.keep_months(sketches.month_sketches(history.filter("month = '2024-04'"), KEYS), path)  # one more month, the others stay
    got = {(r.prev, r.curr): r for r in sketches.merged_baselines(sketches.read_sketches(spark, path), KEYS).collect()}
    want = {(r.prev, r.curr): r for r in period_baselines(history.filter("n IS NOT NULL"), KEYS).collect()}
    assert got.keys() == want.keys()
    values = np.sort([r.n for r in history.filter("prev = 'a'").collect()])
    rank = np.searchsorted(values, got["a", "b"].baseline_median) / len(values)
    assert abs(rank - 0.5) <= sketches.RANK_ERROR
    for key, w in want.items():
        g = got[key]
        assert g.baseline_mean == pytest.approx(w.baseline_mean) and g.baseline_std == pytest.approx(w.baseline_std)
        assert g.baseline_median == pytest.approx(w.baseline_median, rel=0.05)
        assert g.baseline_mad == pytest.approx(w.baseline_mad, rel=0.05, abs=0.1)


def test_a_repeated_month_changes_nothing(spark, history, tmp_path):
    path = str(tmp_path / "kept")
    rows = sketches.month_sketches(history, KEYS)
    sketches.keep_months(rows, path)
    found = lambda: sketches.merged_baselines(sketches.read_sketches(spark, path), KEYS).orderBy(*KEYS).collect()
    before = found()
    sketches.keep_months(rows.filter("month = '2024-02'"), path)
    for a, b in zip(before, found(), strict=True):  # sketches draw by chance which values they keep
        assert (a.prev, a.curr) == (b.prev, b.curr) and (a.baseline_mean, a.baseline_std) == pytest.approx((b.baseline_mean, b.baseline_std))
        assert a.baseline_median == pytest.approx(b.baseline_median, rel=0.05)
    assert sketches.read_sketches(spark, path).select("month").distinct().count() == 4
    assert sketches.month_sketches(history.filter(F.lit(False)), KEYS).count() == 0
