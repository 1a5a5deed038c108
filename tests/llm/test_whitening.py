from fractions import Fraction
from math import floor

import numpy as np
import pytest

from trailmark.llm import whitening

FOLDER = "/root/testdata/sf0.01"


def brute_whitening(rows, most=32):
    """The contract word by word, with fractions instead of polarisation: {id: (deviation, x - mean)}, covariance."""
    usable = [(i, [floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    n, d = len(usable), len(usable[0][1])
    sums = [sum(x[j] for _, x in usable) for j in range(d)]
    centred = [[n * x[j] - sums[j] for j in range(d)] for _, x in usable]
    covariance = [[float(Fraction(sum(z[i] * z[j] for z in centred), n**3)) for j in range(d)] for i in range(d)]
    return n, [(i, sum(v * v for v in z), [v / n for v in z]) for (i, _), z in zip(usable, centred, strict=True)], np.array(covariance)


def against_brute(got, rows, most=32):
    n, wanted, covariance = brute_whitening(rows, most)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    white = np.array([x for _, _, x in wanted]) @ vectors / np.sqrt(values)
    assert len(got) == len(wanted) * len(values)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, []).append(r)
    first = sorted(by_row[wanted[0][0]], key=lambda r: r.component)
    signs = np.sign([r.whitened for r in first]) * np.sign(white[0])
    for (i, deviation, _), w in zip(wanted, white, strict=True):
        found = sorted(by_row[i], key=lambda r: r.component)
        assert [r.component for r in found] == list(range(1, len(values) + 1))
        assert {(r.n, r.deviation) for r in found} == {(n, deviation)}
        assert np.allclose([r.whitened for r in found] * signs, w, atol=1e-7)
        assert np.allclose([r.explained for r in found], values / np.trace(covariance), rtol=1e-9)
        assert all(r.identity_error < 1e-6 for r in found)


def test_whitening_of_all_embeddings(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    against_brute(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=5) @ rng.normal(size=(5, 5))).tolist()) for k in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1e300] * 5), (106, [1.0])]
    table = spark.createDataFrame([(i, v, 1, "c") for i, v in rows + odd], "vec_id long, embedding array<double>, n int, component string")
    got = whitening.whiten(table.repartition(5)).collect()
    against_brute(got, rows)
    twice = whitening.whiten(table.unionAll(table)).collect()
    assert len(twice) == 2 * len(got)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id = 3")).count() == 0  # a single vector has no variance
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (None, [3.0, 6.0])], "vec_id long, embedding array<double>")
    assert sorted(r.component for r in whitening.whiten(flat).collect()) == [1, 1, 1]


@pytest.mark.parametrize("size", [2**10, 2**31 - 1, 2**40, 2**61, 2**62])
def test_square_sums_are_exact(size):
    rng = np.random.default_rng(size % 97)
    values = rng.integers(-size, size, (300, 4), endpoint=True)
    want = [sum(int(v) ** 2 for v in values[:, k]) for k in range(4)]
    assert whitening._square_sums(values) == want
    assert whitening._square_sums(values.astype(object)) == want


def test_wide_entries_stay_exact(spark):
    rows = [(k, [float(k % 4) * 2.0**50, float(k % 5)]) for k in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(whitening.stepped(table, "vec_id", "embedding", 64, 1_000_000))
    assert np.allclose(model.covariance, brute_whitening(rows)[2], rtol=1e-15)
    assert {r.deviation for r in whitening.whiten(table).collect()} == {None}  # beyond a long
