"""Whitening of vectors whose covariance comes from squares alone.

By polarisation, cov(a, b) = (var(a + b) - var(a) - var(b)) / 2.  Entries are rounded down to
whole steps, so that every square of a centred value, n*x - S, is a whole number: the sums of squares of all
dimensions and of all sums of two dimensions are exact, whatever the order in which
tasks add them up.  The driver gets one number for each pair of dimensions, assembles the covariance and
decomposes it; the number of rows does not matter to it.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import stored

#: Rows whose squares are formed at a time.
ROWS = 2_048
#: Sums travel as a high and a low part of so many.
PART = 10**18
#: An entry times `step` lies below this, so that it has an exact place among longs.
WIDEST = 2.0**62


@dataclass
class Whitener:
    """n rows with the sums `totals`; column k of `components` is a unit eigenvector with the eigenvalue `values[k]`.

    `trace` is the sum of all eigenvalues, `covariance` what they come from.
    Only components of positive variance are kept, at most as many as were asked for.
    """

    n: int
    totals: list[int]
    covariance: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float


def stepped(vectors: DataFrame, key: str, column: str, step: int, offset: int) -> DataFrame:
    """(key, x array<long>): floor(step * entry) + offset for the usable vectors, stored.

    Vectors are left out if they are null, empty, hold a null or non-finite entry or one whose product
    with `step` is 2**62 or more, or differ in length from most of these (of equally
    frequent lengths, the longest counts).  Repeated rows and null keys stay.
    """
    entry = F.transform(column, lambda c: c.cast("double") * F.lit(float(step)))
    fine = F.forall("_llm_c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < WIDEST))
    usable = vectors.select(F.col(key), entry.alias("_llm_c")).filter((F.size("_llm_c") > 0) & F.coalesce(fine, F.lit(False)))
    x = F.transform("_llm_c", lambda c: F.floor(c) + F.lit(offset).cast("long"))
    rows = stored(usable.select(F.col(key), x.alias("x")))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows"))
    usual = lengths.agg(F.max(F.struct("rows", "d"))["d"].alias("d")).first().d
    return rows.filter(F.size("x") == F.lit(usual))


def _centred(batch: pa.RecordBatch, n: int, totals: list[int]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """n*x - S for parts of a batch: 64-bit numbers, or Python's where these do not suffice."""
    for k in range(0, batch.num_rows, ROWS):
        part = batch.slice(k, ROWS)
        x = part.column(part.schema.get_field_index("x")).flatten().to_numpy().reshape(part.num_rows, -1)
        most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, totals))
        if 2 * most >= 2**62:
            yield part, x.astype(object) * n - np.array(totals, dtype=object)
        else:
            yield part, x * np.int64(n) - np.array(totals, dtype=np.int64)


def _square_sums(values: np.ndarray) -> list[int]:
    """For each column the exact sum of squares, as Python's whole numbers.

    64-bit values, at most 2**62 in size, are cut in two, and each product is again
    cut in two, so that no sum leaves 64 bits.
    """
    if values.dtype == object:
        return (values * values).sum(axis=0).tolist()
    values = np.abs(values)
    low, high = values & (2**31 - 1), values >> 31
    sums = [0] * values.shape[1]
    for shift, product in ((0, low * low), (32, low * high), (62, high * high)) if high.any() else ((0, low * low),):
        upper, lower = (product >> 32).sum(axis=0), (product & (2**32 - 1)).sum(axis=0)
        sums = [s + (((int(a) << 32) + int(b)) << shift) for s, a, b in zip(sums, upper, lower, strict=True)]
    return sums


def _pair_squares(rows: DataFrame, n: int, totals: list[int]) -> dict[tuple[int, int], int]:
    """Sums over all rows of (z_i + z_j)**2 for i < j, and of z_i**2 under (i, i), where z = n*x - S."""
    d = len(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for _, z in _centred(batch, n, totals):
                for i in range(d):
                    found = _square_sums(np.concatenate([z[:, i : i + 1], z[:, i : i + 1] + z[:, i + 1 :]], axis=1))
                    sums[i] = [a + b for a, b in zip(sums[i], found, strict=True)] if i in sums else found
        for i, found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), i, dtype=np.int32)),
                    pa.array(np.arange(i, d, dtype=np.int32)),
                    pa.array([str(v // PART) for v in found]),
                    pa.array([v % PART for v in found], pa.int64()),
                ],
                ["i", "j", "high", "low"],
            )

    parts = rows.select("x").mapInArrow(run, "i int, j int, high string, low long")
    whole = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38, 0)")).alias("high"), F.sum(F.col("low").cast("decimal(38, 0)")).alias("low"))
    return {(r.i, r.j): int(r.high) * PART + int(r.low) for r in whole.collect()}


def fit(rows: DataFrame, most: int = 32) -> Whitener | None:
    """The whitener of a table with the column x (see `stepped`); without rows there is none."""
    sums = (
        rows.select(F.posexplode("x").alias("i", "v"))
        .groupBy("i")
        .agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38, 0)")).alias("total"))
        .collect()
    )
    if not sums:
        return None
    n, d = sums[0].n, len(sums)
    totals = [int(r.total) for r in sorted(sums, key=lambda r: r.i)]
    squares = _pair_squares(rows, n, totals)
    covariance = np.empty((d, d))
    for (i, j), found in squares.items():
        # whole numbers up to the division, which Python rounds correctly
        twice = 2 * found if i == j else found - squares[i, i] - squares[j, j]
        covariance[i, j] = covariance[j, i] = twice / (2 * n**3)
    trace = sum(squares[i, i] for i in range(d)) / n**3
    values, components = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values[-1], 0.0) * d * 1e-14]
    return Whitener(n, totals, covariance, components[:, order], values[order], trace)


def project(rows: DataFrame, whitener: Whitener) -> DataFrame:
    """The columns of `rows` but x, with deviation and whitened (array<double>, one value per component).

    deviation is the sum over dimensions of (n*x - S)**2; it is null where that is no long.
    """
    kept = [f for f in rows.schema if f.name != "x"]
    names = [*[f.name for f in kept], "deviation", "whitened"]
    n, totals, scaled = whitener.n, whitener.totals, whitener.components / np.sqrt(whitener.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, z in _centred(batch, n, totals):
                white = (z / n).astype(float) @ scaled
                # the columns of the transposed values are the rows
                deviation = [v if v < 2**63 else None for v in _square_sums(np.ascontiguousarray(z.T))]
                ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(part.schema.get_field_index(f.name)) for f in kept],
                        pa.array(deviation, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    ],
                    names,
                )

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return rows.mapInArrow(run, ", ".join([*types, "deviation long, whitened array<double>"]))


def identity_error(whitened: DataFrame) -> float:
    """How far the covariance of the column whitened is from the identity, at most; 0 without components.

    Means come first, products of centred values second; tasks send one matrix each.
    """
    means = whitened.select(F.posexplode("whitened").alias("i", "w")).groupBy("i").agg(F.avg("w").alias("mean"), F.count("*").alias("n"))
    found = sorted(means.collect(), key=lambda r: r.i)
    if not found:
        return 0.0
    mean, n = np.array([r["mean"] for r in found]), found[0].n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) - mean
            total += w.T @ w
        i, j = np.indices(total.shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "v"])

    entry = F.abs(F.sum("v") / F.lit(n) - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    entries = whitened.select("whitened").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(entry.alias("off"))
    return entries.agg(F.max("off").alias("off")).first().off


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", step: int = 64, offset: int = 1_000_000, most: int = 32) -> DataFrame:
    """One row per usable vector and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors without use (see `stepped`) have no rows, nor do components without variance:
    equal vectors, or a single one, give no rows at all.  Fewer dimensions than `most` give as
    many components.  Repeated rows count and come out each; a null key stays null; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = stepped(vectors, key, column, step, offset)
    whitener = fit(rows, most)
    if whitener is None or not len(whitener.values):
        whitener = None
        white = rows.select(F.col(key), F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0)
    else:
        white = stored(project(rows, whitener))
    error = identity_error(white) if whitener else 0.0
    shares = (whitener.values / whitener.trace).tolist() if whitener else [0.0]
    return white.select(F.col(key), "deviation", F.posexplode("whitened").alias("_llm_k", "whitened")).select(
        F.col(key),
        (F.col("_llm_k") + 1).cast("int").alias("component"),
        F.lit(whitener.n if whitener else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("_llm_k")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
