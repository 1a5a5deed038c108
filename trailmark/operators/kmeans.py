"""k-means over edge series that does not depend on how rows are laid out.

One fit covers any number of spans, the first so many months each; all spans share every pass over the rows.
Features are put on a grid, so that sums over rows are whole numbers and exact in any order; draws
are hashes of names; distances are formed in blocks of one shape.  So any partitioning
gives the same centres.  The driver holds centres and sums, never rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions import series as S
from trailmark.functions.lineage import cut_lineage
from trailmark.functions.seeded import uniform
from trailmark.schema import EDGE

#: Rows of a block in which distances are formed; the last block is filled up.
ROWS = 256
#: Steps of the grid for raw and for standardised features.
RAW_STEP, STEP = 2.0**24, 2.0**24
#: Standardised features are held below this on the grid.
WIDEST = 2.0**45
KINDS = ("link", "external", "other")


def as_of_rows(series: DataFrame, keys: list[str] = EDGE) -> DataFrame:
    """(keys, counts, medians, means, seen): monthly counts (0 where absent), and after each month the median and mean of the present months; stored.

    ``seen`` is the position of the first present month, from 0; series without one are left out.
    """
    kind = series.schema["series"].dataType.elementType.simpleString()
    # the statistics before a month that follows all others are those after the last one: an extra month closes the series
    found = S.rolling_stats(F.concat("series", F.array(F.lit(0).cast(kind))), "prior", kind=kind)
    rows = series.select(*keys, "series", found.alias("_points"))
    after = F.expr("transform(slice(_points, 2, greatest(size(_points) - 1, 0)), p -> p.stats)")
    rows = rows.withColumn("_after", after).withColumn("_at", F.expr("transform(slice(_points, 1, greatest(size(_points) - 1, 0)), p -> p.pos)"))
    counts = F.transform("series", lambda n: F.coalesce(n, F.lit(0)).cast("double"))
    return cut_lineage(
        rows.filter(F.size("_at") > 0).select(
            *keys,
            counts.alias("counts"),
            F.col("_at").alias("at"),
            F.expr("transform(_after, s -> s.median)").alias("medians"),
            F.expr("transform(_after, s -> s.mean)").alias("means"),
        )
    )


def _filled(at: np.ndarray, values: np.ndarray, ends: np.ndarray, months: int) -> np.ndarray:
    """Values known from some months on, as one row of `months` each: nan before the first."""
    rows = len(ends) - 1
    out = np.full((rows, months), np.nan)
    out[np.repeat(np.arange(rows), np.diff(ends)), at] = values
    place = np.where(np.isnan(out), 0, np.arange(months))
    return np.take_along_axis(out, np.maximum.accumulate(place, axis=1), axis=1)


class Batch:
    """The rows of an Arrow batch as matrices, and their features for any span."""

    def __init__(self, batch: pa.RecordBatch, columns: int):
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        self.counts = column("counts").flatten().to_numpy().reshape(batch.num_rows, columns)
        at = column("at")
        ends = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy())])
        self.medians, self.means = (_filled(at.flatten().to_numpy(), column(x).flatten().to_numpy(), ends, columns) for x in ("medians", "means"))
        kinds = column("type").to_pylist()
        self.kinds = np.array([[float(k == t) for t in KINDS] for k in kinds]).reshape(batch.num_rows, len(KINDS))

    def features(self, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows with a present month in the span, and (count, ratio) per month, median, mean and kinds of these."""
        rows = np.flatnonzero(~np.isnan(self.medians[:, span - 1]))
        counts, median = self.counts[rows, :span], self.medians[rows, span - 1 : span]
        ratio = np.divide(counts, median, out=np.zeros_like(counts), where=median > 0)
        monthly = np.stack([counts, ratio], axis=2).reshape(len(rows), 2 * span)
        return rows, np.concatenate([monthly, median, self.means[rows, span - 1 : span], self.kinds[rows]], axis=1)


@dataclass
class Fit:
    """Of one span: mean and deviation of the raw features, and the centres on the grid of standardised ones."""

    span: int
    mean: np.ndarray
    deviation: np.ndarray
    centres: np.ndarray
    settled: bool = False

    def scaled(self, raw: np.ndarray) -> np.ndarray:
        """Standardised features in whole steps of the grid."""
        return np.clip(np.rint((raw - self.mean) / self.deviation * STEP), -WIDEST, WIDEST)

    def nearest(self, scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centre of each row and the squared distance, in steps of 1."""
        points, centres = scaled / STEP, self.centres / STEP
        label, away = np.empty(len(points), dtype=np.int64), np.empty(len(points))
        norms = np.square(centres).sum(axis=1)
        for k in range(0, len(points), ROWS):
            part = points[k : k + ROWS]
            full = np.zeros((ROWS, points.shape[1]))
            full[: len(part)] = part
            found = (norms - 2 * (full @ centres.T))[: len(part)].argmin(axis=1)
            label[k : k + ROWS] = found
            away[k : k + ROWS] = np.square(part - centres[found]).sum(axis=1)
        return label, away


def _sums(rows: DataFrame, columns: int, parts) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Exact sums by (span, key): how many rows, and one whole number per place.

    `parts(batch)` gives (span, key, number of rows, values); values are whole numbers below 2**62 in an array.
    The driver gets spans * keys * places numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for k in range(0, batch.num_rows, 64 * ROWS):
                for span, key, n, values in parts(Batch(batch.slice(k, 64 * ROWS), columns)):
                    before = held.get((span, key))
                    held[span, key] = (n, values.astype(object)) if before is None else (before[0] + n, before[1] + values)
        found = [(span, key, place, v) for (span, key), (n, values) in held.items() for place, v in enumerate([n, *values.tolist()])]
        names = ["span", "key", "place", "v"]
        kinds = [pa.int32(), pa.int64(), pa.int32()]
        arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([str(int(row[3])) for row in found])], names)

    cells = rows.mapInArrow(run, "span int, key long, place int, v string")
    whole = cells.groupBy("span", "key", "place").agg(F.sum(F.col("v").cast("decimal(38, 0)")).alias("v")).toArrow().to_pylist()
    out: dict = {}
    for row in sorted(whole, key=lambda r: r["place"]):
        out.setdefault((row["span"], row["key"]), []).append(int(row["v"]))
    return {key: (values[0], values[1:]) for key, values in out.items()}


def _whole(steps: np.ndarray, most: float) -> np.ndarray:
    """The nearest whole numbers: 64-bit below `most`, else Python's, so that sums over a batch stay exact."""
    steps = np.rint(steps)
    if not steps.size or np.abs(steps).max() < most:
        return steps.astype(np.int64)
    return np.array([int(v) for v in steps.ravel()], dtype=object).reshape(steps.shape)


def _standard(rows: DataFrame, columns: int, spans: list[int]) -> list[Fit]:
    """Mean and sample deviation of each feature, 1 where it does not vary; spans without rows are left out."""

    def first(batch: Batch):
        for span in spans:
            at, raw = batch.features(span)
            if len(at):
                yield span, 0, len(at), _whole(raw * RAW_STEP, 2.0**48).sum(axis=0)

    sums = _sums(rows, columns, first)
    means = {span: np.array([v / n for v in values]) / RAW_STEP for (span, _), (n, values) in sums.items()}
    sizes = {span: n for (span, _), (n, _) in sums.items()}

    def second(batch: Batch):
        for span, mean in means.items():
            at, raw = batch.features(span)
            if len(at):
                yield span, 0, len(at), np.square(_whole((raw - mean) * RAW_STEP, 2.0**24)).sum(axis=0)

    fits = []
    for (span, _), (n, squares) in sorted(_sums(rows, columns, second).items()):
        deviation = np.array([(v / max(n - 1, 1)) ** 0.5 for v in squares]) / RAW_STEP
        fits.append(Fit(span, means[span], np.where(deviation > 0, deviation, 1.0), np.empty((0, len(squares)))))
    return fits


def _drawn(rows: DataFrame, columns: int, fit: Fit, number: int, share: float | None) -> np.ndarray:
    """Scaled features of the rows drawn in a round: chances are `share` times the squared distance, without it all rows whose draw is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = Batch(batch, columns).features(fit.span)
            draws = batch.column(batch.schema.get_field_index("draws")).flatten().to_numpy().reshape(batch.num_rows, -1)[at, number]
            scaled = fit.scaled(raw)
            hit = draws <= 0 if share is None else draws < share * fit.nearest(scaled)[1]
            yield pa.RecordBatch.from_arrays([pa.array(list(scaled[hit]), pa.list_(pa.float64()))], ["x"])

    found = [r.x for r in rows.mapInArrow(run, "x array<double>").collect()]
    return np.array(sorted(found)).reshape(len(found), -1)


def _chosen(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of a few hundred weighted candidates, each far from those before it, by chance."""
    rng = np.random.default_rng(seed)
    points = candidates / STEP
    away, chosen = weights.astype(float), []
    while len(chosen) < k and away.sum() > 0:
        at = int(rng.choice(len(points), p=away / away.sum()))
        chosen.append(at)
        near = np.square(points - points[at]).sum(axis=1) * weights
        away = near if len(chosen) == 1 else np.minimum(away, near)
    return candidates[chosen]


def _begin(rows: DataFrame, columns: int, fit: Fit, k: int, seed: int, rounds: int) -> None:
    """Centres by k-means||: in each round about 2 k rows far from the centres so far are drawn; then k of them are chosen."""
    fit.centres = _drawn(rows, columns, fit, 0, None)[:1]
    if not len(fit.centres):
        return
    for number in range(1, rounds + 1):

        def cost(batch: Batch):
            at, raw = batch.features(fit.span)
            if len(at):
                away = fit.nearest(fit.scaled(raw))[1]
                yield fit.span, 0, len(at), np.array([np.rint(np.minimum(away, 2.0**30) * 2**16).astype(np.int64).sum()])

        total = _sums(rows, columns, cost)[fit.span, 0][1][0] / 2**16
        if total <= 0:
            break
        more = _drawn(rows, columns, fit, number, 2 * k / total)
        fit.centres = np.unique(np.concatenate([fit.centres, more.reshape(-1, fit.centres.shape[1])]), axis=0)

    def members(batch: Batch):
        at, raw = batch.features(fit.span)
        if len(at):
            yield fit.span, 0, len(at), np.bincount(fit.nearest(fit.scaled(raw))[0], minlength=len(fit.centres))

    fit.centres = _chosen(fit.centres, np.array(_sums(rows, columns, members)[fit.span, 0][1]), k, seed)


def _settle(rows: DataFrame, columns: int, fits: list[Fit], rounds: int, tolerance: float, guide: Fit | None = None) -> None:
    """Rounds of Lloyd's for all fits at once; one that no longer moves leaves.

    With a guide, the first round takes its clusters instead of the nearest centres.
    """
    for number in range(rounds):
        running = [f for f in fits if not f.settled]
        if not running:
            return
        lead = guide if number == 0 else None

        def grouped(batch: Batch):
            if lead is not None:
                led, raw = batch.features(lead.span)
                clusters = np.full(len(batch.counts), -1)
                clusters[led] = lead.nearest(lead.scaled(raw))[0]
            for f in running:
                at, raw = batch.features(f.span)
                scaled = f.scaled(raw)
                label = clusters[at] if lead is not None else f.nearest(scaled)[0]
                for c in np.unique(label):
                    mine = label == c
                    yield f.span, int(c), int(mine.sum()), scaled[mine].astype(np.int64).sum(axis=0)

        sums = _sums(rows, columns, grouped)
        for f in running:
            held = {c: v for (span, c), v in sums.items() if span == f.span}
            if lead is not None:
                f.centres = np.array([[v / n for v in values] for _, (n, values) in sorted(held.items())])
                continue
            # a centre without rows stays where it is
            moved = np.array([[v / held[c][0] for v in held[c][1]] if c in held else f.centres[c] for c in range(len(f.centres))])
            f.settled = bool((np.sqrt(np.square((moved - f.centres) / STEP).sum(axis=1)) <= tolerance).all())
            f.centres = moved


def fit_spans(rows: DataFrame, columns: int, spans: list[int], k: int = 50, rounds: int = 100, seed: int = 42, tolerance: float = 1e-4) -> list[Fit]:
    """A fit of each span over ``rows`` (see ``as_of_rows``) with a column ``draws``.

    The longest span starts by k-means||; the others start from its clusters, each with its own features
    and deviations, and move on together.  The number of jobs depends on the rounds only.
    """
    fits = _standard(rows, columns, sorted(set(spans)))
    if not fits:
        return []
    longest = fits[-1]
    _begin(rows, columns, longest, k, seed, 2)
    _settle(rows, columns, [longest], rounds, tolerance)
    if fits[:-1]:
        _settle(rows, columns, fits[:-1], rounds, tolerance, longest)
    return fits


def with_draws(rows: DataFrame, seed: int, keys: list[str] = EDGE, rounds: int = 2) -> DataFrame:
    """Add ``draws``: a number in (0, 1) for each round; the first is 0 for the row with the smallest one, else 1; stored."""
    u = lambda number: uniform(F.lit(f"{seed}-{number}"), *keys)
    drawn = rows.withColumn("_first", u(0))
    least = drawn.agg(F.min("_first").alias("v")).first().v
    first = F.when(F.col("_first") == F.lit(least), 0.0).otherwise(1.0)
    return cut_lineage(drawn.withColumn("draws", F.array(first, *[u(k) for k in range(1, rounds + 1)])).drop("_first"))


def distances(rows: DataFrame, columns: int, fits: list[Fit], with_features: bool = False) -> DataFrame:
    """(prev, curr, type, span, baseline_median, prediction, distance_to_center) of every row in every fit."""
    names = [*EDGE, "span", "baseline_median", "prediction", "distance_to_center", *(["features"] if with_features else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64 * ROWS):
                batch = whole.slice(k, 64 * ROWS)
                held = Batch(batch, columns)
                for f in fits:
                    at, raw = held.features(f.span)
                    scaled = f.scaled(raw)
                    label, away = f.nearest(scaled)
                    part = [batch.column(batch.schema.get_field_index(c)).take(pa.array(at)) for c in EDGE]
                    part += [pa.array(np.full(len(at), f.span, dtype=np.int32)), pa.array(held.medians[at, f.span - 1])]
                    part += [pa.array(label.astype(np.int32)), pa.array(np.sqrt(away))]
                    if with_features:
                        part.append(pa.array(list(scaled / STEP), pa.list_(pa.float64())))
                    yield pa.RecordBatch.from_arrays(part, names)

    schema = "prev string, curr string, type string, span int, baseline_median double, prediction int, distance_to_center double"
    return rows.mapInArrow(run, schema + (", features array<double>" if with_features else ""))
