"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

The cosine features approximate a Gaussian kernel over the standardised
statistics of a text.  Each task adds up its part of the normal equations; the
driver solves a system of FEATURES unknowns.  Ridge scores are then calibrated
to probabilities by a rising step function fitted to counts in fixed bins.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import stored

#: Random features; the normal equations hold about half their square in numbers.
FEATURES = 192
#: Bins in which scores between LOW and HIGH are counted for the calibration.
BINS, LOW, HIGH = 2_000, -0.5, 1.5

_WORD = re.compile(r"[^ \t-\r]+")
_CLASSES = {
    "digits": b"0123456789",
    "stops": b".!?",
    "pauses": b",;:",
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    "quotes": b"\"'()-",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": b"abcdefghijklmnopqrstuvwxyz",
}
_TABLE = bytes(next((k for k, v in enumerate(_CLASSES.values(), 1) if b in v), 8 if b > 127 else 0) for b in range(256))
STATISTICS = 18


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; null is like empty."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(np.frombuffer(raw.translate(_TABLE), dtype=np.uint8), minlength=9)[1:9]
    lines = [x for x in text.split("\n") if x]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lowered = [w.lower() for w in words]
    odd = sum(1 for w in words if not (w[-1].isalnum() or w[-1] in ".,;:!?\"')"))
    some = max(n, 1)
    return [
        float(np.log1p(n)),
        len(set(lowered)) / some,
        sum(map(eq, lowered, lowered[1:])) / some,
        sum(map(eq, lowered, lowered[2:])) / some,
        float(lengths.mean()) if n else 0.0,
        float(lengths.std()) if n else 0.0,
        float(np.sqrt(odd / some)),
        sum(1 for w in words if not any(map(str.isalnum, w))) / some,
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(len(lines))),
        *(np.sqrt(kinds / max(len(raw), 1))).tolist(),
    ]


def described(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, statistics array<double>) of every row; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], [key, "statistics"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, statistics array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        angles = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.waves + self.shifts
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(angles), np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.full(len(rows), 0.5)
        return np.interp(self.raw(rows), self.edges, self.levels)


def rising(totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to totals / counts by weighted squares (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for total, count in zip(totals.tolist(), counts.tolist(), strict=True):
        blocks.append([total, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, count, length = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + count, blocks[-1][2] + length]
    return np.repeat([t / c for t, c, _ in blocks], [int(k) for _, _, k in blocks])


def _matrix(batch: pa.RecordBatch, name: str = "statistics") -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy()
    return values.reshape(batch.num_rows, -1)


def fit(labelled: DataFrame, ridge: float = 1e-3, width: float = 3.0, seed: int = 7) -> Model:
    """Learn from (statistics, label), label between 0 and 1, over all rows.

    `width` is the kernel's width in standard deviations; `ridge` is counted per row.
    Both classes weigh the same.  Without rows every score is 0.5.
    """
    labelled = stored(labelled.select("statistics", F.col("label").cast("double").alias("label")).dropna())
    columns = [F.get("statistics", F.lit(k)) for k in range(STATISTICS)]
    moments = labelled.agg(
        F.count("*"), F.avg("label"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]
    ).first()
    none = np.zeros(STATISTICS)
    random = np.random.default_rng(seed)
    waves = random.normal(size=(STATISTICS, FEATURES)) / width
    shifts = random.uniform(0, 2 * np.pi, FEATURES)
    if not moments[0]:
        return Model(none, none + 1, waves, shifts, np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    mean, scale = np.array(moments[2 : 2 + STATISTICS]), np.array(moments[2 + STATISTICS :])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), waves, shifts, np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    share = min(max(moments[1], 1e-6), 1 - 1e-6)
    upper = np.triu_indices(FEATURES + 2)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 2, FEATURES + 2))
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            rows = np.hstack([model.features(_matrix(batch)), label[:, None]])
            weight = label / share / 2 + (1 - label) / (1 - share) / 2
            total += rows.T @ (rows * weight[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], ["cell", "value"])

    cells = labelled.mapInArrow(equations, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = cells.toPandas().sort_values("cell")["value"].to_numpy()
    full = np.zeros((FEATURES + 2, FEATURES + 2))
    full[upper] = found
    full = full + np.triu(full, 1).T
    penalty = ridge * moments[0] * np.append(np.ones(FEATURES), 0)
    model.weights = np.linalg.solve(full[:-1, :-1] + np.diag(penalty + 1e-9), full[:-1, -1])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, positive, score = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            raw = model.raw(_matrix(batch))
            at = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            for total, weight in ((n, None), (positive, label), (score, raw)):
                total += np.bincount(at, weight, BINS)
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (full, n[full], positive[full], score[full])], ["bin", "n", "positive", "raw"])

    bins = labelled.mapInArrow(counted, "bin long, n double, positive double, raw double").groupBy("bin")
    table = bins.agg(*[F.sum(c).alias(c) for c in ("n", "positive", "raw")]).toPandas().sort_values("bin")
    n = table["n"].to_numpy()
    model.edges, model.levels = table["raw"].to_numpy() / n, rising(table["positive"].to_numpy(), n)
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with `statistics` replaced by `score`, 0 … 1; a column of that name is replaced."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c not in ("statistics", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(_matrix(batch)) if batch.num_rows else np.empty(0)
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(score)], [*kept, "score"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept]
    return rows.mapInArrow(run, ", ".join([*types, "score double"]))


def score_documents(docs: DataFrame, labels: DataFrame, learn, **options) -> DataFrame:
    """(doc_id, score) of every row of `docs`, by a model of the labelled rows for which `learn` (a condition on doc_id) holds.

    `labels` has (doc_id, quality); several labels of one document are averaged,
    null labels and labels without document ignored.  Null texts count as empty
    and are scored like all others; repeated rows are scored each.  No documents,
    no rows; no labels, 0.5 for all.  Nothing but the text enters a score.
    """
    numbers = stored(described(docs))
    given = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    model = fit(numbers.filter(learn).join(given, "doc_id"), **options)
    return scored(numbers, model)
