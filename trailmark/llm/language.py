"""Language identification by nearest centroids of TF-IDF n-gram vectors.

The n-grams are runs of 1 to 3 bytes of the lower-cased text, everything that is
no letter being one blank; they are counted in DIMENSIONS hashed cells over the
whole text.  Each language has several centroids, found by spherical k-means.
A text gets the language of the centroid with the largest cosine; it is
rejected if it lies farther from that centroid than all but a few texts of the language from theirs, by some slack.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import stored

#: Cells of the hashed n-gram vectors.
DIMENSIONS = 1 << 13
#: Texts turned into vectors at a time.
ROWS = 128
#: Different texts of a language in the sample of the centroids, if it has so many.
LEAST = 64

# ASCII letters stay, the bytes of other characters too, the rest becomes blank
_BLANKED = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter of Unicode; signs made of letters or digits, as ² ½ Ⅷ ①, are none."""
    return any(map(str.isalpha, text or ""))


def counts_of(text: str) -> np.ndarray:
    """How often each cell's n-grams stand in a text."""
    raw = b" ".join([b"", *text.lower().encode("utf-8", "replace").translate(_BLANKED).split(), b""])
    codes = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    total = np.zeros(DIMENSIONS, dtype=np.float32)
    grams = np.zeros(len(codes), dtype=np.uint32)
    for width in (1, 2, 3):
        if len(codes) < width:
            break
        grams = grams[: len(codes) - width + 1] * np.uint32(257) + codes[width - 1 :] + np.uint32(width)
        mixed = grams * np.uint32(2654435761)
        total += np.bincount(mixed >> np.uint32(32 - DIMENSIONS.bit_length() + 1), minlength=DIMENSIONS)
    return total


def vectors_of(texts: list[str], idf: np.ndarray | None = None) -> np.ndarray:
    """One row per text: counts, or with `idf` normalised TF-IDF values."""
    rows = np.empty((len(texts), DIMENSIONS), dtype=np.float32)
    for row, text in zip(rows, texts, strict=True):
        row[:] = counts_of(text)
    if idf is None:
        return rows
    np.log1p(rows, out=rows)
    rows *= idf
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return rows


@dataclass
class Model:
    """languages[i] is the language of centroids[i]; reach[i] the least cosine accepted there."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    reach: np.ndarray


def _texts(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list, ...]]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            yield tuple(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)


def _sums(docs: DataFrame, cells) -> dict[tuple[int, int], float]:
    """Add up what `cells` gives for each task: arrays by key, in cells of (key, cell).

    Tasks hold one array per key, the cluster adds up cells, and the driver gets
    keys times DIMENSIONS numbers, whatever the number of documents.
    """

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for key, values in cells(batches):
            if key in totals:
                totals[key] += values
            else:
                totals[key] = values.astype(np.float64)
        for key, values in totals.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), key, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(values[at])],
                ["key", "cell", "value"],
            )

    found = docs.mapInArrow(run, "key int, cell int, value double").groupBy("key", "cell").agg(F.sum("value").alias("value"))
    table = found.toPandas()
    return {k: g for k, g in ((key, _dense(part)) for key, part in table.groupby("key"))}


def _dense(part) -> np.ndarray:
    row = np.zeros(DIMENSIONS + 1)
    row[part["cell"].to_numpy()] = part["value"].to_numpy()
    return row


def _different_texts(known: DataFrame) -> dict[str, int]:
    """The number of different texts with letters of each language, over all rows; one number per language is collected."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.select(["lang", "hash"]).filter(pa.array([has_letter(t) for t in texts], pa.bool_()))

    hashes = known.withColumn("hash", F.xxhash64("text")).mapInArrow(run, "lang string, hash long").distinct()
    return {r["lang"]: r["n"] for r in hashes.groupBy("lang").agg(F.count("*").alias("n")).collect()}


def _level(counts, total: int) -> float:
    """The size to which the largest counts must be cut for the sum to be `total`."""
    left, waiting = float(total), sorted(counts)
    for k, n in enumerate(waiting):
        if n * (len(waiting) - k) >= left:
            return left / (len(waiting) - k)
        left -= n
    return float(total)


def fit(
    docs: DataFrame,
    clusters: int = 4,
    rounds: int = 4,
    sample_rows: int = 20_000,
    slack: float = 0.25,
    outside: float = 0.02,
    smallest: float = 0.05,
) -> Model | None:
    """Learn from the columns text and lang; rows without language or letters are left out.

    Document frequencies and the reach of the languages are taken over all rows.
    The centroids are fitted on about `sample_rows` different texts, those with a
    small hash; this is the only sample.  Every language has its own share of it: the
    largest ones are cut to one size, at least LEAST texts, those below it are taken whole.
    Without any row there is no model.

    Odd and mislabelled texts must neither draw centroids to themselves nor set the limit.  So the share `outside` of a
    language's texts, those farthest from all its centroids, does not move centroids after the first
    round and is passed over when the language's reach is measured; a centroid that in the
    end holds less than the share `smallest` of its language's texts is dropped.  The reach is the cosine
    to the nearest centroid that the rest of the language's texts have at least, and `slack`
    is the share of it that is still accepted.
    """
    spark = docs.sparkSession
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    texts_of = _different_texts(known)
    languages = sorted(texts_of)
    place = {lang: k for k, lang in enumerate(languages)}

    def frequencies(batches):
        for (texts,) in _texts(batches, ["text"]):
            texts = [t for t in texts if has_letter(t)]
            if texts:
                yield 0, np.append((vectors_of(texts) > 0).sum(axis=0), len(texts))

    seen = _sums(known.select("text"), frequencies).get(0)
    if seen is None:
        return None
    idf = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.05).astype(np.float32)
    most = max(_level(texts_of.values(), sample_rows), LEAST)
    shares = spark.createDataFrame(
        [(lang, int(min(1.0, most / n) * 2**40)) for lang, n in texts_of.items()], "lang string, _below long"
    )
    of_its_language = known.join(F.broadcast(shares), "lang")
    hashed = F.pmod(F.xxhash64("text"), F.lit(2**40))
    sample = stored(of_its_language.filter(hashed < F.col("_below")).select("text", "lang").dropDuplicates())

    # farthest texts would be odd ones: start from sums over random parts of each language
    def begin(batches):
        for texts, langs in _texts(batches, ["text", "lang"]):
            keep = [(t, place[x]) for t, x in zip(texts, langs, strict=True) if has_letter(t)]
            if keep:
                rows = vectors_of([t for t, _ in keep], idf)
                for (t, k), row in zip(keep, rows, strict=True):
                    yield k * clusters + sum(t.encode("utf-8", "replace")) % clusters, np.append(row, 1)

    sums = _sums(sample, begin)
    centroids, owners, _ = _centres(sums, [key // clusters for key in range(clusters * len(languages))])
    limits = np.full(len(languages), -1.0)
    for _ in range(rounds):
        sums = _sums(sample, _assign(place, idf, centroids, owners, limits))
        limits = _limits(sums, len(languages), outside)
        centroids, owners, held = _centres(sums, owners)
    of = np.bincount(owners, weights=held, minlength=len(languages))
    used = np.flatnonzero(held >= smallest * of[owners])
    centroids, owners = centroids[used], owners[used]
    reach = _limits(_sums(known, _assign(place, idf, centroids, owners)), len(languages), outside)
    return Model([languages[k] for k in owners], idf, centroids, (slack * reach[owners]).astype(np.float32))


def _centres(sums, owners) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of the sums under keys 0, 1, …, their languages and numbers of texts; one that lost all its texts is dropped."""
    keys = [key for key in sorted(sums) if key >= 0 and np.linalg.norm(sums[key][:-1]) > 0]
    rows = np.array([sums[key][:-1] / np.linalg.norm(sums[key][:-1]) for key in keys], dtype=np.float32)
    return rows, np.array([owners[key] for key in keys]), np.array([sums[key][-1] for key in keys])


def _assign(place, idf, centroids, owners, limits=None):
    """For each centroid the sum and number of its texts; for each language, under -1, -2, …, its texts' cosines in bins.

    A text goes to the nearest centroid of its language.  Below the language's limit it is not summed up;
    without limits nothing is.  Cosines are counted in DIMENSIONS bins.
    """
    own = np.array(owners)

    def run(batches):
        for texts, langs in _texts(batches, ["text", "lang"]):
            keep = [(t, place[x]) for t, x in zip(texts, langs, strict=True) if has_letter(t)]
            if not keep:
                continue
            rows, of = vectors_of([t for t, _ in keep], idf), np.array([k for _, k in keep])
            cosine = rows @ centroids.T
            cosine[of[:, None] != own[None, :]] = -2
            best, value = cosine.argmax(axis=1), cosine.max(axis=1)
            bins = np.clip((value * DIMENSIONS).astype(int), 0, DIMENSIONS - 1)
            for k in np.unique(of):
                yield -1 - int(k), np.bincount(bins[of == k], minlength=DIMENSIONS + 1)
            if limits is not None:
                near = value >= limits[of]
                for k in np.unique(best[near]):
                    mine = near & (best == k)
                    yield int(k), np.append(rows[mine].sum(axis=0), mine.sum())

    return run


def _limits(sums, languages: int, outside: float) -> np.ndarray:
    """For each language the cosine below which the share `outside` of its texts lies, at least one text if it has several."""
    limits = np.full(languages, -1.0)
    for k in range(languages):
        if -1 - k in sums:
            upto = np.cumsum(sums[-1 - k][:DIMENSIONS])
            passed = min(np.ceil(outside * upto[-1]), upto[-1] - 1)
            limits[k] = np.searchsorted(upto, passed, side="right") / DIMENSIONS
    return limits


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of `docs` with lang_pred, score and rejected (columns of these names are replaced).

    `score` is the cosine to the nearest centroid, 0 … 1.  Null, empty or
    letterless texts get `und`, score 0, and are rejected, as is everything if
    there is no model.  Of equally near centroids the first in order of language
    counts.  Texts are read whole; rows that repeat are judged each.
    """
    names = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
                full = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                if full:
                    cosine = vectors_of([texts[i] for i in full], model.idf) @ model.centroids.T
                    best = cosine.argmax(axis=1)
                    for i, j, value in zip(full, best.tolist(), cosine.max(axis=1).tolist(), strict=True):
                        lang[i], score[i] = model.languages[j], min(1.0, max(0.0, value))
                        rejected[i] = value < model.reach[j]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in kept], pa.array(lang), pa.array(score), pa.array(rejected)],
                    [*kept, *names],
                )

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    return docs.select(*kept).mapInArrow(run, ", ".join([*types, "lang_pred string, score double, rejected boolean"]))


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs` that `identify` does not reject, with all columns as they were."""
    names = ["lang_pred", "score", "rejected"]
    own = {c: f"_llm_{k}" for k, c in enumerate(docs.columns) if c in names}
    judged = identify(docs.withColumnsRenamed(own), model).filter("NOT rejected").drop(*names)
    return judged.withColumnsRenamed({new: old for old, new in own.items()}).select(*docs.columns)
