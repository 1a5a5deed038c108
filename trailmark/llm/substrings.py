"""Removal of long passages that stand in an earlier document, by compacted De Bruijn paths.

Every window of `width` words is an edge between its first and its last width - 1 words.
Consecutive edges that have the same anchor, the smallest hash among the short grams
inside a window, form a path.  Equal windows have equal anchors, so a
repeated passage yields equal paths, and only paths, not edges, are shuffled and joined: a
path that stands in an earlier document is covered as a whole.  Where an anchor lies on several
different paths the graph branches, and there edges are compared one by one.  The
coordinates of the paths lead back to the words.

Windows are compared by 128 bits: the hash of the anchor and that of the path or window.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.hashing import Words, bitmap, long, no_id_last, perhaps
from trailmark.llm.shared import stored

#: Words of the grams that can be anchors.
GRAM = 5
#: Texts are taken in groups of about so many characters.
CHARACTERS = 3_000_000


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pa.compute.coalesce(pa.compute.utf8_length(batch.column(column)), 0).to_numpy() + 1) // CHARACTERS
    for k in np.unique(sizes):
        a, b = np.searchsorted(sizes, [k, k + 1])
        yield batch.slice(a, b - a)


def _paths(words: Words, width: int):
    """(text, start within it, windows, anchor, path hash, first window) of each path, and the hashes of all windows."""
    first, text = words.windows(width)
    if not len(first):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none, none.view(np.uint64)
    starts, _ = words.windows(GRAM)
    grams = np.zeros(words.total, dtype=np.uint64)
    grams[starts] = words.runs(starts, starts + GRAM)
    least, where = grams[first], first.copy()
    for k in range(1, width - GRAM + 1):
        better = grams[first + k] < least
        least, where = np.where(better, grams[first + k], least), np.where(better, first + k, where)
    begin = np.flatnonzero(np.diff(where, prepend=-1))
    count = np.diff(np.append(begin, len(first)))
    path = words.runs(first[begin], first[begin] + count + width - 1)
    return text[begin], first[begin] - words.starts[text[begin]], count, least[begin], path, begin, words.runs(first, first + width)


def _anchors(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in _groups(batch, 1):
                text, _, _, anchor, *_ = _paths(Words([(t or "").encode() for t in part.column(1).to_pylist()]), width)
                yield pa.RecordBatch.from_arrays([pa.array(long(anchor)), part.column(0).take(pa.array(text))], ["anchor", "doc"])

    return docs.select("doc", "text").mapInArrow(run, "anchor long, doc long")


def _occurrences(docs: DataFrame, width: int, table: np.ndarray) -> DataFrame:
    """The paths whose anchor perhaps stands in several documents, with their coordinates and windows."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            for part in _groups(batch, 2):
                words = Words([(t or "").encode() for t in part.column(2).to_pylist()])
                text, at, count, anchor, path, begin, windows = _paths(words, width)
                keep = np.flatnonzero(perhaps(shared.value, anchor)) if len(anchor) else np.empty(0, dtype=np.int64)
                count = count[keep]
                ends = np.concatenate([[0], np.cumsum(count)])
                flat = np.repeat(begin[keep] - ends[:-1], count) + np.arange(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(long(anchor[keep])),
                        pa.array(long(path[keep])),
                        part.column(0).take(pa.array(text[keep])),
                        part.column(1).take(pa.array(text[keep])),
                        pa.array(at[keep].astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(long(windows[flat]))),
                    ],
                    ["anchor", "path", "doc", "row", "at", "n", "windows"],
                )

    schema = "anchor long, path long, doc long, row long, at int, n int, windows array<long>"
    return docs.select("doc", "row", "text").mapInArrow(run, schema)


def covered(docs: DataFrame, width: int = 13) -> DataFrame:
    """(doc, row, spans): windows of each document that start in a document with a smaller id.

    `docs` has doc, row (which tells apart rows of one id) and text.  A span is (at, n,
    mask): of the n windows from word `at` on, those whose bits are set.
    """
    anchors = _anchors(docs, width).groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    table = bitmap(stored(anchors.filter("a < b").select("anchor")), "anchor")
    found = _occurrences(docs, width, table)
    keys = ["anchor", "path"]
    paths = stored(found.groupBy(*keys).agg(F.min("doc").alias("first"), F.first("windows").alias("windows")))
    branching = paths.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1").select("anchor")
    edges = stored(
        paths.join(branching, "anchor").select(*keys, "first", F.posexplode("windows").alias("place", "window"))
    )
    earliest = edges.groupBy("anchor", "window").agg(F.min("first").alias("least"))
    masks = (
        edges.join(earliest, ["anchor", "window"])
        .filter("least < first")
        .groupBy(*keys)
        .agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("part"))
    )
    judged = stored(paths.select(*keys, "first").join(masks, keys, "left"))
    whole = F.expr("shiftleft(1, n) - 1")
    spans = (
        found.select(*keys, "doc", "row", "at", "n")
        .join(judged, keys)
        .withColumn("mask", F.when(F.col("doc") > F.col("first"), whole).otherwise(F.coalesce("part", F.lit(0))))
        .filter("mask != 0")
        .groupBy("doc", "row")
        .agg(F.collect_list(F.struct("at", "n", "mask")).alias("spans"))
    )
    return stored(spans)


def remove_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if it lies in a window of `width` consecutive words whose sequence
    also starts in a document with a smaller id; windows are judged on the input.  Null and empty
    texts have no words; a null id is larger than all others; rows that repeat an id
    do not count against each other; an empty table gives no rows; other columns are ignored.
    Words are runs of anything but the white space \\x20 and \\x09 to \\x0D.
    """
    if not GRAM <= width <= GRAM + 30:
        raise ValueError(f"width must be from {GRAM} to {GRAM + 30} words")
    rows = docs.select("doc_id", no_id_last(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("row"), "text")
    joined = rows.join(covered(rows, width), ["doc", "row"], "left")

    def run(batches):
        for batch in batches:
            for part in _groups(batch, 1):
                counts, removed, kept = [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for span in spans or ():
                        at = span["at"] + np.flatnonzero([span["mask"] >> k & 1 for k in range(span["n"])])
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + width, -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    left = words if stay.all() else [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                    counts.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string"
    )
