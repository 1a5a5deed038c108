"""Approximate nearest neighbours by a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and sent to all tasks; every vector is
filed under one leaf.  A query keeps the nodes it has seen in a priority queue and
opens the nearest one next; how many leaves it opens is widened until sample queries, compared
with a search of all rows, reach the wanted recall.  Neighbouring leaves share a bin; bins are cut into blocks of bounded
size, met by blocks of queries, so that a leaf or query of any frequency spreads over tasks.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.llm.shared import drawn, small, stored

#: Vectors and queries of one bin that meet in one block, about.
BLOCK = 2_000
#: Bins of neighbouring leaves; a query has at most k rows of results for each block of a bin.
BINS = 32


@dataclass
class Tree:
    """Node 0 is the root; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    rows: dict[int, int] = field(default_factory=dict)

    @property
    def leaves(self) -> list[int]:
        return [k for k, below in enumerate(self.children) if not below]

    @property
    def bins(self) -> dict[int, int]:
        """The bin of each leaf; leaves of one parent have numbers in a row and mostly share it."""
        leaves = self.leaves
        return {leaf: k * min(BINS, len(leaves)) // len(leaves) for k, leaf in enumerate(leaves)}

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, level by level."""
        at = np.zeros(len(vectors), dtype=np.int64)
        open_nodes = [0]
        while open_nodes:
            node = open_nodes.pop()
            below = self.children[node]
            here = np.flatnonzero(at == node)
            if below and len(here):
                at[here] = np.array(below)[_squares(vectors[here], self.centres[below]).argmin(axis=1)]
                open_nodes.extend(below)
        return at

    def visit(self, vector: np.ndarray) -> Iterator[int]:
        """The leaves in the order in which a best-bin-first search opens them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
                continue
            distances = np.square(self.centres[below] - vector).sum(axis=1)
            for distance, child in zip(distances.tolist(), below, strict=True):
                heapq.heappush(queue, (distance, child))

    def opened(self, vector: np.ndarray, visits: int, least_rows: int) -> list[int]:
        """The first `visits` leaves, and more while they hold fewer than `least_rows` vectors."""
        found, held = [], 0
        for leaf in self.visit(vector):
            if len(found) >= visits and held >= least_rows:
                break
            found.append(leaf)
            held += self.rows.get(leaf, 0)
        return found


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.square(a).sum(axis=1)[:, None] - 2 * a @ b.T + np.square(b).sum(axis=1)[None, :]


def grow(sample: np.ndarray, leaf_rows: float, branch: int = 8, rounds: int = 8, seed: int = 5) -> Tree:
    """Split the sample by k-means, and its parts again, down to about `leaf_rows` vectors."""
    random = np.random.default_rng(seed)
    centres, children = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])], [[]]
    waiting = [(0, sample)]
    while waiting:
        node, rows = waiting.pop()
        unique = np.unique(rows, axis=0) if len(rows) > leaf_rows else rows
        if len(rows) <= leaf_rows or len(unique) < 2:
            continue
        k = min(branch, len(unique), max(2, int(np.ceil(len(rows) / leaf_rows))))
        means = unique[random.choice(len(unique), k, replace=False)]
        for _ in range(rounds):
            own = _squares(rows, means).argmin(axis=1)
            means = np.stack([rows[own == j].mean(axis=0) if (own == j).any() else means[j] for j in range(k)])
        own = _squares(rows, means).argmin(axis=1)
        for j in range(k):
            if (own == j).any():
                children[node].append(len(centres))
                waiting.append((len(centres), rows[own == j]))
                centres.append(means[j])
                children.append([])
        if len(children[node]) == 1:  # nothing was split
            children[node] = []
            waiting.pop()
    return Tree(np.array(centres), children)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _nearest(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, vec_ids: np.ndarray, k: int):
    """(query position, vector position, distance) of the k nearest vectors of each query, ties to smaller id.

    Products of matrices choose candidates with a margin for rounding; their distances are then computed exactly.
    """
    out = []
    sizes = np.square(vectors).sum(axis=1)
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        near = np.square(part).sum(axis=1)[:, None] - 2 * part @ vectors.T + sizes[None, :]
        near[ids[start : start + 256, None] == vec_ids[None, :]] = np.inf
        margin = 1e-9 * (sizes.max() + np.square(part).sum(axis=1)) if len(sizes) else np.zeros(len(part))
        for i, row in enumerate(near):
            most = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
            at = np.flatnonzero((row <= most + margin[i]) & np.isfinite(row))
            exact = np.sqrt(np.square(vectors[at] - part[i]).sum(axis=1))
            for j in np.lexsort((vec_ids[at], exact))[:k]:
                out.append((start + i, at[j], exact[j]))
    return out


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(batch.num_rows, -1)


def _exact(vectors: DataFrame, sample: list, k: int) -> pd.DataFrame:
    """All rows searched for a bounded number of queries: (query, vec_id, distance, vector)."""
    ids = np.array([r.vec_id for r in sample])
    points = np.array([r.vector for r in sample])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                block, vec_ids = _rows(batch, "vector"), batch.column(0).to_numpy()
                found = _nearest(points, ids, block, vec_ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(ids[i]) for i, _, _ in found], pa.int64()), pa.array([int(vec_ids[j]) for _, j, _ in found], pa.int64()),
                     pa.array([float(d) for _, _, d in found], pa.float64()), pa.array([block[j].tolist() for _, j, _ in found], pa.list_(pa.float64()))],
                    ["query", "vec_id", "distance", "vector"],
                )

    found = vectors.select("vec_id", "vector").mapInArrow(run, "query long, vec_id long, distance double, vector array<double>")
    best = F.row_number().over(_order("query", "distance"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).toPandas()


def _order(query: str, distance: str):
    return Window.partitionBy(query).orderBy(distance, "vec_id")


def calibrate(tree: Tree, truth: pd.DataFrame, sample: list, recall: float) -> int:
    """The least number of leaf visits at which the sample's true neighbours are found at the wanted rate."""
    places = {r.vec_id: {leaf: n for n, leaf in enumerate(tree.visit(np.array(r.vector)), 1)} for r in sample}
    if truth.empty:
        return len(tree.leaves)
    leaves = tree.file(np.array(truth["vector"].tolist()))
    needed = np.sort([places[q][leaf] for q, leaf in zip(truth["query"], leaves.tolist(), strict=True)])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    recall: float = 0.95,
    leaf_rows: int = 200,
    sample_rows: int = 20_000,
    calibration_queries: int = 200,
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    `vectors` has (vec_id long, embedding array of numbers); `queries` is a
    condition on its rows.  Every usable row is indexed.  Vectors that are null,
    zero, hold a null or non-finite component, have no id, or are not of the commonest
    length take no part.  A query's own id is no candidate.  Equal distances go to the smaller id.  No
    usable rows or queries, no result.  Other columns are ignored.

    Bounds: the tree is fitted on about `sample_rows` rows with a small hash of their id, and
    the visits on about `calibration_queries` queries chosen likewise, whose true neighbours are found among all rows.
    """
    spark = vectors.sparkSession
    clean = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    clean = clean.withColumn("asked", F.coalesce(queries, F.lit(False)))
    clean = clean.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), "asked")
    length = clean.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], schema)
    clean = clean.filter(F.size("vector") == length.n)
    total = length["count"]
    chance = F.xxhash64("vec_id")
    sample = clean.select("vec_id", "vector").filter(drawn(chance, sample_rows / total)).dropDuplicates(["vec_id"])
    points = np.array([r.vector for r in sample.collect()])
    tree = grow(points, max(16.0, leaf_rows * len(points) / total))

    shared = spark.sparkContext.broadcast((tree, tree.bins))

    def file(batches):
        tree, bins = shared.value
        for batch in batches:
            leaf = tree.file(_rows(batch, "vector")).tolist() if batch.num_rows else []
            placed = [pa.array(leaf, pa.int64()), pa.array([bins[x] for x in leaf], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *placed], [*batch.schema.names, "leaf", "bin"])

    index = stored(clean.mapInArrow(file, "vec_id long, vector array<double>, asked boolean, leaf long, bin int"))
    tree.rows = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    asking = index.filter("asked").count()
    if not asking:
        return spark.createDataFrame([], schema)
    probes = index.filter("asked").select("vec_id", "vector").filter(drawn(F.xxhash64("vec_id", F.lit(1)), calibration_queries / asking))
    probes = probes.dropDuplicates(["vec_id"]).collect()
    visits = calibrate(tree, _exact(index, probes, k), probes, recall)
    shared_rows = spark.sparkContext.broadcast((tree, tree.bins))

    def open_leaves(batches):
        tree, bins = shared_rows.value
        for batch in batches:
            rows, ids = (_rows(batch, "vector"), batch.column(0).to_pylist()) if batch.num_rows else ((), ())
            out, where = [], []
            for k, (row, vec_id) in enumerate(zip(rows, ids, strict=True)):
                by_bin: dict[int, list[int]] = {}
                for leaf in tree.opened(row, visits, k_rows):
                    by_bin.setdefault(bins[leaf], []).append(leaf)
                out.extend((vec_id, number, leaves) for number, leaves in by_bin.items())
                where.extend([k] * len(by_bin))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _, _ in out], pa.int64()),
                    batch.column(1).take(pa.array(where, pa.int64())),
                    pa.array([x for _, x, _ in out], pa.int32()),
                    pa.array([x for _, _, x in out], pa.list_(pa.int64())),
                ],
                ["query_id", "point", "bin", "leaves"],
            )

    k_rows = k + 1
    asked = index.filter("asked").select("vec_id", "vector")
    opened = stored(asked.mapInArrow(open_leaves, "query_id long, point array<double>, bin int, leaves array<long>"))
    # one row per bin that is opened: into how many parts its vectors and its queries are dealt
    sizes = index.groupBy("bin").agg(F.count("*").alias("_n")).join(opened.groupBy("bin").agg(F.count("*").alias("_q")), "bin")
    parts = [F.ceil(F.col(c) / BLOCK).cast("int").alias(name) for c, name in (("_n", "_parts"), ("_q", "_turns"))]
    blocks = small(stored(sizes.select("bin", *parts)))

    def dealt(rows, names, own, key, other):
        """Each row goes to its own part of its bin, once for each part of the other side."""
        part = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        rest = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.join(blocks, "bin").select(*names, "bin", part.alias(own + "_k"), rest.alias(other + "_k"))

    left = dealt(index, ["vec_id", "vector", "leaf"], "_parts", "vec_id", "_turns")
    right = dealt(opened, ["query_id", "point", "leaves"], "_turns", "query_id", "_parts")
    keys = ["bin", "_parts_k", "_turns_k"]

    def search(rows: pa.Table, asking: pa.Table) -> pa.Table:
        best: dict[int, list[tuple[float, int]]] = {}
        vec_ids, ids = rows["vec_id"].to_numpy(), asking["query_id"].to_numpy()
        if len(vec_ids) and len(ids):
            block = rows["vector"].combine_chunks().flatten().to_numpy().reshape(len(vec_ids), -1)
            points = asking["point"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            askers: dict[int, list[int]] = {}
            for number, leaves in enumerate(asking["leaves"].to_pylist()):
                for leaf in leaves:
                    askers.setdefault(leaf, []).append(number)
            own = rows["leaf"].to_numpy()
            for leaf in np.unique(own).tolist():
                here, who = np.flatnonzero(own == leaf), askers.get(leaf, [])
                if who:
                    for i, j, score in _nearest(points[who], ids[who], block[here], vec_ids[here], k):
                        best.setdefault(int(ids[who[i]]), []).append((float(score), int(vec_ids[here[j]])))
        found = [(query, vec_id, score) for query, near in best.items() for score, vec_id in heapq.nsmallest(k, near)]
        return pa.table(
            {
                "query_id": pa.array([x for x, _, _ in found], pa.int64()),
                "vec_id": pa.array([x for _, x, _ in found], pa.int64()),
                "score": pa.array([x for _, _, x in found], pa.float64()),
            }
        )

    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    ranked = found.withColumn("rank", F.row_number().over(_order("query_id", "score")).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
