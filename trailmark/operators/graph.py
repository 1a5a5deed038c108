"""Graph scores of edges: degree, PageRank, embeddings and their distances."""

import numpy as np
import pandas as pd
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions.lineage import bucketed, cut_lineage, drop_bucketed
from trailmark.functions.quantile import exact_percentile, exact_percentiles
from trailmark.functions.scores import euclidean
from trailmark.functions.seeded import normals, uniform, weight
from trailmark.functions.skew import salted_join
from trailmark.operators.skipgram import co_occurrences, skip_gram_embeddings
from trailmark.schema import EDGE, GRAPH_SCORES

METHODS = ("auto", "gnn", "node2vec", "context", "deepwalk", "none")


def _keys(by: str | None) -> list[str]:
    """The columns that tell graphs apart: none for a single graph."""
    return [by] if by else []


def page_graph(clicks: DataFrame, max_edges: int | None = None, by: str | None = None) -> DataFrame:
    """Weighted directed edges (prev, curr, weight), all or only the heaviest ones; with ``by`` one graph for each of its values."""
    keys = _keys(by)
    edges = clicks.groupBy(*keys, "prev", "curr").agg(F.sum("n").cast("double").alias("weight"))
    if max_edges is None:
        return edges
    order = [F.desc("weight"), "prev", "curr"]
    if not keys:
        return edges.orderBy(*order).limit(max_edges)
    ranked = edges.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_k") <= max_edges).drop("_k")


def graph_nodes(edges: DataFrame, by: str | None = None) -> DataFrame:
    return edges.select(*_keys(by), F.explode(F.array("prev", "curr")).alias("node")).distinct()


def node_degrees(edges: DataFrame, by: str | None = None) -> DataFrame:
    """In plus out degree; a self-loop counts twice."""
    ends = edges.select(*_keys(by), F.explode(F.array("prev", "curr")).alias("node"))
    return ends.groupBy(*_keys(by), "node").agg(F.count("*").alias("degree"))


#: Parts into which the exits of a node are dealt.
SALTS = 8


def _moves(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, prev, salt, curr, share): what part of its rank a node sends along an edge."""
    out_weight = edges.groupBy(*keys, "prev").agg(F.sum("weight").alias("_out"))
    return salted_join(edges, out_weight, [*keys, "prev"], ["curr"]).select(
        *keys,
        "prev",
        F.pmod(F.xxhash64("curr"), F.lit(SALTS)).cast("int").alias("salt"),
        "curr",
        (F.col("weight") / F.col("_out")).alias("share"),
    )


def rank_round(ranks: DataFrame, moves: DataFrame, keys: list[str], damping: float) -> DataFrame:
    """One round of PageRank over (keys, node, pagerank, base); ``before`` is the rank before it.

    Ranks go to the buckets of the edges that leave them, contributions are summed map-side; the
    edges stay where they are stored.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sent = ranks.select(*keys, F.col("node").alias("prev"), "pagerank", salts.alias("salt")).join(moves, [*keys, "prev", "salt"])
    none = F.lit(None).cast("double")
    given = sent.select(*keys, F.col("curr").alias("node"), (F.col("pagerank") * F.col("share")).alias("sent"), none.alias("base"), none.alias("before"))
    # each node's own row, so that nodes without incoming edges keep their place
    own = ranks.select(*keys, "node", F.lit(0.0).alias("sent"), "base", F.col("pagerank").alias("before"))
    summed = given.union(own).groupBy(*keys, "node").agg(F.sum("sent").alias("sent"), F.max("base").alias("base"), F.max("before").alias("before"))
    return summed.select(*keys, "node", (damping * F.col("sent") + F.col("base")).alias("pagerank"), "base", "before")


def pagerank(
    edges: DataFrame,
    damping: float = 0.85,
    iterations: int = 100,
    tol: float | None = 1e-6,
    checkpoint_every: int = 5,
    by: str | None = None,
) -> DataFrame:
    """Weighted PageRank; the mass of nodes without exits spreads evenly.

    Even spreading only rescales the ranks, so rounds run without it and the
    result is scaled to sum 1.  Edges are written once, in buckets of their source, the
    exits of a node over several of them: a round shuffles ranks and contributions, never edges.

    With ``by`` each of its values (a month) is a graph of its own, all in the same rounds.  Rounds are stored in
    groups; after each group a graph is finished if the change of the last round is below
    nodes x ``tol`` x mass (``tol=None`` runs all iterations).  The driver sees two sums for each graph.
    """
    spark, keys = edges.sparkSession, _keys(by)
    moves, table = bucketed(_moves(edges, keys), [*keys, "prev", "salt"])
    nodes = cut_lineage(graph_nodes(moves, by))
    counts = nodes.groupBy(*keys).agg(F.count("*").alias("_count"))
    ranks = salted_join(nodes, counts, keys, ["node"]) if keys else nodes.crossJoin(F.broadcast(counts))
    base = F.lit(1.0 - damping) / F.col("_count")
    running = ranks.select(*keys, "node", (F.lit(1.0) / F.col("_count")).alias("pagerank"), base.alias("base"))
    running = cut_lineage(running)
    finished = []
    for done in range(1, iterations + 1):
        fresh = rank_round(running, moves, keys, damping)
        if done % checkpoint_every and done < iterations:
            running = fresh.drop("before")
            continue
        fresh = cut_lineage(fresh)
        running = fresh.drop("before")
        if tol is None:
            continue
        change, mass = F.sum(F.abs(F.col("pagerank") - F.col("before"))), F.sum("pagerank")
        state = fresh.groupBy(*keys).agg((change < F.count("*") * tol * mass).alias("done")).collect()
        settled = [r[by] if by else None for r in state if r["done"]]
        if settled and by:
            over = F.col(by).isin([k for k in settled if k is not None]) | (F.col(by).isNull() & F.lit(None in settled))
            over = F.coalesce(over, F.lit(False))
            finished.append(running.filter(over))
            running = running.filter(~over)
        if len(settled) == len(state):
            break
    for part in finished:
        running = running.unionByName(part)
    ranks = cut_lineage(running.select(*keys, "node", "pagerank"))
    drop_bucketed(spark, table)
    masses = ranks.groupBy(*keys).agg(F.sum("pagerank").alias("_mass"))
    scaled = salted_join(ranks, masses, keys, ["node"]) if keys else ranks.crossJoin(F.broadcast(masses))
    return scaled.select(*keys, "node", (F.col("pagerank") / F.col("_mass")).alias("pagerank"))


def structural_stats(edges: DataFrame, by: str | None = None, **ranking) -> DataFrame:
    """Degree and PageRank per node."""
    return node_degrees(edges, by).join(pagerank(edges, by=by, **ranking), [*_keys(by), "node"])


def structural_vector(node: Column, degree: Column, rank: Column, dim: int, seed: int) -> Column:
    return F.concat(F.array(degree.cast("double"), rank), normals(node, dim - 2, seed))


def structural_embeddings(stats: DataFrame, dim: int = 64, seed: int = 42) -> DataFrame:
    """Node vectors [degree, pagerank, seeded normals of the node's name]."""
    vector = structural_vector(F.col("node"), F.col("degree"), F.col("pagerank"), dim, seed)
    return stats.select("node", vector.alias("embedding"))


def _with_both_ends(edges: DataFrame, nodes: DataFrame, columns: list[str], by: str | None) -> DataFrame:
    """Attach node columns of both endpoints; edges missing one are dropped."""
    for end, other in (("prev", "curr"), ("curr", "prev")):
        named = nodes.select(*_keys(by), F.col("node").alias(end), *[F.col(c).alias(f"_{end}_{c}") for c in columns])
        edges = salted_join(edges, named, [*_keys(by), end], [other])
    return edges


def structural_distances(edges: DataFrame, stats: DataFrame, dim: int = 64, seed: int = 42, by: str | None = None) -> DataFrame:
    """Distance of the endpoints' structural vectors.

    Only degree and rank travel with the joins; the seeded part is a function of
    the node names already in the row.
    """
    both = _with_both_ends(edges, stats, ["degree", "pagerank"], by)
    vectors = {
        f"_{end}": structural_vector(F.col(end), F.col(f"_{end}_degree"), F.col(f"_{end}_pagerank"), dim, seed)
        for end in ("prev", "curr")
    }
    return both.select(*edges.columns, euclidean(vectors["_prev"], vectors["_curr"]).alias("distance"))


def embedding_distances(edges: DataFrame, embeddings: DataFrame, by: str | None = None) -> DataFrame:
    both = _with_both_ends(edges, embeddings, ["embedding"], by)
    distance = euclidean(F.col("_prev_embedding"), F.col("_curr_embedding"))
    return both.select(*edges.columns, distance.alias("distance"))


def _layer(layer: int, dim: int, seed: int):
    """ReLU(W_n mean(neighbours) + W_s self + b) over Arrow batches."""
    names = [f"layer{layer}-neighbour", f"layer{layer}-self"]
    near, own = (
        np.array([[weight(seed, name, r, c, dim) for c in range(dim)] for r in range(dim)]) for name in names
    )
    bias = np.array([weight(seed, f"layer{layer}-bias", r, 0, dim) for r in range(dim)])

    def apply(mean: pd.Series, self_: pd.Series) -> pd.Series:
        if len(mean) == 0:
            return pd.Series([], dtype=object)
        out = np.stack(mean.to_numpy()) @ near.T + np.stack(self_.to_numpy()) @ own.T + bias
        return pd.Series(list(np.maximum(out, 0.0)))

    return F.pandas_udf(apply, "array<double>")


def neighbour_embeddings(edges: DataFrame, dim: int = 64, layers: int = 2, seed: int = 42, by: str | None = None) -> DataFrame:
    """Mean-of-neighbours embeddings with fixed untrained weights on seeded node features.

    Each layer is one salted join, a map-side mean per dimension and a batched
    matrix product.  Neighbours are the pages that lead to the node.
    """
    keys = _keys(by)
    pairs = cut_lineage(edges.select(*keys, "prev", "curr").distinct())
    state = cut_lineage(graph_nodes(pairs, by).select(*keys, "node", normals(F.col("node"), dim, seed).alias("h")))
    for layer in range(layers):
        sent = salted_join(pairs, state.withColumnRenamed("node", "prev"), [*keys, "prev"], ["curr"])
        means = sent.groupBy(*keys, F.col("curr").alias("node")).agg(
            F.expr(f"array({', '.join(f'avg(h[{i}])' for i in range(dim))})").alias("_mean")
        )
        joined = state.join(means, [*keys, "node"], "left")
        mean = F.coalesce(F.col("_mean"), F.array_repeat(F.lit(0.0), dim))
        state = cut_lineage(joined.select(*keys, "node", _layer(layer, dim, seed)(mean, F.col("h")).alias("h")))
    return state.withColumnRenamed("h", "embedding")


def next_hop_table(edges: DataFrame, by: str | None = None) -> DataFrame:
    """Edges as slices of their source's unit interval, cut at a grid of cells.

    Row (prev, cell, low, high, curr, exits): a draw u in [low, high) moves from
    prev to curr.  A source with d exits has d cells, so a draw meets about one
    or two rows, and a source with very many exits is spread over its cells.
    Running weights are built in two levels, within and across 256 hash buckets
    of the target: no source is summed in one task.
    """
    keys = _keys(by)
    parted = edges.withColumn("_b", F.substring(F.md5(F.col("curr").cast("binary")), 1, 2))
    sums = parted.groupBy(*keys, "prev", "_b").agg(F.sum("weight").alias("_w"), F.count("*").alias("_d"))
    source = Window.partitionBy(*keys, "prev")
    offsets = sums.select(
        *keys,
        "prev",
        "_b",
        (F.sum("_w").over(source.orderBy("_b")) - F.col("_w")).alias("_before"),
        F.sum("_w").over(source).alias("_total"),
        F.sum("_d").over(source).alias("exits"),
    )
    inside = Window.partitionBy(*keys, "prev", "_b").orderBy("curr")
    ranged = parted.withColumn("_upto", F.sum("weight").over(inside)).join(offsets, [*keys, "prev", "_b"])
    ranged = ranged.select(
        *keys,
        "prev",
        "curr",
        "exits",
        ((F.col("_before") + F.col("_upto") - F.col("weight")) / F.col("_total")).alias("low"),
        ((F.col("_before") + F.col("_upto")) / F.col("_total")).alias("high"),
    )
    top = F.col("exits") - 1
    first = F.least(F.floor(F.col("low") * F.col("exits")), top)
    last = F.least(F.floor(F.col("high") * F.col("exits")), top)
    return ranged.withColumn("cell", F.explode(F.sequence(first, last)))


def random_walks(
    edges: DataFrame, walks: int = 200, length: int = 30, seed: int = 42, checkpoint_every: int = 5, by: str | None = None
) -> DataFrame:
    """Weighted random walks from every node: (start, walk, path), with ``by`` in each of its graphs.

    Steps are drawn by a hash of (seed, graph, start, walk, step), so walks do not
    depend on partitioning.  A walk ends where a node has no exits; it is set aside then and joins no more
    steps.  No step follows once all walks have ended.
    """
    keys = _keys(by)
    hops = cut_lineage(next_hop_table(edges, by))
    exits = hops.groupBy(*keys, F.col("prev").alias("node")).agg(F.first("exits").alias("_exits"))
    named = exits.withColumnRenamed("node", "curr")
    target = hops.join(named, [*keys, "curr"], "left").select(
        *[F.col(k).alias("_graph") for k in keys], F.col("prev").alias("_from"), F.col("cell").alias("_slice"), "low", "high",
        F.col("curr").alias("_to"), F.coalesce("_exits", F.lit(0)).alias("_next"),
    )
    target = cut_lineage(target)
    starts = graph_nodes(edges, by).join(exits, [*keys, "node"], "left")
    walkers = starts.select(
        *keys,
        F.col("node").alias("start"),
        F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("walk"),
        F.col("node").alias("at"),
        F.coalesce("_exits", F.lit(0)).alias("_exits"),
        F.array("node").alias("path"),
    )
    out = [*keys, "start", "walk", "path"]
    ended = [cut_lineage(walkers.filter("_exits = 0").select(*out))]
    walkers = walkers.filter("_exits > 0")
    for step in range(1, length):
        draw = uniform(F.lit(str(seed)), *[F.col(k).cast("string") for k in keys], F.col("start"), F.col("walk").cast("string"), F.lit(str(step)))
        cell = F.when(F.col("_exits") > 0, F.least(F.floor(F.col("_u") * F.col("_exits")), F.col("_exits") - 1))
        moving = walkers.withColumn("_u", draw).withColumn("_cell", cell)
        hit = (F.col("at") == F.col("_from")) & (F.col("_cell") == F.col("_slice")) & F.expr("_u >= low AND _u < high")
        for k in keys:
            hit &= F.col(k) == F.col("_graph")
        met = F.col("_to").isNotNull()
        walkers = moving.join(target, hit, "left").select(
            *keys,
            "start",
            "walk",
            F.coalesce("_to", "at").alias("at"),
            F.when(met, F.col("_next")).otherwise(F.lit(0)).alias("_exits"),
            F.when(met, F.concat("path", F.array("_to"))).otherwise(F.col("path")).alias("path"),
        )
        if step % checkpoint_every == 0 or step == 1 or step == length - 1:
            walkers = cut_lineage(walkers)
            ended.append(walkers if step == length - 1 else walkers.filter("_exits = 0"))
            walkers = walkers.filter("_exits > 0")
            if walkers.isEmpty():
                break
    found = ended[0]
    for part in ended[1:]:
        found = found.unionByName(part.select(*out))
    return found


#: Word2Vec keeps its vocabulary (every node) on the driver and in each task.
VOCABULARY_LIMIT = 1_000_000


def walk_embeddings(
    paths: DataFrame,
    dim: int = 64,
    window: int = 10,
    seed: int = 42,
    partitions: int = 8,
    vocabulary_limit: int = VOCABULARY_LIMIT,
) -> DataFrame:
    """Node vectors from walks by Word2Vec; an error if there are too many nodes for its vocabulary.

    ``skip_gram_embeddings`` and ``context_embeddings`` are the methods for graphs of any size.
    """
    if paths.select(F.explode("path")).distinct().limit(vocabulary_limit + 1).count() > vocabulary_limit:
        raise ValueError(f"Word2Vec is for at most {vocabulary_limit} nodes; use skip-gram or context embeddings")
    laid_out = paths.repartition(partitions, "start", "walk").sortWithinPartitions("start", "walk")
    model = Word2Vec(
        vectorSize=dim,
        windowSize=window,
        minCount=1,
        seed=seed,
        numPartitions=partitions,
        inputCol="path",
        outputCol="embedding",
    ).fit(laid_out)
    return model.getVectors().select(F.col("word").alias("node"), vector_to_array("vector").alias("embedding"))


def context_embeddings(paths: DataFrame, dim: int = 64, window: int = 10, seed: int = 42, by: str | None = None) -> DataFrame:
    """Unit-length sum of the seeded vectors of all nodes within the window on walks.

    Co-occurrences are counted first; walks are short, so the pairs per
    walk are bounded by its length times the window.
    """
    keys = _keys(by)
    counts = co_occurrences(paths, window, keys).withColumn("_v", normals(F.col("other"), dim, seed))
    sums = counts.groupBy(*keys, "node").agg(
        F.expr(f"array({', '.join(f'sum(pairs * _v[{i}])' for i in range(dim))})").alias("_s")
    )
    norm = F.sqrt(F.aggregate("_s", F.lit(0.0), lambda acc, x: acc + x * x))
    scaled = F.transform(F.col("_s"), lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(F.lit(0.0)))
    units = sums.withColumn("_norm", norm).select(*keys, "node", scaled.alias("embedding"))
    nodes = paths.select(*keys, F.explode("path").alias("node")).distinct()
    return nodes.join(units, [*keys, "node"], "left").select(
        *keys, "node", F.coalesce("embedding", F.array_repeat(F.lit(0.0), dim)).alias("embedding")
    )


def flag_distances(distances: DataFrame, percentile: float = 95.0, by: str | None = None) -> DataFrame:
    """Scale by the largest distance and flag scores at or beyond the percentile, of each graph of ``by`` apart."""
    fixed_rows, keys = cut_lineage(distances), _keys(by)
    tops = fixed_rows.groupBy(*keys).agg(F.max("distance").alias("_top"))
    joined = salted_join(fixed_rows, tops, keys, ["prev", "curr"]) if keys else fixed_rows.crossJoin(F.broadcast(tops))
    score = F.when(F.col("_top") > 0, F.col("distance") / F.col("_top")).otherwise(F.col("distance"))
    scored = cut_lineage(joined.withColumn("gnn_score", score).drop("distance", "_top"))
    if keys:
        limits = exact_percentiles(scored, by, "gnn_score", percentile / 100)
        kind = scored.select(by, F.lit(0.0).alias("_limit")).schema
        table = scored.sparkSession.createDataFrame(list(limits.items()), kind)
        scored = scored.join(F.broadcast(table), by, "left")  # one row for each graph
        flag = F.coalesce(F.col("gnn_score") >= F.col("_limit"), F.lit(False))
        return scored.withColumn("gnn_flag", flag).drop("_limit")
    threshold = exact_percentile(scored, "gnn_score", percentile / 100)
    flag = F.lit(False) if threshold is None else F.col("gnn_score") >= F.lit(threshold)
    return scored.withColumn("gnn_flag", flag)


def graph_scores(
    clicks: DataFrame,
    months: str | list[str],
    method: str = "auto",
    percentile: float = 95.0,
    dim: int = 64,
    seed: int = 42,
    max_edges: int | None = None,
    walks: int = 200,
    length: int = 30,
    window: int = 10,
    **ranking,
) -> DataFrame:
    """Score every edge of each month by how far apart its endpoints are embedded in the month's graph.

    All months go through the same rounds: the plan and the number of jobs do not grow with them.
    ``deepwalk`` (also ``auto``) uses degree and PageRank, ``gnn`` neighbour
    means, ``node2vec`` random walks and skip-gram vectors, ``context`` random walks and context sums; ``none`` gives an empty table.  A
    graph is whole unless ``max_edges`` asks for the heaviest edges only.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    if method == "none":
        return clicks.sparkSession.createDataFrame([], GRAPH_SCORES)
    by = "month"
    rows = clicks.filter(F.col(by).isin([months] if isinstance(months, str) else months))
    graph = cut_lineage(page_graph(rows, max_edges, by))
    edges = rows.select(by, *EDGE).distinct()
    if method == "gnn":
        distances = embedding_distances(edges, neighbour_embeddings(graph, dim, seed=seed, by=by), by)
    elif method in ("node2vec", "context"):
        paths = cut_lineage(random_walks(graph, walks, length, seed, by=by))
        embed = skip_gram_embeddings if method == "node2vec" else context_embeddings
        distances = embedding_distances(edges, embed(paths, dim, window, seed, by=by), by)
    else:
        distances = structural_distances(edges, structural_stats(graph, by, **ranking), dim, seed, by)
    scored = flag_distances(distances, percentile, by)
    return scored.select(*[F.col(f.name).cast(f.dataType) for f in GRAPH_SCORES])
