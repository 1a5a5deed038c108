"""Skip-gram vectors with negative sampling, for graphs of any size.

Nodes and the nodes seen near them are dealt into blocks; a task meets the co-occurrences of
two blocks with just the parameter rows these need, and returns gradients, which are summed
by row.  Parameters live in a table and never on the driver or whole in a task.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.lineage import cut_lineage
from trailmark.functions.seeded import normals, uniform

#: Nodes of a block, about.
BLOCK = 20_000
#: Co-occurrences whose products are formed at a time.
PAIRS = 100_000


def co_occurrences(paths: DataFrame, window: int, keys: list[str]) -> DataFrame:
    """(keys, node, other, pairs): how often two different nodes stand within the window on a walk, counted map-side.

    Equal walks are counted first, so that a walk taken many times is unfolded once.
    """
    walks = paths.groupBy(*keys, "path").agg(F.count("*").alias("_walks"))
    placed = walks.select(*keys, "path", "_walks", F.posexplode("path").alias("_i", "node"))
    start = F.greatest(F.col("_i") + 1 - window, F.lit(1))
    nearby = F.slice("path", start, F.col("_i") + 1 + window - start + 1)
    return (
        placed.select(*keys, "node", "_walks", F.explode(nearby).alias("other"))
        .filter(F.col("node") != F.col("other"))
        .groupBy(*keys, "node", "other")
        .agg(F.sum("_walks").alias("pairs"))
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _added(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of the values that belong to each of `count` rows."""
    out = np.zeros((count, values.shape[1]))
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    heads = np.flatnonzero(np.diff(ordered, prepend=-1))
    if len(heads):
        out[ordered[heads]] = np.add.reduceat(values[order], heads, axis=0)
    return out


def block_gradients(own, near, drawn, pairs, negatives: int):
    """Gradients of one block.

    `own` and `near` are the vectors of its nodes and of those near them, `pairs` is (position in own, position in near,
    count).  `drawn` is (vectors, how often each was drawn, weights of the rows of `own`), the negative part: a row of
    weight w meets `negatives` * w random nodes in expectation.  Returns gradients of own, near and drawn.
    """
    i, j, count = pairs
    to_own, to_near = np.zeros_like(own), np.zeros_like(near)
    for k in range(0, len(i), PAIRS):
        a, b, c = i[k : k + PAIRS], j[k : k + PAIRS], count[k : k + PAIRS]
        pull = (c * (1 - _sigmoid(np.einsum("nd,nd->n", own[a], near[b]))))[:, None]
        to_own += _added(a, pull * near[b], len(own))
        to_near += _added(b, pull * own[a], len(near))
    vectors, times, weights = drawn
    if len(vectors) and len(own):
        push = _sigmoid(own @ vectors.T) * (negatives / times.sum() * times)[None, :] * weights[:, None]
        to_own -= push @ vectors
        return to_own, to_near, -(push.T @ own)
    return to_own, to_near, np.zeros_like(vectors)


def _negative_slices(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes as slices of the unit interval, as wide as their weight to the power 0.75, cut at a grid of cells."""
    from trailmark.operators.graph import next_hop_table

    weights = rows.select(*keys, F.lit("").alias("prev"), F.col("node").alias("curr"), F.pow("weight", F.lit(0.75)).alias("weight"))
    return next_hop_table(weights, keys[0] if keys else None).drop("prev")


def _drawn(slices: DataFrame, graphs: DataFrame, keys: list[str], seed: int, number: int, draws: int) -> DataFrame:
    """(keys, node, times): `draws` random nodes of each graph for one round, with replacement."""
    tickets = graphs.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    u = uniform(F.lit(f"{seed}-{number}"), *[F.col(k).cast("string") for k in keys], F.col("_k").cast("string"))
    tickets = tickets.withColumn("_u", u).withColumn("cell", F.least(F.floor(F.col("_u") * F.col("exits")), F.col("exits") - 1))
    hit = tickets.join(slices.drop("exits"), [*keys, "cell"]).filter("_u >= low AND _u < high")
    return hit.groupBy(*keys, F.col("curr").alias("node")).agg(F.count("*").cast("double").alias("times"))


def _gradients(keys: list[str], dim: int, negatives: int):
    def run(pairs: pa.Table, rows: pa.Table) -> pa.Table:
        table = rows.to_pandas()
        empty = np.zeros((0, dim))
        sides = [table[table.side == k] for k in (0, 1, 2)]
        own, near, random = (np.stack(s.vec.to_numpy()) if len(s) else empty for s in sides)
        place = [{n: k for k, n in enumerate(s.node)} for s in sides]
        found = (
            np.array([place[0][n] for n in pairs["node"].to_pylist()], dtype=np.int64),
            np.array([place[1][n] for n in pairs["other"].to_pylist()], dtype=np.int64),
            pairs["pairs"].to_numpy().astype(float),
        )
        home = np.where(sides[0].home.to_numpy(dtype=bool), sides[0].weight.to_numpy(dtype=float), 0.0)
        parts = block_gradients(own, near, (random, sides[2].weight.to_numpy(dtype=float), home), found, negatives)
        names = [[k for k in s.node] for s in sides]
        side = [0] * len(own) + [1] * (len(near) + len(random))
        out = {k: [table[k].iloc[0]] * len(side) for k in keys}
        out |= {"side": pa.array(side, pa.int32()), "node": names[0] + names[1] + names[2], "grad": list(np.concatenate(parts))}
        return pa.table(out)

    return run


def skip_gram_embeddings(
    paths: DataFrame,
    dim: int = 64,
    window: int = 10,
    seed: int = 42,
    rounds: int = 12,
    negatives: int = 5,
    draws: int = 200,
    rate: float = 0.3,
    by: str | None = None,
) -> DataFrame:
    """(node, embedding) from walks by skip-gram with negative sampling, with ``by`` for each of its graphs.

    All co-occurrences within the window count, in every round.  A round draws ``draws`` nodes of each graph, with chances
    of their frequency to the power 0.75; they stand for ``negatives`` random nodes for each co-occurrence.  Rows move along
    their summed gradient, divided by the row's co-occurrences and by the root of its earlier squares.
    Starts and draws are hashes of names, so results do not depend on partitioning.  Nodes that
    stand near no other keep their first vector.
    """
    keys = [by] if by else []
    counts = cut_lineage(co_occurrences(paths, window, keys))
    nodes = cut_lineage(paths.select(*keys, F.explode("path").alias("node")).distinct())
    blocks = max(1, -(-nodes.count() // BLOCK))
    block = lambda name: F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")
    pairs = cut_lineage(counts.select(*keys, block("node").alias("bi"), block("other").alias("bj"), "node", "other", "pairs"))
    # co-occurrences are symmetric: a node's total is the same on both sides
    weights = counts.groupBy(*keys, "node").agg(F.sum("pairs").cast("double").alias("weight"))
    base = nodes.join(weights, [*keys, "node"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    start = lambda side: F.transform(normals(F.concat(F.lit(f"skip-gram {side} "), F.col("node")), dim, seed), lambda x: x / F.lit(dim**0.5))
    sided = [base.select(*keys, F.lit(k).alias("side"), "node", start(k).alias("vec"), F.lit(0.0).alias("squares"), "weight") for k in (0, 1)]
    rows = cut_lineage(sided[0].union(sided[1]))
    # which rows each block needs, and in which block a row meets its random nodes
    home = nodes.select(*keys, block("node").alias("bi"), block("node").alias("bj"), F.lit(0).alias("side"), "node", F.lit(True).alias("home"))
    wanted = pairs.select(*keys, "bi", "bj", F.lit(0).alias("side"), "node", F.lit(False).alias("home")).union(
        pairs.select(*keys, "bi", "bj", F.lit(1).alias("side"), F.col("other").alias("node"), F.lit(False).alias("home"))
    )
    needs = cut_lineage(wanted.union(home).groupBy(*keys, "bi", "bj", "side", "node").agg(F.max("home").alias("home")))
    slices = cut_lineage(_negative_slices(base.filter("weight > 0"), keys))
    graphs = cut_lineage(slices.groupBy(*keys).agg(F.first("exits").alias("exits"))) if keys else cut_lineage(slices.select("exits").limit(1))
    places = nodes.select(*keys, block("node").alias("bi")).distinct()
    at = [*keys, "bi", "bj"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "side int, node string, grad array<double>"])
    for number in range(rounds):
        drawn = _drawn(slices, graphs, keys, seed, number, draws).join(rows.filter("side = 1").select(*keys, "node", "vec"), [*keys, "node"])
        everywhere = places.join(F.broadcast(drawn), keys) if keys else places.crossJoin(F.broadcast(drawn))  # at most `draws` rows a graph
        given = needs.join(rows.drop("squares"), [*keys, "side", "node"]).select(*at, "side", "node", "vec", "weight", "home")
        random = everywhere.select(*keys, "bi", F.col("bi").alias("bj"), F.lit(2).alias("side"), "node", "vec", F.col("times").alias("weight"), F.lit(False).alias("home"))
        grads = pairs.groupBy(*at).cogroup(given.union(random).groupBy(*at)).applyInArrow(_gradients(keys, dim, negatives), schema)
        summed = grads.groupBy(*keys, "side", "node").agg(F.expr(f"array({', '.join(f'sum(grad[{k}])' for k in range(dim))})").alias("_sum"))
        moved = rows.join(summed, [*keys, "side", "node"], "left").withColumn(
            "_step", F.when(F.col("weight") > 0, F.transform("_sum", lambda g: g / F.col("weight")))
        )
        power = F.aggregate("_step", F.lit(0.0), lambda total, g: total + g * g) / F.lit(float(dim))
        moved = moved.withColumn("squares", F.col("squares") + F.coalesce(power, F.lit(0.0)))
        along = F.zip_with("vec", "_step", lambda v, g: v + g * F.lit(rate) / F.sqrt(F.col("squares") + F.lit(1e-12)))
        rows = cut_lineage(moved.withColumn("vec", F.coalesce(F.when(F.col("weight") > 0, along), F.col("vec"))).select(*rows.columns))
    return rows.filter("side = 0").select(*keys, "node", F.col("vec").alias("embedding"))
