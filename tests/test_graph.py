import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.functions.lineage import bucketed, cut_lineage, drop_bucketed
from trailmark.functions.quantile import exact_percentiles
from trailmark.functions.seeded import normals, weight
from trailmark.operators import graph, skipgram

EDGES = [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("c", "a", 5), ("c", "d", 1), ("d", "d", 2), ("e", "sink", 4)]


@pytest.fixture
def clicks(clicks_of):
    return clicks_of([(p, c, "link", "2024-01", n) for p, c, n in EDGES])


@pytest.fixture
def edges(clicks):
    return graph.page_graph(clicks)


def power_iteration(damping, rounds=200):
    nodes = sorted({x for p, c, _ in EDGES for x in (p, c)})
    at = {n: i for i, n in enumerate(nodes)}
    moves = np.zeros((len(nodes), len(nodes)))
    for p, c, n in EDGES:
        moves[at[p], at[c]] += n
    out = moves.sum(axis=1)
    sinks = out == 0
    moves[~sinks] /= out[~sinks, None]
    rank = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        rank = damping * (rank @ moves + rank[sinks].sum() / len(nodes)) + (1 - damping) / len(nodes)
    return dict(zip(nodes, rank))


def test_pagerank_with_sinks(edges):
    want = power_iteration(damping=0.3)
    ranks = graph.pagerank(edges, damping=0.3, tol=1e-8, checkpoint_every=4)
    got = {r["node"]: r["pagerank"] for r in ranks.collect()}
    assert got.keys() == want.keys()
    for node in want:
        assert got[node] == pytest.approx(want[node], abs=1e-6)
    assert sum(got.values()) == pytest.approx(1.0)


def test_degree_counts_loops_twice(edges):
    got = {r["node"]: r["degree"] for r in graph.node_degrees(edges).collect()}
    assert got == {"a": 3, "b": 2, "c": 4, "d": 3, "e": 1, "sink": 1}


def test_heaviest_edges(clicks):
    kept = graph.page_graph(clicks, max_edges=2).collect()
    assert {(r["prev"], r["curr"]) for r in kept} == {("c", "a"), ("e", "sink")}


def test_normals_are_standard_and_repeatable(spark):
    rows = spark.range(2000).select(normals(F.col("id").cast("string"), 6).alias("v"))
    got = np.array([r["v"] for r in rows.collect()])
    assert got.shape == (2000, 6)
    assert abs(got.mean()) < 0.03 and abs(got.std() - 1) < 0.03
    assert np.abs(np.corrcoef(got.T) - np.eye(6)).max() < 0.1
    again = np.array([r["v"] for r in rows.repartition(3).collect()])
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_structural_distance_equals_vector_distance(spark, clicks, edges):
    stats = graph.structural_stats(edges, iterations=3, tol=None)
    vectors = {r["node"]: np.array(r["embedding"]) for r in graph.structural_embeddings(stats, 16).collect()}
    rows = graph.structural_distances(edges.select("prev", "curr"), stats, 16).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        assert r["distance"] == pytest.approx(np.linalg.norm(vectors[r["prev"]] - vectors[r["curr"]]))


def test_neighbour_layers_against_numpy(edges):
    dim, seed = 5, 42
    table = graph.graph_nodes(edges).select("node", normals(F.col("node"), dim).alias("h"))
    state = {r["node"]: np.array(r["h"]) for r in table.collect()}
    for layer in range(2):
        w = lambda name, r, c: weight(seed, f"layer{layer}-{name}", r, c, dim)
        near = np.array([[w("neighbour", r, c) for c in range(dim)] for r in range(dim)])
        own = np.array([[w("self", r, c) for c in range(dim)] for r in range(dim)])
        bias = np.array([w("bias", r, 0) for r in range(dim)])
        fresh = {}
        for node, h in state.items():
            sources = [state[p] for p, c, _ in EDGES if c == node]
            mean = np.mean(sources, axis=0) if sources else np.zeros(dim)
            fresh[node] = np.maximum(near @ mean + own @ h + bias, 0)
        state = fresh
    for r in graph.neighbour_embeddings(edges, dim).collect():
        assert r["embedding"] == pytest.approx(list(state[r["node"]]))


def test_walks_follow_edges_with_their_weights(spark, clicks_of):
    targets = {"x": 70, "y": 20, "z": 10}
    rows = [("hub", t, "link", "2024-01", n) for t, n in targets.items()] + [(t, "hub", "link", "2024-01", 1) for t in targets]
    edges = graph.page_graph(clicks_of(rows))
    walks = graph.random_walks(edges, walks=300, length=6).collect()
    assert len(walks) == 4 * 300 and all(len(w["path"]) == 6 for w in walks)
    taken = [b for w in walks for a, b in zip(w["path"], w["path"][1:]) if a == "hub"]
    for t, n in targets.items():
        assert taken.count(t) / len(taken) == pytest.approx(n / 100, abs=0.03)
    again = graph.random_walks(edges.repartition(3), walks=300, length=6, checkpoint_every=2).collect()
    key = lambda w: (w["start"], w["walk"])
    assert sorted(map(tuple, again), key=lambda w: w[:2]) == sorted(map(tuple, walks), key=lambda w: w[:2])


def test_walks_stop_at_sinks(edges):
    for w in graph.random_walks(edges, walks=20, length=5).filter("start = 'e'").collect():
        assert w["path"] == ["e", "sink"]


def test_hop_cells_cover_the_unit_interval(clicks_of):
    rows = [("hub", f"t{i}", "link", "2024-01", 1 + (i * i) % 37) for i in range(200)]
    hops = graph.next_hop_table(graph.page_graph(clicks_of(rows))).collect()
    spans = sorted({(h["low"], h["high"]) for h in hops})
    assert len(spans) == 200 and spans[0][0] == 0 and spans[-1][1] == 1
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(hops) <= 400


@pytest.mark.parametrize("method", ["auto", "deepwalk", "gnn", "node2vec"])
def test_scores(clicks, method):
    options = {"walks": 5, "length": 5} if method == "node2vec" else {}
    rows = graph.graph_scores(clicks, "2024-01", method, dim=8, **options).collect()
    assert len(rows) == len(EDGES) and {r["type"] for r in rows} == {"link"}
    assert max(r["gnn_score"] for r in rows) == pytest.approx(1.0)
    limit = np.percentile([r["gnn_score"] for r in rows], 95)
    assert all(r["gnn_flag"] == (r["gnn_score"] >= limit - 1e-12) for r in rows)


def test_empty_scores(clicks):
    assert graph.graph_scores(clicks, "2024-01", "none").count() == 0
    nothing = graph.graph_scores(clicks, "1999-01")
    assert nothing.count() == 0 and "gnn_flag" in nothing.columns
    with pytest.raises(ValueError):
        graph.graph_scores(clicks, "2024-01", "magic")


def test_too_large_a_vocabulary_is_an_error(edges):
    walks = graph.random_walks(edges, walks=3, length=4)
    with pytest.raises(ValueError, match="context"):
        graph.walk_embeddings(walks, dim=4, window=2, vocabulary_limit=2)


def test_scores_of_context_sums(clicks):
    rows = graph.graph_scores(clicks, "2024-01", "context", dim=8, walks=3, length=4).collect()
    assert len(rows) == len(EDGES) and max(r["gnn_score"] for r in rows) == pytest.approx(1.0)


def test_months_are_graphs_of_their_own(spark, clicks_of):
    first = [(p, c, "link", "2024-01", n) for p, c, n in EDGES]
    second = [("a", "b", "link", "2024-02", 1), ("b", "a", "link", "2024-02", 1), ("b", "x", "other", "2024-02", 3)]
    both = clicks_of(first + second)
    for method, options in [("auto", {}), ("gnn", {}), ("context", {"walks": 3, "length": 4}), ("node2vec", {"walks": 3, "length": 4})]:
        together = graph.graph_scores(both, ["2024-01", "2024-02"], method, dim=8, **options).collect()
        for month in ("2024-01", "2024-02"):
            alone = graph.graph_scores(both, month, method, dim=8, **options).collect()
            key = lambda r: (r["prev"], r["curr"], r["type"])
            mine = {key(r): (r["gnn_score"], r["gnn_flag"]) for r in together if r["month"] == month}
            assert {k: v[1] for k, v in mine.items()} == {key(r): r["gnn_flag"] for r in alone}
            assert all(mine[key(r)][0] == pytest.approx(r["gnn_score"], abs=1e-6) for r in alone) and len(alone) == len(mine)


def test_a_round_of_pagerank_does_not_shuffle_edges(spark, edges):
    moves, table = bucketed(graph._moves(edges, []), ["prev", "salt"], 4)
    ranks = cut_lineage(graph.graph_nodes(edges).selectExpr("node", "1D AS pagerank", "0D AS base"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph.rank_round(ranks, moves, [], 0.85)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        drop_bucketed(spark, table)
    # ranks to the edges, contributions to their targets
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan


def test_percentiles_of_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 300)) for v in rng.choice([rng.normal(), 3.0, rng.random() * 1e6], n)]
    rows += [("c", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for p in (0.0, 0.37, 0.95, 1.0):
        got = exact_percentiles(df, "g", "v", p)
        assert set(got) == set("abcd")
        for g in got:
            assert got[g] == pytest.approx(np.percentile([v for k, v in rows if k == g and v is not None], 100 * p))


def test_skip_gram_separates_two_communities(spark, clicks_of):
    rng = np.random.default_rng(7)
    rows = []
    for side in "xy":
        for k in range(12):
            rows += [(f"{side}{k}", f"{side}{int(j)}", "link", "2024-01", 10) for j in rng.choice(12, 5, replace=False) if j != k]
    rows += [("x0", "y0", "link", "2024-01", 2), ("y1", "x1", "link", "2024-01", 2)]
    paths = cut_lineage(graph.random_walks(graph.page_graph(clicks_of(rows)), walks=20, length=12))
    vectors = {r["node"]: np.array(r["embedding"]) for r in graph.skip_gram_embeddings(paths, dim=16, window=4).collect()}
    unit = {n: v / np.linalg.norm(v) for n, v in vectors.items()}
    same = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[0] == b[0]]
    other = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[0] != b[0]]
    assert len(vectors) == 24 and np.mean(same) > np.mean(other) + 0.5
    nearest = [max((unit[a] @ unit[b], b) for b in unit if b != a)[1] for a in unit]
    assert sum(a[0] == b[0] for a, b in zip(unit, nearest)) >= 23


def brute_skip_gram(paths, dim, window, rounds, negatives, draws, rate, seed, starts, drawn):
    """The same rounds in plain numpy over all nodes at once."""
    nodes = sorted({n for p in paths for n in p})
    at = {n: k for k, n in enumerate(nodes)}
    counts = np.zeros((len(nodes), len(nodes)))
    for path in paths:
        for i, a in enumerate(path):
            for j, b in enumerate(path):
                if abs(i - j) <= window and a != b:
                    counts[at[a], at[b]] += 1
    rows = [np.array([starts[side, n] for n in nodes]) for side in (0, 1)]
    squares, weights = [np.zeros(len(nodes)) for _ in (0, 1)], counts.sum(axis=1)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for number in range(rounds):
        own, near = rows
        times = np.array([drawn[number].get(n, 0.0) for n in nodes])
        pull = counts * (1 - sigmoid(own @ near.T)) - sigmoid(own @ near.T) * negatives * times / times.sum() * weights[:, None]
        grads = [pull @ near, pull.T @ own]
        for side in (0, 1):
            step = np.divide(grads[side], weights[:, None], out=np.zeros_like(grads[side]), where=weights[:, None] > 0)
            squares[side] += (step**2).mean(axis=1)
            rows[side] = rows[side] + step * rate / np.sqrt(squares[side] + 1e-12)[:, None]
    return dict(zip(nodes, rows[0]))


@pytest.mark.parametrize("block", [20_000, 3])
def test_skip_gram_rounds_against_numpy(spark, edges, block, monkeypatch):
    monkeypatch.setattr(skipgram, "BLOCK", block)
    options = {"dim": 6, "window": 2, "rounds": 3, "negatives": 2, "draws": 30, "rate": 0.3, "seed": 9}
    paths = cut_lineage(graph.random_walks(edges, walks=4, length=5))
    got = {r["node"]: r["embedding"] for r in graph.skip_gram_embeddings(paths, **options).collect()}
    walks = [r["path"] for r in paths.collect()]
    names = spark.createDataFrame([(n,) for n in got], "node string")
    starts = {
        (side, r["node"]): np.array(r["v"]) / 6**0.5
        for side in (0, 1)
        for r in names.select("node", normals(F.concat(F.lit(f"skip-gram {side} "), F.col("node")), 6, 9).alias("v")).collect()
    }
    counts = cut_lineage(skipgram.co_occurrences(paths, 2, []))
    weights = counts.groupBy("node").agg(F.sum("pairs").cast("double").alias("weight"))
    slices = cut_lineage(skipgram._negative_slices(weights, []))
    graphs = slices.select("exits").limit(1)
    drawn = [{r["node"]: r["times"] for r in skipgram._drawn(slices, graphs, [], 9, k, 30).collect()} for k in range(3)]
    want = brute_skip_gram(walks, **options, starts=starts, drawn=drawn)
    assert got.keys() == want.keys()
    for node in want:
        assert got[node] == pytest.approx(list(want[node]), abs=1e-9)
