from collections import Counter
from hashlib import sha256
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trailmark.llm import markov

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def brute_base(rows):
    """(doc_id, n_tokens, n_known, train_tokens, base score) of (doc_id, text, learn) by the formula."""
    counts = Counter(t for _, text, learn in rows if learn for t in tokens(text))
    n, kinds = sum(counts.values()), len(counts)
    return [
        (i, len(t := tokens(text)), sum(counts[w] > 0 for w in t), n, sum(log10((counts[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in t))
        for i, text, _ in rows
    ]


def brute_states(rows, states, rounds, own, endings, sent=markov.SENT, prior=500.0):
    """Baum-Welch token by token, and the log10 probability of each text."""
    counts = Counter(t for _, text, learn in rows if learn for t in tokens(text))
    total = sum(counts.values()) + 0.1 * (len(counts) + 1)
    common = [b"", *sorted((w for w in counts if w), key=lambda w: (-counts[w], w))]
    whole = [n for n in set(counts.values()) if sum(c >= n for w, c in counts.items() if w) < sent]
    common_enough = [w for w in common if not w or (whole and counts[w] >= min(whole))]
    of = {w: k for k, w in enumerate(common_enough[:own])}
    cls = lambda w: of.get(w, own + crc32(w[-3:]) % endings)
    mass = np.zeros(own + endings)
    mass[own:] += 0.1
    for w in common:
        mass[cls(w)] += counts[w] + 0.1
    mass /= total
    model = markov.first_states(mass, states)
    start, moves, emission = model.start, model.moves, model.emission * mass

    def forward(codes):
        a, scale, found = start, [], [start]
        for c in codes:
            a = (a @ moves) * emission[:, c]
            scale.append(a.sum())
            a = a / a.sum()
            found.append(a)
        return found, scale

    for _ in range(rounds):
        new = np.zeros(states), np.zeros((states, states)), np.zeros_like(emission)
        for _, text, learn in rows:
            if learn:
                codes = [cls(w) for w in tokens(text)]
                ahead, scale = forward(codes)
                back = np.ones(states)
                for t in range(len(codes), 0, -1):
                    new[2][:, codes[t - 1]] += ahead[t] * back
                    step = emission[:, codes[t - 1]] * back / scale[t - 1]
                    new[1][:] += np.outer(ahead[t - 1], step) * moves
                    back = moves @ step
                new[0][:] += start * back
        start = (new[0] + 1) / (new[0] + 1).sum()
        moves = (new[1] + 1) / (new[1] + 1).sum(axis=1, keepdims=True)
        emission = new[2] + prior * mass / mass.sum()
        emission /= emission.sum(axis=1, keepdims=True)
    scores = []
    for _, text, _ in rows:
        words = tokens(text)
        inside = sum(log10((counts[w] + 0.1) / total / mass[cls(w)]) for w in words)
        scores.append(float(np.log10(forward([cls(w) for w in words])[1]).sum()) + inside)
    return scores


#: Sizes at which small tables meet every way: shared classes, joined counts.
SMALL = {"own": 50, "endings": 16, "sent": 60}


def scored(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()), key=str)


def agree(got, rows, **brute):
    want = sorted(((*b, s) for b, s in zip(brute_base(rows), brute_states(rows, **brute), strict=True)), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9, atol=1e-9)
    # expected counts are in single precision
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-5)


def test_scores_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60)
    rows = [(r.doc_id, r.text, crc32(str(r.doc_id).encode()) % 10 != 0) for r in docs.collect()]
    got = scored(markov.score_documents(docs.repartition(4), F.crc32(F.col("doc_id").cast("string")) % 10 != 0, states=3, rounds=2))
    agree(got, rows, states=3, rounds=2, own=markov.OWN, endings=markov.ENDINGS)


def test_spans_of_texts_of_any_length_against_brute_force():
    rng = np.random.default_rng(6)
    model = markov.first_states(rng.random(9), 4)
    texts = [rng.integers(0, 9, n) for n in (1, 2, 16, 17, 200, 31, 32, 33, 5)]
    codes, ends = np.concatenate(texts).astype(np.int64), np.cumsum([0, *map(len, texts)])
    found = []
    for span, together in ((1_000, 10_000), (16, 64), (1, 7), (5, 1)):
        markov_span, markov_together = markov.SPAN, markov.TOGETHER
        markov.SPAN, markov.TOGETHER = span, together
        try:
            spans = markov.Spans(codes, ends, model)
            found.append((spans.likelihoods(), *spans.expected()))
        finally:
            markov.SPAN, markov.TOGETHER = markov_span, markov_together
    for other in found[1:]:
        for a, b in zip(found[0], other, strict=True):
            assert np.allclose(a, b, rtol=1e-10)
    assert found[0][1].sum() == pytest.approx(len(texts)) and found[0][2].sum() == pytest.approx(len(codes))


def test_words_of_columns_are_those_of_each_text():
    texts = ["", None, " a  B\tÄÖ\x0b\x0cİ\x1cx\x85y\xa0z\u2003q \r\n", "\n", "K ſ ẞ A-Z", "W" * 65 + " " + "w" * 64, "a a"]
    words, sizes = markov.words_of(pa.array(texts)[1:])
    want = [(t or "").encode().lower().split() for t in texts[1:]]
    assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    short = [w if len(w) <= 64 else b"\xff" + sha256(w).digest() for t in want for w in t]
    assert markov.narrowed(words).to_pylist() == short
    assert markov.endings_of(words, 16).tolist() == [crc32(w[-3:]) % 16 for t in want for w in t]


def test_pieces_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(markov, "PIECE", 10)
    texts = ["x" * n for n in (3, 0, 25, 1, 1, 9, 10, 11)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["row", "text"])
    found = list(markov.pieces(batch, 1))
    assert len(found) > 3 and [t for p in found for t in p.column(1).to_pylist()] == texts
    assert not list(markov.pieces(batch.slice(0, 0), 1))


def test_only_very_long_texts_need_products(monkeypatch):
    rng = np.random.default_rng(8)
    model = markov.first_states(rng.random(30), 4)
    lengths = [20_000, 3, 700, 40_000, 512, 513, 1_024]
    codes, ends = rng.integers(0, 30, sum(lengths)), np.cumsum([0, *lengths])
    spans = markov.Spans(codes, ends, model)
    long = spans.text == 3
    # a product of matrices takes as many steps as there are states, a waiting span one
    assert (spans.before[~long] == model.start).all() and (spans.before[np.flatnonzero(long)[1:]] != model.start).any(axis=1).all()
    mixed = spans.likelihoods(), *spans.expected()
    for turns in (0, 1_000):
        monkeypatch.setattr(markov, "IN_TURN", turns)
        other = markov.Spans(codes, ends, model)
        for a, b in zip(mixed, (other.likelihoods(), *other.expected()), strict=True):
            assert np.allclose(a, b, rtol=1e-10)


def test_likelihood_is_the_sum_over_all_paths():
    model = markov.first_states(np.array([0.5, 0.3, 0.2]), 2)
    codes = np.array([0, 2, 1, 1])
    total = 0.0
    for path in np.ndindex(2, 2, 2, 2, 2):
        p = model.start[path[0]]
        for t, c in enumerate(codes):
            p *= model.moves[path[t], path[t + 1]] * model.emission[path[t + 1], c]
        total += p
    assert markov.Spans(codes, np.array([0, 4]), model).likelihoods()[0] == pytest.approx(np.log(total))


def test_model_of_held_out_documents_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = markov.score_documents(docs, ~held_out).filter(held_out).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert rows[0] > rows[1] + 0.3 * rows[2]


def test_odd_documents_against_brute_force(spark, odd, odd_rows, none):
    rows = [(r[0], r[1], r[0] is not None and r[0] % 5 != 4) for r in odd_rows]
    rows = [(i, t if i not in (4, 5) else t[:3000], learn) for i, t, learn in rows]
    wide = [(20, "a" * 200 + " b", True), (21, "b " + "A" * 200, False)]
    cut = odd.withColumn("text", F.when(F.col("doc_id").isin(4, 5), F.substring("text", 1, 3000)).otherwise(F.col("text")))
    more = spark.createDataFrame(wide, "doc_id long, text string, learn boolean").drop("learn")
    both = cut.unionByName(more, allowMissingColumns=True)
    got = scored(markov.score_documents(both, (F.col("doc_id") % 5 != 4), states=3, rounds=2, **SMALL))
    keyed = [(i, " ".join(w if len(w) <= 64 else "Ÿ" + w for w in t.split(" ")) if i in (20, 21) else t, x) for i, t, x in [*rows, *[(i, t, i % 5 != 4) for i, t, _ in wide]]]
    base = sorted(brute_base(keyed), key=str)
    assert [g[:4] for g in got] == [b[:4] for b in base]
    assert np.allclose([g[4] for g in got], [b[4] for b in base], rtol=1e-9)
    assert all(g[5] < 0 for g in got)
    narrow = scored(markov.score_documents(cut, (F.col("doc_id") % 5 != 4), states=3, rounds=2, **SMALL))
    agree(narrow, rows, states=3, rounds=2, **SMALL)
    assert markov.score_documents(none, F.lit(True)).count() == 0
    unlearned = scored(markov.score_documents(cut, F.lit(False), states=2, rounds=1))
    assert len(unlearned) == len(rows) and all(g[2:5] == (0, 0, pytest.approx(0.0)) for g in unlearned)
    assert len(scored(markov.score_documents(odd.filter("doc_id = 4"), F.lit(True), rounds=1))) == 1
