from collections import Counter

import numpy as np
import pytest

from trailmark.llm import jaccard, substrings
from trailmark.llm.hashing import Words

from .conftest import invented


def brute_removed(rows, width=13):
    rows = [(2**63 if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for doc_id, words in rows:
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, words in rows:
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < doc_id:
                gone[k : k + width] = [True] * width
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
    return sorted(out)


def removed(docs, width=13):
    rows = substrings.remove_repeats(docs, width).collect()
    return sorted((2**63 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows)


def test_removed_passages(documents, truth):
    assert removed(documents) == brute_removed(truth)


def test_removed_passages_of_odd_documents(odd, none):
    assert removed(odd) == brute_removed([(r.doc_id, r.text) for r in odd.collect()])
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("width", [5, 8, 13])
def test_shifted_and_branching_passages(spark, width):
    base = invented(60, 5).split()
    rows = [(9, " ".join(base))]
    for k in range(8):  # pieces that overlap, in ids before and after, and runs of one word
        rows.append((k * 3, f"{invented(k, k)} {' '.join(base[k * 4 : k * 4 + 22])} {invented(6, 90 + k)}"))
        rows.append((k * 3 + 1, "same " * (k + 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(docs, width) == brute_removed(rows, width)


def brute_components(rows, least=0.75):
    sets, ids = [], []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        runs = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        sets.append(runs)
        ids.append(2**63 if doc_id is None else doc_id)
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    held = {}
    for k, runs in enumerate(sets):
        common = Counter(o for run in runs for o in held.get(run, ()))
        for run in runs:
            held.setdefault(run, []).append(k)
        for o, n in common.items():
            if n >= least * (len(runs) + len(sets[o]) - n) - 1e-9:
                root[top(k)] = top(o)
    low = {}
    for k, i in enumerate(ids):
        low[top(k)] = min(i, low.get(top(k), i))
    return sorted((i, len(runs), low[top(k)]) for k, (i, runs) in enumerate(zip(ids, sets, strict=True)))


def components(docs, least=0.75):
    rows = jaccard.near_duplicates(docs, least=least).collect()
    return sorted((2**63 if r[0] is None else r[0], r[1], 2**63 if r[2] is None else r[2]) for r in rows)


def test_components(documents, truth):
    assert components(documents) == brute_components(truth)


def test_components_of_odd_documents(odd, none):
    assert components(odd) == brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.one_of_each(odd).columns == odd.columns and jaccard.one_of_each(none).count() == 0


@pytest.mark.parametrize(("least", "block"), [(0.5, 400), (0.75, 1_000_000), (0.75, 200), (0.9, 400)])
def test_chains_of_near_copies_and_a_common_passage(spark, least, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)  # so that neighbourhoods are cut
    rows, words = [], invented(80, 11).split()
    passage = invented(30, 12)
    for k in range(24):  # each differs a little more from the first
        words[(k * 7) % 80] = f"new{k}"
        rows.append((100 - k, " ".join(words)))
        rows.append((200 + k, f"{passage} {invented(20 + k, 40 + k)}"))
        rows.append((300 + k, f"{passage} tail{k}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert components(docs, least) == brute_components(rows, least)


def test_first_copies_of_rows_that_repeat_ids(spark):
    words = invented(60, 21).split()
    near = [*words[:30], "changed", *words[31:]]
    texts = [" ".join(words), " ".join(near), "", None, "other text with nothing in common"]
    rows = [(i, t, s, 1) for i, s in ((5, "a"), (None, "b"), (5, "c"), (2, "d")) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tie int").repartition(3)
    kept = jaccard.one_of_each(docs).collect()
    with_words = [r for r in kept if r.text]
    assert len(with_words) == 2 and {r.doc_id for r in with_words} == {2}
    assert {r.text for r in with_words} - set(texts[:2]) == {texts[4]}
    assert sum(not r.text for r in kept) == 8


def test_large_neighbourhood_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5_000)
    rows, words = [], invented(3_000, 31).split()
    for k in range(30):  # three families that share passages, some members too far apart
        part = [*words[: 2_000], *invented(300 + 150 * (k % 5), 60 + k % 3).split()]
        part[k * 50 : k * 50 + 10] = [f"x{k}"] * 10
        rows.append((k, " ".join(part)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert components(docs) == brute_components(rows)


def test_divide_skip_finds_what_counting_finds():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(200)]
    index, sizes = jaccard.Inverted(sets), np.array([len(x) for x in sets])
    for least in (0.4, 0.75):
        for own, x in enumerate(sets):
            common = Counter({k: len(np.intersect1d(x, y)) for k, y in enumerate(sets)})
            want = {k: n for k, n in common.items() if n and n >= least * (len(x) + sizes[k] - n) - 1e-9}
            found = dict(zip(*[x.tolist() for x in jaccard.divide_skip(index.shared(x), len(x), sizes, least)], strict=True))
            # shingles that no other set holds are no lists, so a set finds itself only if it shares enough
            assert {k: n for k, n in found.items() if k != own} == {k: n for k, n in want.items() if k != own}


def test_hash_of_a_run_does_not_depend_on_its_place():
    words = Words([b"a b c d e", b"x a b c", b"", b"c"])
    starts, text = words.windows(3)
    assert starts.tolist() == [0, 1, 2, 5, 6] and text.tolist() == [0, 0, 0, 1, 1]
    runs = words.runs(starts, starts + 3)
    assert runs[0] == runs[4] and len(set(runs.tolist())) == 4


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (99, 98)], "a long, b long")
    got = {r.id: r.root for r in jaccard.connected(links).collect()}
    assert got == {k: 0 for k in range(41)} | {98: 98, 99: 98, 100: 98}
