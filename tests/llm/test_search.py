import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import queries, search

FOLDER = "/root/testdata/sf0.001"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute_search(docs, items, k=10):
    """The contract word by word: every document scored for every item."""
    held = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i if i is not None else 2**63, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return out


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_of_all_documents(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(queries.op13_search(spark, FOLDER)) == sorted(want, key=str)


@pytest.mark.parametrize("documents, postings, terms_together", [(7, 40, 5), (16_384, 4_000_000, 100_000)])
def test_search_in_small_blocks_with_ties(spark, monkeypatch, documents, postings, terms_together):
    monkeypatch.setattr(search, "TERMS", terms_together)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(30)] + ["É", "中文", "x1"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 3, 3, 40])))) for k in range(400)]
    rows += [(500 + k, "w1 w2 w3") for k in range(150)]  # a hot stratum of ties
    asked = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert rows_of(search.search(docs, items)) == sorted(brute_search(rows, asked), key=str)
    # the index of one task, cut into blocks
    monkeypatch.setattr(search, "DOCUMENTS", documents)
    monkeypatch.setattr(search, "POSTINGS", postings)
    numbers = {w: k for k, w in enumerate(words)}
    held = [(i, Counter(numbers[w] for w in t.split())) for i, t in rows]
    batch = search.pa.RecordBatch.from_pylist(
        [{"at": i, "m": 10 + len(c), "terms": list(c), "tfs": list(c.values())} for i, c in held],
        schema=search.pa.schema([("at", search.pa.int64()), ("m", search.pa.int64()), ("terms", search.pa.list_(search.pa.int32())), ("tfs", search.pa.list_(search.pa.int32()))]),
    )
    blocks = list(search._blocks(iter([batch.slice(0, 300), batch.slice(300)])))
    assert [r for b in blocks for r in b["at"].to_pylist()] == [i for i, _ in rows]
    assert all(b.num_rows <= documents for b in blocks)


def test_strata_that_cannot_matter_are_not_visited():
    rng = np.random.default_rng(4)
    m = np.repeat(np.arange(10, 410, 4), 5)
    tfs = rng.integers(1, 4, len(m))
    index = search.Strata(m, np.arange(len(m) + 1), np.zeros(len(m), dtype=np.int64), tfs, 1)
    held = []
    visited, known = search.best(index, np.array([0]), np.array([7]), np.arange(len(m)), held, 10)
    assert known == 100 and visited < 50
    want = sorted(((7 * int(s), -d) for d, s in enumerate(search.impact(tfs, m))), reverse=True)[:10]
    assert sorted(((s, r) for s, r, _ in held), reverse=True) == want


def test_search_of_odd_documents(spark, odd, odd_rows, none):
    asked = [(1, "one TWO text 中文"), (1, "one"), (None, "an id"), (2, None), (3, " .. "), (4, "absent")]
    items = spark.createDataFrame([(i, t, 5, 6) for i, t in asked], "item_id long, text string, rank int, doc_id int")
    want = brute_search([(r[0], r[1]) for r in odd_rows], asked)
    assert rows_of(search.search(odd, items)) == sorted(want, key=str)
    assert search.search(none, items).count() == 0
    assert search.search(odd, items.limit(0)).count() == 0
    assert search.search(odd.filter(F.lit(False)), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
