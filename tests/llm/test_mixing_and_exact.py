import hashlib

import pytest
from pyspark.sql import functions as F

from trailmark.llm import exact, mixing

SPACES = str.maketrans("", "", " \t\n\x0b\f\r")


def test_targets_fill_up_from_the_smallest_ratio(spark):
    sizes = spark.createDataFrame([("a", 1, 100), ("b", 1, 1000), ("c", 1, 10), (None, 1, 0)], "source string, docs long, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes, mixing.in_turn(sizes)).collect()}
    # weights 1, 2, 3, 1 over 1,110 words: c stops at 30; a and b share 1,080 as 1 : 2, a stops at 300
    assert got["c"] == 30 and got["a"] == 300 and got["b"] == pytest.approx(780) and got[None] == 0


def test_mix_takes_what_targets_say(documents):
    rows = mixing.allocate(documents).collect()
    taken, targets = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
    assert all(abs(taken[s] - targets[s]) < 1 for s in targets)
    assert sum(targets.values()) == pytest.approx(sum(r.size for r in rows))
    assert sorted(map(str, rows)) == sorted(map(str, mixing.allocate(documents.repartition(7)).collect()))


def test_positions_invert_the_demand(spark, documents):
    order = mixing.mix_sources(documents).collect()
    at = [r.position for r in order]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    rows = mixing.allocate(documents).filter("source = 'src1'").collect()  # in turn: the rising curve
    done = sorted((c.position, c.words) for r in rows for c in r.copies)
    target, gone = rows[0].target, 0
    for t, words in done:  # from 1 to 3 over time: area t + t * t of 2
        assert gone / target == pytest.approx((t + t * t) / 2, abs=1e-6)
        gone += words


def test_odd_documents_in_the_mix(odd, none):
    rows = mixing.allocate(odd).collect()
    assert len(rows) == odd.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.allocate(none).count() == mixing.mix_sources(none).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.filter("text IS NULL").count() == 0


def test_constant_schedule_and_source_without_schedule(spark):
    docs = spark.createDataFrame([(k, "w " * 10, "x" if k % 2 else "y") for k in range(20)], "doc_id long, text string, source string")
    only = spark.createDataFrame([("x", [(0.0, 1.0), (1.0, 1.0)])], "source string, knots " + mixing.KNOTS)
    got = {s: sum(r.taken for r in mixing.allocate(docs, only).collect() if r.source == s) for s in "xy"}
    assert got == {"x": 200, "y": 0}


def brute_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(SPACES), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    return {key: (min(g)[2] if not min(g)[1] else None, len(g)) for key, g in groups.items()}


@pytest.mark.parametrize("salts", [1, 16])
def test_exact_groups(odd, odd_rows, none, salts):
    want = brute_groups([(r[0], r[1]) for r in odd_rows])
    got = exact.exact_groups(odd, salts).collect()
    digests = {hashlib.sha256(key.encode()).hexdigest(): value for key, value in want.items()}
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.keep_id, r.group_size) == digests[r.digest] and r.kept == (r.doc_id == r.keep_id)
    assert exact.exact_groups(none).count() == 0


def test_texts_with_one_digest_are_told_apart(odd, odd_rows):
    want = sorted((str(k), n) for k, n in brute_groups([(r[0], r[1]) for r in odd_rows]).values())
    got = exact.exact_groups(odd, digest=lambda content: F.lit("same")).select("keep_id", "group_size").distinct().collect()
    assert sorted((str(r.keep_id), r.group_size) for r in got) == want


def test_exact_dedup_keeps_one_row_of_each(odd, odd_rows, none):
    kept = exact.exact_dedup(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(brute_groups([(r[0], r[1]) for r in odd_rows]))
    assert exact.exact_dedup(none).count() == 0
