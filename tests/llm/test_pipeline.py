import pytest
import tiktoken

import corpus_pipeline as pipeline
import public_tokenizers
from checks.compare import compare, database
from trailmark.llm import bpe, exact, language, mixing, oracle, queries
from trailmark.llm.shared import stored

from .test_repeats import brute_components

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, FOLDER, queries.queries()[name], oracle.oracle_sql()[name], database(FOLDER)).startswith("ok")


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_stages_do_what_they_say(spark, documents):
    docs = documents
    seen = {}
    for name, stage in pipeline.STAGES:
        seen[name], docs = docs, stored(stage(spark, docs, FOLDER))
        if name != "token ids":
            assert docs.columns == documents.columns
        seen[f"after {name}"] = docs
    ids = {name: {r.doc_id for r in table.select("doc_id").collect()} for name, table in seen.items()}
    judged = language.identify(documents, language.fit(documents)).filter("NOT rejected").collect()
    assert ids["after language"] == {r.doc_id for r in judged}
    assert ids["after exact copies"] == {r.doc_id for r in exact.exact_groups(seen["exact copies"]).filter("kept").collect()}
    rows = [(r.doc_id, r.text) for r in seen["near copies"].collect()]
    assert ids["after near copies"] == {c for _, _, c in brute_components(rows)}
    assert ids["after mixture"] <= ids["mixture"]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={},
    )
    texts = {r.doc_id: r.text for r in documents.collect()}
    order = [r.doc_id for r in mixing.mix_sources(seen["mixture"], whole=True).collect()]
    encoded = seen["after token ids"].orderBy("position").collect()
    assert [r.doc_id for r in encoded] == order and [r.position for r in encoded] == list(range(len(order)))
    for r in seen["after token ids"].collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_stages_take_odd_documents(spark, odd, none):
    clashing = {"size": "position", "rank": "n_tokens", "n": "cls", "score": "_llm_row", "digest": "_metadata"}
    for table in (odd.withColumnsRenamed(clashing), none.withColumnsRenamed(clashing)):
        rows, columns = table.count(), table.columns
        for name, stage in pipeline.STAGES:
            table = stored(stage(spark, table, FOLDER))
            if name != "token ids":
                assert table.columns == columns
        assert "text" not in table.columns and {"position", "n_tokens", "ids", "_llm_row"} <= set(table.columns)
        assert rows == 0 or table.count() > 0
    assert table.count() == 0


def test_mix_keeps_rows_without_ids_and_with_repeated_ids(spark):
    rows = [(k % 3 if k % 4 else None, f"{'w ' * (k + 1)}", "s", k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k int").repartition(4)
    got = mixing.mixed_documents(docs).collect()
    assert sorted(r.k for r in got) == list(range(40))  # one source: each row once
    again = mixing.mixed_documents(docs.repartition(7)).collect()
    assert [r.k for r in got] == [r.k for r in again]
    stored_rows = mixing.in_training_order(stored(mixing.mixed_documents(docs))).orderBy("position").collect()
    assert [(r.k, r.position) for r in stored_rows] == [(r.k, p) for p, r in enumerate(got)]
