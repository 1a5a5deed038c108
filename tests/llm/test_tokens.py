import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from trailmark.llm import bpe, token_files

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def test_encoding_is_that_of_the_library(documents, truth, library):
    got = {r.doc_id: r.ids for r in bpe.encode(documents, RANKS, PATTERN).collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in truth}


def test_long_pieces_and_all_kinds_of_characters(library):
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN, quick=True)
    texts = ["a" * 5000, "ab" * 3000 + "c", "=-" * 2000, " " * 999 + "x", "中文" * 500, "\x1c\x85\xa0  x́"]
    texts += ["x" + chr(c) + " " + chr(c) * 2 + "1" + chr(c) for c in [*range(0x600), *range(0x2000, 0x2100)]]
    found = [np.frombuffer(x, dtype=np.int32).tolist() for x in encoder.encode(texts)]
    assert found == [library.encode_ordinary(t) for t in texts]


def test_leftmost_of_overlapping_pairs_first(library):
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN, quick=False)
    texts = ["o" * k for k in range(1, 40)] + ["!" * k for k in range(1, 40)] + ["\n" * k + "x" for k in range(1, 20)]
    assert [np.frombuffer(x, dtype=np.int32).tolist() for x in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_round_trip_of_odd_texts(odd, none):
    encoded = bpe.encode(odd, RANKS, PATTERN)
    assert "n_chars" in encoded.columns and "text" not in encoded.columns
    both = bpe.decode(encoded, RANKS)
    want = sorted((r.doc_id or 0, (r.text or "").encode()) for r in odd.collect())
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in both.collect()) == want
    assert bpe.decode(bpe.encode(none, RANKS, PATTERN), RANKS).count() == 0


def test_unknown_and_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(rows, RANKS).collect()} == {1: None, 2: b""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>"), RANKS).collect()


def brute_files(rows, definition):
    tokenizer = token_files.Encoder(definition).tokenizer
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_ids_in_order(spark, documents, truth, definition, tmp_path):
    files = token_files.write_token_files(documents.repartition(5), definition, f"file://{tmp_path}", length=64)
    read = token_files.read_token_files(spark, files).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in read) == brute_files(truth, definition)
    row = files.orderBy("shard").first()
    file = token_files.TokenFile(row.path)
    ids, mask = file[row.sequences - 1]
    assert len(ids) == len(mask) == 64 and mask.sum() == (row.n_tokens - 1) % 64 + 1
    whole = np.concatenate(list(file.tokens()))
    assert len(whole) == row.n_tokens and (file[1][0] == whole[64:128]).all()
    assert not file[0][0].flags.owndata  # mapped, not copied


def test_files_of_odd_documents(spark, odd, none, definition, tmp_path):
    files = token_files.write_token_files(odd, definition, f"file://{tmp_path}/odd", length=32)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in token_files.read_token_files(spark, files).collect()]
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert sorted(got, key=lambda r: r[1]) == brute_files(rows, definition)
    empty = token_files.write_token_files(none, definition, f"file://{tmp_path}/none")
    assert empty.count() == 0 and token_files.read_token_files(spark, empty).count() == 0


def test_quick_and_whole_encoding_agree(definition):
    encoder = token_files.Encoder(definition)
    assert encoder.quick
    texts = ["x" + chr(c) + "B " + chr(c) * 2 + "1'S" + chr(c) for c in range(0x400)] + ["İSTANBUL ΣΑΣ", "<|endoftext|>"]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts)] == want


def test_added_tokens_in_texts_are_those_of_the_library(definition):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(definition)
    texts = ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|><|endoftext|>y", "A <|EndOfText|> b", "<| endoftext |>", "a <|endoftext b", "é <|endoftext|> 中"]
    found = [np.frombuffer(x, dtype="<u4").tolist() for x in token_files.Encoder(definition).encode(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert found[0] == [320, 49407, 321]
