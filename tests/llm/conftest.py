import random

import pytest

FOLDER = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank int, n int, ids string, score int, digest string"


def invented(n_words, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n_words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows, null ids."""
    long_text = invented(30_000, 1)
    words = invented(120, 2).split()
    near = [*words[:60], "changed", *words[61:]]
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \t\n\x0b ", "en", None),
        (4, long_text, "en", "b"),
        (5, long_text, "en", "b"),
        (6, " ".join(words), "de", "b"),
        (7, " ".join(near), "de", None),
        (8, "  ".join(words) + "\n", "de", "c"),
        (8, "  ".join(words) + "\n", "de", "c"),
        (9, "Ça 12 中文。 \U0001f600!! it's", None, "c"),
        (10, "one two", "en", "é"),
        (11, "ONE two", "en", "é"),
        (12, "12 34 ...", None, None),
        (None, "text without an id", "en", "a"),
        (None, None, None, None),
    ]
    return [(*r, None, 7, 1, 2, "x", 3, "y") for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def truth(documents):
    """(doc_id, text) in order of id."""
    return [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
