import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import language, neighbours, quality, shards

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.filter(~held_out))
    rows = language.identify(docs.filter(held_out), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    far = spark.createDataFrame([(1, "これは日本語の文章です。"), (2, "и это русский текст")], "doc_id long, text string")
    assert all(r.rejected for r in language.identify(far, model).collect())


def test_a_mislabelled_text_does_not_switch_rejection_off(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    odd = ["и это русский текст о погоде", "これは日本語の文章です。", "ελληνικό κείμενο", "q7"]
    wrong = [(10_000_000 + 10 * k + j, t, x) for k, x in enumerate(["de", "en", "es", "fr"]) for j, t in enumerate(odd)]
    model = language.fit(docs.unionAll(spark.createDataFrame(wrong, docs.schema)))
    assert min(model.reach) > 0.02
    far = spark.createDataFrame([(1, "Книга лежит на столе"), (2, "東京は日本の首都です"), (3, "Καλημέρα σας"), (4, "ja ty")], "id int, text string")
    assert all(r.rejected for r in language.identify(far, model).collect())
    judged = language.identify(docs, model).collect()
    assert sum(r.rejected for r in judged) <= 0.01 * len(judged)
    # the fitted texts are judged as well: those that lie far from their own label's centroids go
    assert language.accepted(spark.createDataFrame(wrong, docs.schema), model).count() == 0


def test_rare_language_keeps_its_centroids_in_a_small_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang")
    words = "и это русский текст о погоде городе реке доме книге дороге".split()
    rare = [(" ".join(words[(k * j) % len(words)] for j in range(1, 9 + k % 5)), "ru") for k in range(20)]
    repeated = [("ένα ελληνικό κείμενο", "el")] * 300 + [("άλλο κείμενο στα ελληνικά", "el")]
    both = docs.unionAll(spark.createDataFrame(rare + repeated, "text string, lang string"))
    model = language.fit(both, sample_rows=10)
    assert set(model.languages) == {"de", "el", "en", "es", "fr", "ru"} and model.languages.count("ru") > 1
    rows = language.identify(both, model).collect()
    assert all(r.lang_pred == r.lang for r in rows if r.lang in ("ru", "el"))
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_letters():
    for text in ("²", "½", "Ⅷ", "①", "12 34 _", "١٢", "!?", "", None):
        assert not language.has_letter(text)
    for text in ("é", "12 中", "_я", "ª", "ʰ", "3½x"):
        assert language.has_letter(text)


def test_texts_of_signs_have_no_language(spark, odd):
    model = language.fit(odd)
    signs = spark.createDataFrame([(k, t) for k, t in enumerate(["²", "½ ½", "Ⅷ", "① ②", "12"])], "doc_id long, text string")
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identify(signs, model).collect()} == {("und", 0.0, True)}


def brute_language(train, texts, clusters=4, rounds=4, outside=0.02, smallest=0.05, slack=0.25):
    """The same model in plain numpy over all training texts at once: (language, cosine, rejected) of each text."""

    def vector(text):
        raw = b" ".join([b"", *bytes(b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()).split(), b""])
        row = np.zeros(language.DIMENSIONS)
        for width in (1, 2, 3):
            for k in range(len(raw) - width + 1):
                code = 0
                for at in range(width):
                    code = (code * 257 + raw[k + at] + at + 1) % 2**32 if at else (raw[k] + 1) % 2**32
                row[(code * 2654435761 % 2**32) >> (32 - 13)] += 1
        return row

    def unit(rows):
        return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)

    train = [(t, x) for t, x in train if t and x and any(map(str.isalpha, t))]
    counts = np.array([vector(t) for t, _ in train])
    idf = np.log((1 + len(train)) / (1 + (counts > 0).sum(axis=0))) + 0.05
    vectors, names = unit(np.log1p(counts) * idf), sorted({x for _, x in train})
    different = sorted({(t, x): k for k, (t, x) in enumerate(train)}.values())
    owners = [k // clusters for k in range(clusters * len(names))]
    own = np.array([names.index(x) for _, x in train])
    part = [clusters * own[k] + sum(train[k][0].encode()) % clusters for k in different]
    held = {key: [k for k, p in zip(different, part, strict=True) if p == key] for key in sorted(set(part))}
    centroids, owners = unit(np.array([vectors[v].sum(axis=0) for v in held.values()])), np.array([owners[k] for k in held])

    def nearest(rows, of):
        cosine = rows @ centroids.T
        cosine[of[:, None] != owners[None, :]] = -2
        return cosine.argmax(axis=1), cosine.max(axis=1)

    def limit(values):
        bins = np.sort(np.clip((values * language.DIMENSIONS).astype(int), 0, None))
        return bins[min(int(np.ceil(outside * len(bins))), len(bins) - 1)] / language.DIMENSIONS

    limits = np.full(len(names), -1.0)
    for _ in range(rounds):
        best, value = nearest(vectors[different], own[different])
        near = value >= limits[own[different]]
        limits = np.array([limit(value[own[different] == k]) for k in range(len(names))])
        held = {k: vectors[different][near & (best == k)] for k in range(len(centroids)) if (near & (best == k)).any()}
        centroids, owners = unit(np.array([v.sum(axis=0) for v in held.values()])), owners[list(held)]
    sizes = np.array([len(v) for v in held.values()])
    used = sizes >= smallest * np.bincount(owners, weights=sizes)[owners]
    centroids, owners = centroids[used], owners[used]
    _, value = nearest(vectors, own)
    reach = [slack * limit(value[own == k]) for k in range(len(names))]
    out = []
    for text in texts:
        if not any(map(str.isalpha, text or "")):
            out.append(("und", 0.0, True))
            continue
        cosine = centroids @ unit(np.log1p(vector(text)) * idf)
        k = owners[cosine.argmax()]
        out.append((names[k], float(cosine.max()), bool(cosine.max() < reach[k])))
    return out


def test_language_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 1500").select("doc_id", "text", "lang")
    rows = docs.orderBy("doc_id").collect()
    odd = ["Книга лежит на столе", "²", "", None, "zzz qqq", "東京は日本の首都です"]
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in language.identify(
        docs.select("doc_id", "text").unionAll(spark.createDataFrame([(-k, t) for k, t in enumerate(odd, 1)], "doc_id long, text string")), language.fit(docs)
    ).collect()}
    want = brute_language([(r.text, r.lang) for r in rows], [*[r.text for r in rows], *odd])
    for key, (lang, score, rejected) in zip([*[r.doc_id for r in rows], *[-k for k in range(1, 7)]], want, strict=True):
        assert got[key][0] == lang and got[key][2] == rejected and got[key][1] == pytest.approx(score, abs=1e-4), key


def test_sample_level_of_languages():
    assert language._level([5, 100, 1000], 2000) >= 1000
    assert language._level([5, 100, 1000], 305) == 200 and language._level([50, 50], 10) == 5


def test_language_of_odd_documents(odd, none):
    model = language.fit(odd)
    rows = {(r.doc_id, r.text): r for r in language.identify(odd, model).collect()}
    assert language.identify(odd, model).count() == odd.count()
    for (_, text), r in rows.items():
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
        assert r.rejected or r.lang_pred != "und"
    assert language.accepted(odd, model).columns == odd.columns
    assert language.fit(none) is None
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identify(odd, None).collect()} == {("und", 0.0, True)}
    assert language.identify(none, model).count() == 0


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = quality.score_documents(docs, labels, ~held_out).filter(held_out).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    right = sum((r.score >= 0.3) == (r.quality == 1) for r in rows)
    assert right >= 0.95 * len(rows)


def test_quality_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (10, 0), (99, 1), (11, None)], "doc_id long, quality int")
    rows = quality.score_documents(odd, labels, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    unlabelled = quality.score_documents(odd, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert quality.score_documents(none, labels, F.lit(True)).count() == 0


def test_rising_step_function():
    rng = np.random.default_rng(1)
    totals, counts = rng.random(50) * np.arange(50), rng.integers(1, 9, 50).astype(float)
    fitted = quality.rising(totals, counts)
    assert (np.diff(fitted) >= -1e-12).all() and np.dot(fitted, counts) == pytest.approx(totals.sum())
    for k in range(1, 50):  # at a step, the blocks on both sides have their own means
        if fitted[k] > fitted[k - 1] + 1e-12:
            assert np.dot(fitted[:k], counts[:k]) == pytest.approx(totals[:k].sum())


def brute_nearest(rows, is_query, k=10):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in usable:
        if is_query(q):
            found = sorted((float(np.sqrt(np.square(v - x).sum())), i) for i, v in usable if i != q)
            out[q] = found[:k]
    return out


def test_neighbours_reach_the_recall(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, leaf_rows=40).collect()
    want = brute_nearest([(r.vec_id, r.embedding) for r in table.collect()], lambda q: q % 20 == 0)
    near = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        near.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(near) == set(want) and all(len(x) == 10 and x == sorted(x) for x in near.values())
    hits = sum(len({i for _, i in near[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_neighbours_among_odd_and_equal_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(150)] + [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(200, 320)]
    rows += [(400, None), (500, []), (401, [0.0] * 4), (402, [1.0, None, 2.0, 3.0]), (403, [float("nan")] * 4), (404, [float("inf")] * 4), (405, [1.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    got = neighbours.nearest(table, F.col("vec_id") % 50 == 0, recall=1.0, leaf_rows=20).collect()
    want = brute_nearest([r for r in rows if r[1] is None or len(r[1]) == 4], lambda q: q % 50 == 0)
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert {q: [i for _, i in x] for q, x in found.items()} == {q: [i for _, i in x] for q, x in want.items()}
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(table.filter("vec_id < 3"), F.col("vec_id") == 1).count() == 2
    assert neighbours.nearest(table, F.lit(False)).count() == 0


def laid_out(rows, n, total):
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, held.values())) == total and set(held) <= set(range(n))
    sizes = [len(held.get(k, [])) for k in range(n)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())


def test_shards_are_even_and_keep_groups_together(spark):
    rows = [(k, f"g{k % 40}" if k < 120 else None) for k in range(1000)]
    table = spark.createDataFrame(rows, "doc_id long, link string").repartition(4)
    got = shards.balanced_shards(table, "link", 7).collect()
    laid_out(got, 7, 1000)
    assert len({(r.link, r.shard) for r in got if r.link}) <= 44  # 40 groups, hardly a cut
    again = shards.balanced_shards(table.repartition(9), "link", 7).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


@pytest.mark.parametrize("rounds", [0, 2])
def test_shards_with_one_large_group(spark, rounds):
    rows = [(k, "hot" if k % 2 else f"x{k}") for k in range(500)]
    laid_out(shards.balanced_shards(spark.createDataFrame(rows, "doc_id long, link string"), "link", 6, rounds).collect(), 6, 500)


def test_shards_with_a_hot_third_cut_no_more_than_needed(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"g{k // 12}" if k % 3 == 1 else None) for k in range(4800)]
    got = shards.balanced_shards(spark.createDataFrame(rows, "doc_id long, link string").repartition(4), "link", 24).collect()
    laid_out(got, 24, 4800)
    held = {}
    for r in got:
        held.setdefault(r.link, set()).add(r.shard)
    assert len(held.pop("hot")) == 8
    held.pop(None)
    assert sum(len(x) > 1 for x in held.values()) == 0


def test_shards_full_of_groups(spark):
    rows = [(k, f"g{k // 5}") for k in range(600)]
    got = shards.balanced_shards(spark.createDataFrame(rows, "doc_id long, link string").repartition(4), "link", 4).collect()
    laid_out(got, 4, 600)
    assert len({(r.link, r.shard) for r in got}) == 120


def test_shards_of_odd_documents(odd, none):
    got = shards.balanced_shards(odd.withColumn("shard", F.lit("own")), "text", 4)
    laid_out(got.collect(), 4, odd.count())
    assert shards.balanced_shards(none, "text", 4).count() == 0
    laid_out(shards.balanced_shards(odd.limit(2), "text", 24).collect(), 24, 2)
