"""The registered queries of the operators for training data, each over its whole table."""

from pyspark.sql import functions as F

from trailmark.functions.lineage import scratch_path
from trailmark.llm import bpe, exact, jaccard, language, markov, mixing, neighbours, quality, search, shards, substrings, token_files, whitening


def op1_mix_sources(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.allocate(docs)
    first = F.coalesce(F.get("copies", F.lit(0))["position"], F.lit(2.0))
    return rows.orderBy(first, "doc_id").select("doc_id", "size", "source_size", "target", "taken")


def op2_jaccard_join(spark, folder):
    return jaccard.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))


def op3_token_files(spark, folder):
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        files = token_files.write_token_files(docs, file.read(), scratch_path(spark, "tokens"))
    read = token_files.read_token_files(spark, files)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_byte_bpe(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(encoded, path).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op5_substrings(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = substrings.remove_repeats(docs)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_shards(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("content"),
    )
    return shards.balanced_shards(rows, "content", 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_nearest(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def op8_exact_dedup(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return exact.exact_groups(docs).withColumnRenamed("digest", "text_sha256")


def op9_quality(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = quality.score_documents(docs, labels, ~held_out)
    return rows.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_language(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.filter(~held_out))
    rows = language.identify(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op11_whitening(spark, folder):
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op12_markov(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = markov.score_documents(docs, ~held_out)
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_search(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return search.search(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def queries():
    return {name: value for name, value in globals().items() if name.startswith("op") and callable(value)}
