"""Exact dedup by skew-safe combining: in each task, then per salt, then over all salts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import SPACES, stored

#: Into how many parts the copies of one text are dealt before they are combined.
SALTS = 16


def squeezed(text: Column) -> Column:
    """A text without its white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_groups(docs: DataFrame, salts: int = SALTS, digest=_sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Texts are equal if they are identical without white space.  Of equal texts
    the row with the most characters stays, then the one with the smallest id.

    Texts meet three times, always compared in full: rows of one task are
    combined before they are sent (map-side), then those of one salt, then the
    winners of all salts.  Documents get their winner by the digest alone, save
    where two different texts have the same digest; those are joined by text.

    Null texts equal empty ones; a null id counts as the largest, and its row
    is kept only if all ids of its group are null; rows that repeat an id and a text
    count each and share its decision.  An empty table gives no rows, other columns are ignored.
    """
    content = squeezed(F.col("text"))
    rows = docs.select(
        "doc_id",
        content.alias("content"),
        digest(content).alias("digest"),
        F.struct(
            (-F.char_length(F.coalesce("text", F.lit("")))).alias("shorter"),
            F.col("doc_id").isNull().alias("no_id"),
            "doc_id",
        ).alias("rank"),
    )
    salted = (
        rows.groupBy("digest", "content", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
        .agg(F.count("*").alias("n"), F.min("rank").alias("best"))
    )
    winners = salted.groupBy("digest", "content").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    narrow = stored(winners.select("digest", "group_size", F.col("best.doc_id").alias("keep_id")))
    clashing = stored(narrow.groupBy("digest").count().filter("count > 1").select("digest"))
    out = ["doc_id", "keep_id", "group_size", "digest"]
    plain = rows.select("doc_id", "digest").join(narrow, "digest")
    if not clashing.isEmpty():
        apart = rows.join(clashing, "digest").join(
            winners.join(clashing, "digest").select(
                "digest", "content", "group_size", F.col("best.doc_id").alias("keep_id")
            ),
            ["digest", "content"],
        )
        plain = plain.join(clashing, "digest", "left_anti").select(*out).unionByName(apart.select(*out))
    return plain.select(*out[:3], F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, one for each text.

    Of rows that repeat both id and text, the one whose columns have the smallest hash stays.
    """
    kept = exact_groups(docs, salts).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_llm_id"), F.col("digest").alias("_llm_digest")).distinct()
    named = docs.withColumn("_llm_own", _sha256(squeezed(F.col("text"))))
    same = F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_own") == F.col("_llm_digest"))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    return (
        named.join(kept, same, "left_semi")
        .groupBy(F.col("doc_id").alias("_llm_id"), "_llm_own")
        .agg(F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_llm_row"))
        .select(*[F.col(f"_llm_row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
    )
