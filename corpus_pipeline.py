"""From raw documents to token ids: language, exact copies, near copies, mixture, encoding.

Each stage takes (spark, docs, folder) with all that the stage before kept, and returns
a DataFrame that is written and read again before the next.  All but the last
return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import bpe, exact, jaccard, language, mixing
from trailmark.llm.shared import stored


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents near enough to a language learned from the labelled ones; texts without letters, null and empty ones go.

    Each row is judged by its text alone, so repeated rows and null ids make no difference; an empty
    table, or one without any labelled text, gives no rows.
    """
    return language.accepted(docs, language.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts that are equal without white space, the longest, then the first, stays.

    Null texts equal empty ones; a null id comes last; of rows that repeat id and text one stays.
    """
    return exact.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.75 or more in five-word shingles, the first stays.

    Rows without words are linked with nothing and stay; a null id comes last; of rows that repeat an id one stays.
    """
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in training order, each as often as its source's target takes it.

    Rows without words are in no mix; a null source is a source; rows with null or repeated ids count each.
    """
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The rows with `position` (their place in the training order), `n_tokens` and `ids` in place of text.

    Decoding the ids must give the text back, else the run fails.  Null and empty texts have no ids; rows
    that repeat keep places of their own; columns of `docs` with these three names are left out.
    """
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    kept = [f"`{c}`" for c in docs.columns if c not in ("text", "position", "n_tokens", "ids")]
    placed = mixing.in_training_order(docs, "_llm_position")
    whole = F.sha2(F.coalesce("text", F.lit("")), 256).alias("_llm_whole")
    rows = placed.select(*kept, F.col("_llm_position").alias("position"), whole, F.col("text").alias("_llm_text"))
    encoded = bpe.encode(rows, path, public_tokenizers.PATTERN, "_llm_text", keep=False)
    again = bpe.decode(encoded.withColumn("_llm_ids", F.col("ids")), path, "_llm_ids", "_llm_decoded", keep=False)
    same = F.sha2("_llm_decoded", 256) == F.col("_llm_whole")
    checked = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoded text differs")))
    return again.select(*kept, "position", F.size("ids").alias("n_tokens"), checked.alias("ids"))


STAGES = [
    ("language", known_language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("mixture", mixture),
    ("token ids", token_ids),
]

#: The language model and the encoding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over documents, each one's rows stored before the next."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
