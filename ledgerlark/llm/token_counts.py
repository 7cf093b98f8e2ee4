"""Token counts from a digest cache.

Every text is reduced to the digest of its normalised content. The distinct digests meet the stored counts of this
tokenizer version; only contents without a stored count are encoded, one text for each, and their counts are appended
to the cache. Texts are not shuffled: the missing contents are named by row keys, and the scan keeps those rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.common import rows_of, small_batches
from ledgerlark.llm.wordpieces import Encoder, word_wise
from ledgerlark.operators.lineage import materialise

CACHE = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library.__name__} {library.__version__} ".encode() + file.read()).hexdigest()


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache's counts of one version, one row per digest (two jobs may have appended the same one)."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except Exception as error:  # the cache's first use
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `docs` (an action; appends to the folder `cache`).

    A null text counts as empty: no bytes, no tokens. Rows with a null or repeated id each give their own row; equal
    texts share one entry of the cache. Other columns are ignored. An empty table gives an empty result. `tokenizer`
    is a file that every executor can read. Text is normalised for the digest by joining white space into one blank
    where the tokenizer drops it, and not at all otherwise.
    """
    spark, version, by_word = docs.sparkSession, tokenizer_version(tokenizer), word_wise(tokenizer)
    texts = small_batches(docs).select(
        F.xxhash64(doc_id).alias("row_key"), F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    content = F.regexp_replace("text", "[ \\t\\n\\r]+", " ") if by_word else F.col("text")
    digest = F.unhex(F.sha2(content, 256))
    digests = materialise(
        texts.select("row_key", "doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")),
        "digests",
    )
    wanted = digests.groupBy("digest").agg(F.min("row_key").alias("row_key"))
    missing = wanted.join(stored_counts(spark, cache, version), "digest", "left_anti")
    missing = materialise(missing.select("row_key").distinct(), "missing")

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(tokenizer, by_word)
        for part in parts:
            counts = own.counts(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    encoded = (
        rows_of(texts, missing, "row_key")
        .select("text", digest.alias("digest"))
        .mapInArrow(encode, "digest binary, n_tokens long")
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
        .select("digest", F.lit(version).alias("version"), "n_tokens")
    )
    encoded.write.mode("append").parquet(cache)
    return digests.join(stored_counts(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
