"""From raw documents to binary shards: every stage works on all that its predecessor kept.

All stages but the last return the columns of documents. A stage that drops rows names them by a key of id and text, so
rows without an id are handled like the others.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.common import only, without
from ledgerlark.llm.decontaminate import leaks
from ledgerlark.llm.mixing import PRODUCTION, Mix, domain_of, mixture
from ledgerlark.llm.near_dup import near_duplicates
from ledgerlark.llm.quality import fit_quality, keep_good
from ledgerlark.llm.queries import table, tokenizer_path
from ledgerlark.llm.token_shards import documents_of, write_shards
from ledgerlark.operators.lineage import materialise, shared_dir

BUDGET = 900  # thousandths of all tokens that the mixing stage keeps


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model, fitted on the labelled ones, does not reject."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates; of rows of equal id and text one."""
    found = materialise(near_duplicates(docs).groupBy("text_key").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept")), "groups")
    gone = found.where("not kept or n > 1").select("text_key")
    rest = without(docs, materialise(gone, "duplicates"), "doc_id", "text")
    repeats = materialise(found.where("kept and n > 1").select("text_key"), "repeats")
    if repeats.isEmpty():
        return rest
    return rest.union(only(docs, repeats, "doc_id", "text").dropDuplicates(["doc_id", "text"]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    gone = leaks(docs, table(spark, sf_dir, "benchmark")).select("text_key").distinct()
    return without(docs, materialise(gone, "contaminated"), "doc_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents up to each source's budget, none of them twice."""
    named = docs if "domain" in docs.columns else docs.withColumn("domain", domain_of("source"))
    return mixture(named, Mix(weights=PRODUCTION, per_mille=BUDGET)).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Wavelet-matrix files of the token ids; the documents as read back from them."""
    path = f"{shared_dir(spark)}/wavelet-{uuid4().hex}"
    write_shards(docs, path, tokenizer_path())
    return documents_of(spark, path)


STAGES = [
    ("quality", good_quality),
    ("near_dup", distinct_documents),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shards", shards),
]
ORACLE_SQL = None  # a fitted classifier and a tokenizer have no SQL; tests/llm compares each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written as Parquet and read again (the last one is returned)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
