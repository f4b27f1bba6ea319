"""The training-text pipeline: stages that each take and return the documents table.

Null ids and repeated rows are allowed: a document is known by its id and its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm import bpe, dart_minhash, decontamination, fertility, identity, pseudonyms
from vacanta.llm.queries import (
    BYTE_RANKS,
    PIECE_MODEL,
    pseudonym_key,
    public_tokenizers,
    ship,
    table,
)
from vacanta.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the fertility bands keep."""
    ship(spark)
    found = fertility.measured(docs, BYTE_RANKS, public_tokenizers.PATTERN, PIECE_MODEL)
    kept = ~fertility.base_failed() & fertility.in_band(F.col("lang"))
    return found.filter(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one of smallest id."""
    ship(spark)
    path = scratch_path(spark, "near-result")
    dart_minhash.near_duplicates(docs).write.parquet(path)
    found = spark.read.parquet(path)
    again = found.groupBy("doc_id", "text_md5").agg(F.count("*").alias("n"), F.first("first").alias("first"))
    path = scratch_path(spark, "near-repeated")
    again.filter("n > 1").write.parquet(path)
    again = spark.read.parquet(path)
    taken = found.filter(~F.col("first")).select("doc_id", "text_md5").unionByName(again.select("doc_id", "text_md5"))
    kept = identity.without(docs, taken)
    repeated = again.filter("first")
    if not repeated.isEmpty():
        kept = kept.unionByName(identity.once(docs, repeated))
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    marked = docs.withColumn("text_md5", identity.text_md5())
    found = decontamination.contaminated(
        marked, table(spark, sf_dir, "benchmark"), keep=("doc_id", "text_md5")
    )
    path = scratch_path(spark, "contaminated")
    found.filter("contaminated").select("doc_id", "text_md5").write.parquet(path)
    return identity.without(docs, spark.read.parquet(path)).select(*docs.columns)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, valid personal values replaced; n_chars counts the new text."""
    found = pseudonyms.pseudonymised(docs, pseudonym_key(spark))
    length = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return found.withColumns(length).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's packed token ids, and the digest of what they decode to.

    The last stage: of the other columns only doc_id, lang and source stay.
    """
    ship(spark)
    return bpe.encode_texts(
        docs,
        BYTE_RANKS,
        public_tokenizers.PATTERN,
        keep=("doc_id", "lang", "source"),
        outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", pseudonymise),
    ("bpe", encode),
]

# Fertility, signatures, pseudonyms and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
