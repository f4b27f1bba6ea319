"""The registered queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm import (
    bpe,
    dart_minhash,
    decontamination,
    fertility,
    hard_negatives,
    histogram_sort,
    packing,
    pseudonyms,
    quality_discriminant,
    secret_ledger,
    spelling,
    sql,
    suffix_dedup,
    toxicity,
)
from vacanta.session import scratch_path

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {
    "op2_histogram_sort": sql.OP2,
    "op4_dart_minhash": sql.OP4,
    "op7_prefix_filtered_join": sql.OP7,
    "op8_blob_ledger": sql.OP8,
    "op11_bit_sliced_spelling": sql.OP11,
    "op12_str_tree_negatives": sql.OP12,
}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package where their path does not have it.

    Spark sends the archive to every executor, as with ``--py-files``.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_vacanta", False):
        return
    folder = tempfile.mkdtemp(prefix="vacanta-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "vacanta.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in root.glob("vacanta/**/*.py"):
            packed.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
    context._vacanta = True


def job(function: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    JOBS[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@job
def op1_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether base rule and fertility bands keep it."""
    found = fertility.measured(
        table(spark, folder, "documents"),
        BYTE_RANKS,
        public_tokenizers.PATTERN,
        PIECE_MODEL,
        keep=("doc_id", "lang"),
    )
    failed = fertility.base_failed()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ratios = ("n_tokens", "chars_per_token", "chars_per_piece", "fallback_share", "entropy_share")
    return found.select(
        "doc_id",
        *(F.col(f"fertility.{c}").alias(c) for c in counts),
        failed.alias("base_failed"),
        (~failed & fertility.in_band(F.col("lang"))).alias("kept"),
        *(F.col(f"fertility.{c}").alias(c) for c in ratios),
    )


SHARDS = 16


@job
def op2_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of near equal bytes; equal texts are neighbours in the sort order."""
    text = F.coalesce("text", F.lit(""))
    narrow = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        histogram_sort.hash_key(text).alias("k1"),
        histogram_sort.hash_key(F.col("doc_id")).alias("k2"),
        histogram_sort.row_key().alias("k3"),
    )
    path = scratch_path(spark, "histogram-keys")
    narrow.write.parquet(path)
    placed = histogram_sort.histogram_shards(spark.read.parquet(path), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The session names the key; without one, that of tests is taken.
KEY_SETTING, TEST_KEY = "vacanta.pseudonyms.key", "test-key"


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, TEST_KEY)


@job
def op3_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text with valid values replaced, and how many of each kind."""
    found = pseudonyms.pseudonymised(table(spark, folder, "documents"), pseudonym_key(spark))

    def number(kind: str):
        return F.size(F.filter("pii", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", "text", *map(number, pseudonyms.KINDS))


@job
def op4_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-duplicates of every document, with sizes and links."""
    return dart_minhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "class_size", "n_copies", "n_links"
    )


@job
def op5_monoid_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    return bpe.encode_texts(
        table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN
    )


@job
def op6_toxicity_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents; a fifth of the ids is never learned from."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.train(labels, documents)
    return toxicity.scored(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@job
def op7_prefix_filtered_join(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside an occurrence of a benchmark window."""
    found = decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    items = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@job
def op8_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, each distinct content scanned once."""
    found = secret_ledger.scan_versions(
        table(spark, folder, "documents"), scratch_path(spark, "secret-ledger")
    )

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end))
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s.kind.isin(*secret_ledger.BASE))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, secret_ledger.BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


FREE_ID = 50_256  # no token of the vocabulary has it


@job
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as packed id matrices, with segment ends and position resets."""
    return packing.packed_rows(
        table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN, FREE_ID
    )


@job
def op10_bucket_refinement(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without bytes of repeated 400-byte strings."""
    found = suffix_dedup.repeated_spans(table(spark, folder, "documents"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return found.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        F.col("kept_text").alias("text"),
    )


@job
def op11_bit_sliced_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its more frequent form, the root and near words."""
    return spelling.variants(table(spark, folder, "documents"))


@job
def op12_str_tree_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Five hard negatives of every anchor and positive, some labels made wrong on purpose."""
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(
        table(spark, folder, "embeddings"), F.col("vec_id"), F.col("embedding"), noisy, scale=256
    )
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


@job
def op13_quadratic_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents; a fifth of the ids is never learned from."""
    found = quality_discriminant.measured(table(spark, folder, "documents"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = table(spark, folder, "labels").select("doc_id", "quality").filter(~held_out)
    model = quality_discriminant.train(labels, found)
    return quality_discriminant.scored(found, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
