"""Stored postings: batches of sightings are appended, the first sighting counts.

A store holds committed batches (:mod:`vacanta.sources.commits`). A refresh processes
and writes only its own rows, under a name of its own; which sighting of an id counts is
decided when the store is read (:func:`current`), on the id, the time and the batch
alone, so a report reads only the columns it needs. No stored file is ever rewritten;
:func:`compact` writes the current rows as one batch that replaces the others.

A batch holds an id once, so a store of one batch is read as it is. Beside one large batch,
as compaction leaves it, the ids of the small ones are sent to it: its other rows pass
without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.operators.bitmaps import bucket_of, has_bit
from vacanta.operators.dedupe import first_seen, merge_counts
from vacanta.operators.processing import process_postings
from vacanta.sources import commits
from vacanta.sources.commits import BATCH, ORDER
from vacanta.sources.schema import RAW

# So many ids of small batches may be sent to a batch LARGE times as large.
BROADCAST_IDS, LARGE = 500_000, 4
# For so many rows at most the choice is sent to the stored rows, 128 MB of bits.
BROADCAST_BITS = 1 << 30


def processed_schema(spark: SparkSession) -> T.StructType:
    """Schema of :func:`process_postings` over raw rows; nothing is executed."""
    return process_postings(spark.createDataFrame([], RAW)).schema


def sightings(
    spark: SparkSession,
    store: str,
    schema: T.StructType | None = None,
    batches: list[commits.Batch] | None = None,
) -> DataFrame:
    """All stored rows with their batch and its order; empty if nothing was stored yet."""
    return commits.read(spark, store, schema or processed_schema(spark), batches)


def current(spark: SparkSession, store: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per id, first sighting; on equal times the earlier batch.

    A batch holds an id once, so time and batch order all sightings of an id.
    """
    schema = schema or processed_schema(spark)
    batches = commits.committed(spark, store)
    rows = sightings(spark, store, schema, batches)
    if len(batches) <= 1:
        return rows.drop(ORDER, BATCH)
    largest = max(batches, key=lambda b: b.rows)
    later = [b for b in batches if b != largest]
    n = sum(b.rows for b in later)
    if n > BROADCAST_IDS or LARGE * n > largest.rows:
        return first_seen(rows, (ORDER, BATCH), by_content=False).drop(ORDER, BATCH)
    some = sightings(spark, store, schema, later)
    ids = F.broadcast(some.select("id").filter("id IS NOT NULL").distinct())
    stored = sightings(spark, store, schema, [largest])
    met = first_seen(some.unionByName(stored.join(ids, "id", "left_semi")), (ORDER, BATCH), by_content=False)
    return stored.join(ids, "id", "left_anti").select(met.columns).unionByName(met).drop(ORDER, BATCH)


def write_batch(rows: DataFrame, store: str, name: str | None = None) -> str:
    """Commit rows as one batch; returns its name. A committed name changes nothing.

    The rows are written once, where they are made. Of what was written only the ids are
    shuffled, to find those that repeat; only rows of these move for the choice.
    """
    name = name or commits.new_name()
    texted = rows.withColumn("id", F.col("id").cast("string")) if "id" in rows.columns else rows
    commits.commit(texted, store, name, settle=_repeats_settled)
    return name


def _repeats_settled(rows: DataFrame) -> DataFrame | None:
    """Written rows with one row per id; none if they are so already."""
    if "id" not in rows.columns:
        return None
    ids = rows.filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id")
    n = ids.limit(BROADCAST_IDS + 1).count()
    if n == 0:
        return None
    if n > BROADCAST_IDS:
        return first_seen(rows, (ORDER, BATCH))
    met = first_seen(rows.join(F.broadcast(ids), "id", "left_semi"), (ORDER, BATCH))
    return rows.join(F.broadcast(ids), "id", "left_anti").select(met.columns).unionByName(met)


def batch_counts(
    spark: SparkSession, store: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """One row ``(added, total)``: ids that a batch brought, and ids up to it."""
    batches = commits.committed(spark, store)
    at = [b.name for b in batches].index(name)
    return merge_counts(
        sightings(spark, store, schema, batches[:at]),
        sightings(spark, store, schema, batches[at : at + 1]),
    )


def save_new(rows: DataFrame, store: str) -> DataFrame:
    """Append rows of any posting table as a batch; returns ``(added, total)``."""
    name = write_batch(rows, store)
    return batch_counts(rows.sparkSession, store, name, rows.schema)


def refresh(new_raw: DataFrame, store: str) -> DataFrame:
    """Process new raw rows, append them to the store; returns ``(added, total)``."""
    return save_new(process_postings(new_raw), store)


def _first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first sightings among ``n`` stored rows, chosen where the rows are stored.

    Ids, times and places of the rows are shuffled; the places of the chosen ones come back
    as bitmaps, a bit per stored row. A file is known by 64 bits of its path's hash.
    """
    if "id" not in rows.columns or n > BROADCAST_BITS:
        return first_seen(rows, (ORDER, BATCH), by_content=False)
    number = F.col("_metadata.row_index") + 1
    names = rows.columns
    placed = rows.select(
        "*",
        F.xxhash64("_metadata.file_path").alias("_file"),
        bucket_of(number).alias("_bucket"),
        F.bitmap_bit_position(number).alias("_bit"),
    )
    narrow = [c for c in ("id", "collected_at", ORDER, BATCH, "_file", "_bucket", "_bit") if c in placed.columns]
    chosen = (
        first_seen(placed.select(narrow), (ORDER, BATCH), by_content=False)
        .groupBy("_file", "_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_chosen"))
    )
    marked = placed.join(F.broadcast(chosen), ["_file", "_bucket"])
    return marked.filter(has_bit(F.col("_chosen"), F.col("_bit"))).select(names)


def compact(spark: SparkSession, store: str, schema: T.StructType | None = None) -> bool:
    """Replace the batches by one batch of the current rows; whether it counts.

    Rows keep the order of the batch they came with, so ties with later batches are decided
    as before. Batches committed meanwhile stay. Readers see the old batches or the new one,
    never both. Of two compactions that overlap only one counts. ``commits.vacuum`` frees
    what is replaced.
    """
    batches = commits.committed(spark, store)
    if len(batches) <= 1:
        return False
    rows = sightings(spark, store, schema, batches)
    name = commits.new_name()
    commits.commit(_first_rows(rows, sum(b.rows for b in batches)), store, name, replaces=tuple(b.name for b in batches))
    return any(b.name == name for b in commits.committed(spark, store))
