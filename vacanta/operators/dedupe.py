"""First-seen dedupe, merge of new postings and what a merge adds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacanta.functions.values import timestamp_column

RANK = "source_rank"


def first_seen(
    df: DataFrame, rank: str | Sequence[str] | None = None, by_content: bool = True
) -> DataFrame:
    """One row per id, the one collected earliest.

    Ids compare as text. Equal times are decided by the ``rank`` columns (lower wins:
    stored rows before new ones), then by content, so the choice does not depend on
    how the rows are spread. ``by_content=False`` says that time and rank decide alone;
    then no other column is read for the choice. Spark keeps only the best row per id and
    input partition before it shuffles, so an id seen very often moves few rows.

    Rows without an id are all kept: nothing tells whether they are the same advert. They
    get a key of their own, so the table is scanned once. A table without an id column is
    returned as it is.
    """
    if "id" not in df.columns:
        return df
    ranks = [rank] if isinstance(rank, str) else list(rank or ())
    texted = df.withColumn("id", F.col("id").cast("string"))
    order = [timestamp_column(texted, "collected_at").asc_nulls_last()]
    order += [F.col(name).asc_nulls_last() for name in ranks]
    content = [name for name in texted.columns if name not in ("id", *ranks)]
    if content and by_content:
        order.append(F.xxhash64(*content))
    alone = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    one = Window.partitionBy("id", "_alone").orderBy(*order)
    return (
        texted.withColumn("_alone", alone)
        .withColumn("_place", F.row_number().over(one))
        .filter(F.col("_place") == 1)
        .drop("_place", "_alone")
    )


def merge_postings(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new rows as one table, first seen per id; columns match by name."""
    ranked = existing.withColumn(RANK, F.lit(0)).unionByName(
        new.withColumn(RANK, F.lit(1)), allowMissingColumns=True
    )
    return first_seen(ranked, RANK).drop(RANK)


def new_ids(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct ids of ``new`` that ``existing`` lacks."""
    found = new.select(F.col("id").cast("string").alias("id")).filter("id IS NOT NULL").distinct()
    return found.join(
        existing.select(F.col("id").cast("string").alias("id")), "id", "left_anti"
    )


def merge_counts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """One row ``(added, total)`` of the merge, counted from ids alone.

    Rows are reduced to one per id and input partition before the shuffle. Both
    numbers count rows without an id one by one, as the merge keeps them.
    """

    def marked(df: DataFrame, stored: bool) -> DataFrame:
        return df.select(F.col("id").cast("string").alias("id"), F.lit(stored).alias("_stored"))

    per_id = (
        marked(existing, True)
        .unionByName(marked(new, False))
        .groupBy("id")
        .agg(
            F.max("_stored").alias("_stored"),
            F.count_if(~F.col("_stored")).alias("_new"),
            F.count_if(F.col("_stored")).alias("_old"),
        )
    )
    no_id = F.col("id").isNull()
    after = F.when(no_id, F.col("_new") + F.col("_old")).otherwise(1)
    fresh = F.when(no_id, F.col("_new")).when(F.col("_stored"), 0).otherwise(1)
    return per_id.agg(
        F.coalesce(F.sum(fresh), F.lit(0)).cast("bigint").alias("added"),
        F.coalesce(F.sum(after), F.lit(0)).cast("bigint").alias("total"),
    )
