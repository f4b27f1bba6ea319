"""Text search by posting lists of trigrams.

``build`` numbers the rows, writes them in that order with the text that is searched, and
writes for every trigram the numbers of the rows that have it, as bitmaps of 32,768
rows each, sorted by trigram. A search reads the lists of its query's trigrams only,
intersects them bucket by bucket, and compares the texts of the rows that are left. Of few
candidates the scan gets the ranges of row numbers they lie in, and opens only the pages of
these; many meet the texts by a join. A trigram that a third of all rows have is so many bitmaps, never one list.
Queries of fewer than three characters have no trigram: they look at all texts.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.operators.bitmaps import bitmap_of, bucket_of, members
from vacanta.operators.filters import searched_text

GRAM = 3
NAMED = 2_000  # of so many candidates the scan gets ranges
RANGES = 40
BROADCAST = 500_000

ROW, TEXT = "search_row", "search_text"


def build(postings: DataFrame, path: str) -> None:
    """The index of a posting table below ``path``, which must be free. All columns are kept."""
    spark = postings.sparkSession
    postings.select(
        (F.monotonically_increasing_id() + 1).alias(ROW), searched_text(postings).alias(TEXT), *postings.columns
    ).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows").select(ROW, TEXT)
    places = F.sequence(F.lit(1), F.length(TEXT) - (GRAM - 1))
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(TEXT, i, F.lit(GRAM))))
    (
        rows.filter(F.length(TEXT) >= GRAM)
        .select(F.explode(grams).alias("gram"), ROW)
        .groupBy("gram", bucket_of(F.col(ROW)).alias("bucket"))
        .agg(bitmap_of(F.col(ROW)).alias("rows"))
        .repartitionByRange("gram", "bucket")
        .sortWithinPartitions("gram", "bucket")
        .write.parquet(f"{path}/grams")
    )


def candidates(spark: SparkSession, path: str, wanted: str) -> DataFrame:
    """(bucket, rows): bitmaps of the rows that have all trigrams of ``wanted``."""
    grams = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    return (
        spark.read.parquet(f"{path}/grams")
        .filter(F.col("gram").isin(grams))
        .groupBy("bucket")
        .agg(F.bitmap_and_agg("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") == len(grams)) & (F.bitmap_count("rows") > 0))
        .select("bucket", "rows")
    )


def ranges(numbers: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold the sorted numbers, cut at the widest gaps."""
    widest = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[: most - 1]
    cuts = [0, *sorted(widest), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def search(spark: SparkSession, path: str, query: str) -> DataFrame:
    """The rows whose searched text contains ``query``, in any case; all for a blank one."""
    rows = spark.read.parquet(f"{path}/rows")
    wanted = query.strip().lower()
    matching = rows.filter(F.contains(F.col(TEXT), F.lit(wanted)))
    if not wanted or len(wanted) < GRAM:
        return (matching if wanted else rows).drop(ROW, TEXT)
    found = candidates(spark, path, wanted)
    n = found.agg(F.coalesce(F.sum(F.bitmap_count("rows")), F.lit(0))).first()[0]
    numbers = found.select(F.explode(members(F.col("rows"), F.col("bucket"))).alias(ROW))
    if n <= NAMED:
        near = ranges(sorted(r[0] for r in numbers.collect()))
        held = reduce(or_, (F.col(ROW).between(a, b) for a, b in near), F.lit(False))
        return matching.filter(held).drop(ROW, TEXT)
    some = F.broadcast(numbers) if n <= BROADCAST else numbers
    return matching.join(some, ROW, "left_semi").drop(ROW, TEXT)
