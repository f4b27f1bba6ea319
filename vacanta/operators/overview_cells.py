"""Headline totals under any filter, from a table of cells instead of the postings.

A cell is one combination of the filter columns. It keeps how many postings it has, how
many with a plausible salary, the numbers of its companies as bitmaps, and its salaries
with their counts. Cells merge: sums add up, bitmaps unite, salary counts make exact
quantiles. So a filtered report reads neither postings nor company names, and distinct
companies are counted exactly whatever cells a filter takes together.

Bitmaps lie in buckets of 32,768 companies, so no row grows with the number of companies;
cells number at most the combinations that occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.fixed_values import FILTER_COLUMNS
from vacanta.functions.values import rounded_pounds, text_column
from vacanta.operators.bitmaps import bitmap_of, bucket_of, count_union
from vacanta.operators.filters import SALARY_BOUNDS, Selections, apply_filters, plausible_salary
from vacanta.operators.quantiles import quantiles, slot_profile, weighted_counts

BROADCAST = 200_000


def build(postings: DataFrame, path: str, salary: str = "salary_midpoint") -> None:
    """The cells of a posting table below ``path``, which must be free."""
    spark = postings.sparkSession
    rows = postings.select(
        *(text_column(postings, n).alias(n) for n in FILTER_COLUMNS),
        text_column(postings, "company").alias("company"),
        plausible_salary(postings, salary).alias("salary"),
    )
    names = rows.select("company").filter("company IS NOT NULL").distinct()
    names.withColumn("number", F.monotonically_increasing_id() + 1).write.parquet(f"{path}/companies")
    companies = spark.read.parquet(f"{path}/companies")
    some = F.broadcast(companies) if companies.count() <= BROADCAST else companies
    (
        rows.join(some, "company", "left")
        .groupBy(*FILTER_COLUMNS, bucket_of(F.col("number")).alias("bucket"))
        .agg(bitmap_of(F.col("number")).alias("bitmap"), F.count(F.lit(1)).alias("postings"), F.count("salary").alias("paid"))
        .write.parquet(f"{path}/cells")
    )
    (
        rows.filter("salary IS NOT NULL")
        .groupBy(*FILTER_COLUMNS, "salary")
        .agg(F.count(F.lit(1)).alias("n"))
        .write.parquet(f"{path}/salaries")
    )


def totals(spark: SparkSession, path: str, selections: Selections) -> DataFrame:
    """One row as of :func:`vacanta.operators.counts.overview_totals`, for the selected postings."""
    cells = apply_filters(spark.read.parquet(f"{path}/cells"), selections)
    paid = apply_filters(spark.read.parquet(f"{path}/salaries"), selections)
    counts = weighted_counts(paid, [], "salary", "n", SALARY_BOUNDS)
    middle = quantiles(counts, slot_profile(counts, []), [], {"median": 0.5}).select("median").scalar()
    companies = count_union(cells.filter("bucket IS NOT NULL"))
    found = cells.agg(
        F.coalesce(F.sum("postings"), F.lit(0)).alias("postings"),
        F.count_distinct("location").alias("locations"),
        F.sum("paid").alias("paid"),
    )
    coverage = F.bround(F.try_divide("paid", "postings"), 4)
    return found.select(
        "postings",
        companies.cast("bigint").alias("companies"),
        "locations",
        F.coalesce(coverage, F.lit(0.0)).alias("salary_coverage"),
        rounded_pounds(middle).alias("median_salary"),
    )
