"""Headline totals, value counts and counts over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import TOP_LOCATIONS
from vacanta.functions.values import (
    bucket_start,
    iso_date,
    rounded_pounds,
    text_column,
    timestamp_column,
)
from vacanta.operators.filters import SALARY_BOUNDS, plausible_salary
from vacanta.operators.quantiles import medians


def overview_totals(df: DataFrame, salary: str = "salary_midpoint") -> DataFrame:
    """One row: postings, companies, locations, salary coverage and median salary."""
    base = df.select(
        text_column(df, "company").alias("company"),
        text_column(df, "location").alias("location"),
        plausible_salary(df, salary).alias("_salary"),
    )
    middle = medians(base, [], "_salary", SALARY_BOUNDS).select("median").scalar()
    totals = base.agg(
        F.count(F.lit(1)).alias("postings"),
        F.count_distinct("company").alias("companies"),
        F.count_distinct("location").alias("locations"),
        F.count("_salary").alias("_with_salary"),
    )
    coverage = F.bround(F.try_divide("_with_salary", "postings"), 4)
    return totals.select(
        "postings",
        "companies",
        "locations",
        F.coalesce(coverage, F.lit(0.0)).alias("salary_coverage"),
        rounded_pounds(middle).alias("median_salary"),
    )


def value_counts(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """``(label, count)``, most frequent first, ties by label; null labels left out."""
    counts = (
        df.select(text_column(df, name).alias("label"))
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    ordered = counts.orderBy(F.desc("count"), "label")
    return ordered if limit is None else ordered.limit(limit)


def top_locations(df: DataFrame, limit: int = TOP_LOCATIONS) -> DataFrame:
    return value_counts(df, "location", limit)


def value_counts_of(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(dimension, label, count)`` of several columns from one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), text_column(df, name).alias("label"))
            for name in names
        ]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("label").isNotNull())
        .groupBy("dimension", "label")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def period_counts(df: DataFrame, date: str = "created", freq: str = "W") -> DataFrame:
    """``(period, count)`` per week, month or day; unreadable dates left out."""
    return (
        df.select(bucket_start(timestamp_column(df, date), freq).alias("period"))
        .filter(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(iso_date(F.col("period")).alias("period"), "count")
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: rows, and the first and last collection day."""
    seen = timestamp_column(df, "collected_at")
    return df.select(seen.alias("_seen")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        iso_date(F.min("_seen")).alias("collected_from"),
        iso_date(F.max("_seen")).alias("collected_to"),
    )


def processing_summary(df: DataFrame, salary: str = "salary_midpoint") -> DataFrame:
    """One row: rows, rows with a salary of any size, and their share."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(salary).alias("with_salary"),
    ).withColumn("salary_share", F.bround(F.try_divide("with_salary", "rows"), 4))


def health(
    df: DataFrame | None, model_loaded: bool = False, spark=None, detail: str = "no postings are stored yet"
) -> DataFrame:
    """One row: whether there is data and a model, and how complete the columns are.

    ``df`` is None when there is no stored table yet: the state is then degraded, and
    ``detail`` says why. A sound state has no detail.
    """
    if df is None:
        return spark.range(1).select(
            F.lit("degraded").alias("status"),
            F.lit(0).cast("bigint").alias("dataset_rows"),
            F.lit(model_loaded).alias("model_loaded"),
            F.lit(detail).alias("detail"),
        )
    watched = [n for n in ("id", "company", "region", "contract_type", "created") if n in df.columns]
    return df.agg(
        F.lit("ok").alias("status"),
        F.count(F.lit(1)).alias("dataset_rows"),
        F.lit(model_loaded).alias("model_loaded"),
        F.lit(None).cast("string").alias("detail"),
        *[
            F.bround(F.try_divide(F.count_if(F.col(n).isNull()), F.count(F.lit(1))), 4).alias(
                f"null_share_{n}"
            )
            for n in watched
        ],
    )
