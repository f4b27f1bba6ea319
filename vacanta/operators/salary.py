"""Salary reports: box plots, histogram and pay by skill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    HISTOGRAM_BUCKETS,
    PAY_BY_SKILL_LIMIT,
    PAY_BY_SKILL_MIN_POSTINGS,
)
from vacanta.functions.values import rounded_pounds, text_column
from vacanta.operators.demand import exploded
from vacanta.operators.filters import SALARY_BOUNDS, plausible_salary, with_plausible_salary
from vacanta.operators.quantiles import box_plots, medians

NULL_LABEL = "nan"


def salary_distribution(
    df: DataFrame, group: str, salary: str = "salary_midpoint", null_label: str = NULL_LABEL
) -> DataFrame:
    """Box plot of plausible salaries per label of ``group``; salary-less labels drop out.

    A table without the column ``group`` has no labels and gives no rows.
    """
    rows = with_plausible_salary(df, salary)
    if group not in df.columns:
        rows = rows.filter(F.lit(False))
    labelled = rows.select(
        F.coalesce(text_column(df, group), F.lit(null_label)).alias("label"),
        plausible_salary(df, salary).alias("_salary"),
    )
    return box_plots(labelled, ["label"], "_salary", SALARY_BOUNDS)


def richest_first(distribution: DataFrame) -> DataFrame:
    """Order of the report: one row per label, so a small sort."""
    return distribution.orderBy(F.desc("median"), "label")


def salary_box(df: DataFrame, salary: str = "salary_midpoint") -> DataFrame:
    """Box plot of all plausible salaries as one row; no row when there are none."""
    everything = with_plausible_salary(df, salary).select(F.lit("all").alias("_all"), plausible_salary(df, salary).alias("_salary"))
    return box_plots(everything, ["_all"], "_salary", SALARY_BOUNDS).drop("_all")


def salary_histogram(
    df: DataFrame, buckets: int = HISTOGRAM_BUCKETS, salary: str = "salary_midpoint"
) -> DataFrame:
    """Equal-width, right-closed buckets over the plausible salaries, empty ones kept.

    The edges run from the smallest to the largest salary, the first one lowered by a
    thousandth of the range so that it holds the smallest. If all salaries are equal,
    both ends move out by a thousandth of the value instead. Edges come from a one-row
    scalar subquery and the counts from one aggregate row, so nothing is joined.
    """
    salaries = with_plausible_salary(df, salary).select(plausible_salary(df, salary).alias("_v"))
    return histogram_of(salaries.withColumn("_n", F.lit(1).cast("bigint")), buckets)


def histogram_of(salaries: DataFrame, buckets: int = HISTOGRAM_BUCKETS) -> DataFrame:
    """``salary_histogram`` of values ``_v`` that occur ``_n`` times."""
    low, high = F.min("_v"), F.max("_v")
    same = low == high
    start = F.when(same, low - F.abs(low) * 0.001).otherwise(low)
    stop = F.when(same, high + F.abs(high) * 0.001).otherwise(high)
    inner = [start + F.lit(i) * ((stop - start) / buckets) for i in range(1, buckets)]
    first = F.when(same, start).otherwise(low - (high - low) * 0.001)
    edges = salaries.agg(F.array(first, *inner, stop).alias("edges")).scalar()

    # The subquery is evaluated once; each row is compared with its 25 numbers.
    placed = salaries.select("_v", "_n", edges.alias("_edges")).select(
        F.size(F.filter("_edges", lambda edge: edge < F.col("_v"))).alias("_bucket"), "_n"
    )
    counted = placed.agg(
        F.array(
            *[F.coalesce(F.sum(F.when(F.col("_bucket") == i + 1, F.col("_n"))), F.lit(0)) for i in range(buckets)]
        ).alias("counts"),
        F.count(F.lit(1)).alias("all"),
    ).filter(F.col("all") > 0)
    bounded = counted.select("counts", edges.alias("edges"))
    return bounded.select(
        F.posexplode("counts").alias("bucket", "count"), "edges"
    ).select(
        "bucket",
        rounded_pounds(F.get("edges", F.col("bucket"))).alias("lower"),
        rounded_pounds(F.get("edges", F.col("bucket") + 1)).alias("upper"),
        "count",
    )


def pay_by_skill(
    df: DataFrame,
    limit: int = PAY_BY_SKILL_LIMIT,
    least: int = PAY_BY_SKILL_MIN_POSTINGS,
    salary: str = "salary_midpoint",
) -> DataFrame:
    """Median salary of the ``limit`` skills with most salaried postings.

    The counts per skill and value serve both the sizes and the medians, so the lists
    are read and exploded once. A table without skills gives no rows.
    """
    listed = F.col("skills") if "skills" in df.columns else F.array().cast("array<string>")
    paid = with_plausible_salary(df, salary).select(
        listed.alias("skills"), plausible_salary(df, salary).alias("_salary")
    )
    pairs = paid.select(exploded("skills"), "_salary").filter(F.col("skill").isNotNull())
    return best_paid(medians(pairs, ["skill"], "_salary", SALARY_BOUNDS), limit, least)


def best_paid(
    by_skill: DataFrame, limit: int = PAY_BY_SKILL_LIMIT, least: int = PAY_BY_SKILL_MIN_POSTINGS
) -> DataFrame:
    """Of ``(skill, median, count)`` the largest skills, best paid first."""
    largest = (
        by_skill.filter(F.col("count") >= least)
        .orderBy(F.desc("count"), "skill")
        .limit(limit)
    )
    return largest.orderBy(F.desc("median"), "skill").select(
        "skill",
        rounded_pounds(F.col("median")).alias("median_salary"),
        F.col("count").alias("postings"),
    )
