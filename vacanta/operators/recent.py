"""The newest postings as display cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import CARD_SKILLS, POSTINGS_LIMIT_DEFAULT, POSTINGS_LIMIT_MAX
from vacanta.functions.skills import skill_list
from vacanta.functions.values import iso_date, rounded_pounds, text_column, timestamp_column
from vacanta.operators.filters import plausible_salary


def newest(
    df: DataFrame, limit: int = POSTINGS_LIMIT_DEFAULT, most: int | None = POSTINGS_LIMIT_MAX
) -> DataFrame:
    """The ``limit`` rows created last; ties by id. Rows without a date are left out.

    A ``limit`` above ``most`` is refused; None takes any.
    """
    if limit < 1 or (most is not None and limit > most):
        raise ValueError(f"limit must be within 1..{most}: {limit}")
    dated = df.withColumn("_created", timestamp_column(df, "created"))
    return (
        dated.filter(F.col("_created").isNotNull())
        .orderBy(F.desc("_created"), text_column(df, "id"))
        .limit(limit)
        .drop("_created")
    )


def posting_cards(df: DataFrame, n_skills: int = CARD_SKILLS) -> DataFrame:
    """Display form of postings, with their first ``n_skills`` skills; missing text is ''."""

    def text(name: str) -> Column:
        return F.coalesce(text_column(df, name), F.lit(""))

    skills = F.col("skills") if "skills" in df.columns else F.lit(None).cast("array<string>")
    return df.select(
        F.coalesce(F.nullif(text_column(df, "title_clean"), F.lit("")), text("title")).alias("title"),
        text("company").alias("company"),
        text("location").alias("location"),
        text("role_category").alias("role_category"),
        text("seniority").alias("seniority"),
        rounded_pounds(plausible_salary(df)).alias("salary"),
        F.slice(skill_list(skills), 1, n_skills).alias("skills"),
        iso_date(timestamp_column(df, "created")).alias("created"),
        text("redirect_url").alias("url"),
    )


def recent_postings(df: DataFrame, limit: int = POSTINGS_LIMIT_DEFAULT) -> DataFrame:
    return posting_cards(newest(df, limit))
