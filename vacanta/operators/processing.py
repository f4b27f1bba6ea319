"""Raw postings to processed postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import SKILL_DICTIONARY
from vacanta.functions.skills import Dictionary, category_counts, skills_in
from vacanta.functions.text import bind, clean_description, clean_title
from vacanta.functions.titles import role_category, seniority
from vacanta.functions.values import numeric_column, text_column
from vacanta.sources.schema import require_columns


def add_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """Role and seniority of the titles in column ``title``."""
    return df.withColumns(
        {"role_category": role_category(F.col(title)), "seniority": seniority(F.col(title))}
    )


def add_category_counts(
    df: DataFrame, skills: str = "skills", dictionary: Dictionary = SKILL_DICTIONARY
) -> DataFrame:
    return df.withColumns(category_counts(F.col(skills), dictionary))


def add_salary_midpoint(df: DataFrame) -> DataFrame:
    """Salary bounds as numbers, and the mean of those that exist."""
    bounds = df.withColumns({n: numeric_column(df, n) for n in ("salary_min", "salary_max")})
    both = F.struct("salary_min", "salary_max")

    def mean(pair: Column) -> Column:
        low, high = pair["salary_min"], pair["salary_max"]
        return F.coalesce((low + high) / 2, low, high)

    return bounds.withColumn("salary_midpoint", bind(both, mean))


def process_postings(
    raw: DataFrame, source: str = "raw postings", dictionary: Dictionary = SKILL_DICTIONARY
) -> DataFrame:
    """Clean, classify and tag: one narrow stage, no shuffle and no Python worker.

    Columns that a query does not use are never computed, so the same definition
    serves a salary report (no text work) and a full rewrite of the table.
    """
    require_columns(raw, source)
    cleaned = raw.withColumns(
        {
            "title_clean": clean_title(text_column(raw, "title")),
            "description_clean": clean_description(text_column(raw, "description")),
        }
    )
    derived = cleaned.withColumns(
        {
            "description_length": F.length("description_clean"),
            "role_category": role_category(F.col("title_clean")),
            "seniority": seniority(F.col("title_clean")),
            "skills": skills_in(F.col("description_clean"), dictionary),
        }
    )
    return add_salary_midpoint(add_category_counts(derived, "skills", dictionary))
