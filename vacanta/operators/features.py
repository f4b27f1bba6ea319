"""Rows, features and splits for the salary model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    CATEGORICAL_FEATURES,
    CV_FOLDS,
    HOLDOUT_PERCENT,
    SPLIT_SEED,
    UNKNOWN_LABEL,
)
from vacanta.functions.skills import count_columns
from vacanta.functions.values import numeric_column, text_column
from vacanta.operators.filters import plausible_salary, with_plausible_salary

TARGET = "salary_midpoint"
LABEL = "log_salary"
NUMERIC_FEATURES = ["n_skills_total", "description_length", *count_columns()]
FEATURES = [*CATEGORICAL_FEATURES, *NUMERIC_FEATURES]


def fill_features(df: DataFrame) -> DataFrame:
    """Feature columns without gaps: 'Unknown' for labels, 0 for numbers."""
    labels = {
        name: F.coalesce(text_column(df, name), F.lit(UNKNOWN_LABEL)) for name in CATEGORICAL_FEATURES
    }
    numbers = {
        name: F.coalesce(numeric_column(df, name), F.lit(0.0)) for name in NUMERIC_FEATURES
    }
    return df.withColumns({**labels, **numbers})


def model_rows(df: DataFrame) -> DataFrame:
    """Rows with a plausible salary, features filled. Other rows are dropped."""
    if TARGET not in df.columns:
        raise KeyError(f"column {TARGET!r} is missing: process the raw postings first")
    paid = with_plausible_salary(df, TARGET).withColumn(TARGET, plausible_salary(df, TARGET))
    return fill_features(paid)


def feature_table(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The features in their fixed order and the natural log of the salary."""
    return model_rows(df).select(*keep, *FEATURES, F.ln(TARGET).alias(LABEL))


def _hashed(keys: list[str], seed: int, parts: int, spare: list[str]) -> Column:
    """A number below ``parts`` from a row's key, or from ``spare`` where it has no key."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    missing = F.lit(True)
    for key in keys:
        missing = missing & F.col(key).isNull()
    content = F.when(missing, F.xxhash64(*spare).cast("string")) if spare else F.lit("")
    texts.append(F.coalesce(content, F.lit("")))
    digest = F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(parts))


def is_holdout(
    keys: list[str],
    seed: int = SPLIT_SEED,
    percent: int = HOLDOUT_PERCENT,
    spare: list[str] | None = None,
) -> Column:
    """Whether a row is in the test part: decided by its own key alone.

    The answer does not depend on partitioning or on other rows, which a random split
    cannot promise. The parts are near, not exactly at, the given percentage. Rows
    without a key are told apart by the ``spare`` columns, so they do not all fall into
    one part.
    """
    return _hashed(keys, seed, 100, spare or []) < percent


def fold_of(
    keys: list[str], folds: int, seed: int = SPLIT_SEED, spare: list[str] | None = None
) -> Column:
    """Fold number of a row, independent of :func:`is_holdout`."""
    return _hashed(keys, seed + 1, folds, spare or [])


def fold_count(training_rows: int, wanted: int = CV_FOLDS) -> int:
    """Fewer folds for small data: at least ten rows each, at least two folds."""
    return min(wanted, max(2, training_rows // 10))
