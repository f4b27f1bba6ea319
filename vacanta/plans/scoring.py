"""Salary estimates for hypothetical postings, in batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    INTERVAL_LOG_SPREAD,
    REQUEST_LENGTH_DEFAULT,
    REQUEST_LENGTH_MAX,
    REQUEST_SKILLS_MAX,
    REQUEST_TEXT_LIMITS,
    SKILL_DICTIONARY,
)
from vacanta.functions.skills import Dictionary, category_counts, ignored, recognised, skill_list
from vacanta.functions.values import rounded_pounds
from vacanta.plans.training import SalaryModel


def with_defaults(requests: DataFrame) -> DataFrame:
    """Optional request fields filled: no skills, and the usual description length."""

    def given(name: str, kind: str) -> Column:
        present = F.col(name) if name in requests.columns else F.lit(None)
        return present.cast(kind)

    return requests.withColumns(
        {
            **{n: given(n, "string") for n in REQUEST_TEXT_LIMITS},
            "skills": skill_list(given("skills", "array<string>")),
            "description_length": F.coalesce(
                given("description_length", "bigint"), F.lit(REQUEST_LENGTH_DEFAULT)
            ),
        }
    )


def request_problems(requests: DataFrame) -> DataFrame:
    """Requests with a column ``problems`` listing what is out of bounds."""
    filled = with_defaults(requests)
    checks = [
        F.when(
            F.col(name).isNull() | ~F.length(name).between(1, most),
            F.lit(f"{name} must have 1 to {most} characters"),
        )
        for name, most in REQUEST_TEXT_LIMITS.items()
    ]
    checks += [
        F.when(F.size("skills") > REQUEST_SKILLS_MAX, F.lit(f"more than {REQUEST_SKILLS_MAX} skills")),
        F.when(
            ~F.col("description_length").between(0, REQUEST_LENGTH_MAX),
            F.lit(f"description_length must be within 0..{REQUEST_LENGTH_MAX}"),
        ),
    ]
    return filled.withColumn("problems", F.array_compact(F.array(*checks)))


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests that can be scored, and rejected ones with their problems."""
    checked = request_problems(requests)
    sound = F.size("problems") == 0
    return checked.filter(sound).drop("problems"), checked.filter(~sound)


def request_features(requests: DataFrame, dictionary: Dictionary = SKILL_DICTIONARY) -> DataFrame:
    """Recognised and ignored skills, and the counts the model wants.

    Only recognised skills count; naming one twice counts twice.
    """
    known = recognised(F.col("skills"), dictionary)
    return requests.withColumns(
        {
            "skills_recognised": known,
            "skills_ignored": ignored(F.col("skills"), dictionary),
            **category_counts(known, dictionary),
        }
    )


def score(
    requests: DataFrame, model: SalaryModel, dictionary: Dictionary = SKILL_DICTIONARY
) -> DataFrame:
    """Estimate and interval in whole pounds for sound requests."""
    added = {
        "predicted_salary": 0.0,
        "lower_bound": -INTERVAL_LOG_SPREAD,
        "upper_bound": INTERVAL_LOG_SPREAD,
    }
    predicted = model.pipeline.transform(request_features(requests, dictionary))
    priced = reduce(
        lambda df, item: df.withColumn(
            item[0], rounded_pounds(F.exp(F.col("prediction") + F.lit(item[1])))
        ),
        added.items(),
        predicted,
    )
    return priced.select(
        *requests.columns,
        *added,
        F.lit(model.name).alias("model_name"),
        F.lit(model.n_training_rows).alias("n_training_rows"),
        F.bround(F.lit(model.mae_gbp), 0).alias("mae_gbp"),
        F.bround(F.lit(model.r2), 3).alias("r2"),
        "skills_recognised",
        "skills_ignored",
    )
