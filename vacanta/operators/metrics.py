"""Regression metrics as one aggregate over (label, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(actual: str, predicted: str) -> dict[str, Column]:
    """Errors in pounds after ``exp`` and on the log scale the model works on."""
    y, p = F.col(actual), F.col(predicted)
    pounds = F.exp(p) - F.exp(y)
    residual = p - y
    spread = F.var_pop(y) * F.count(y)
    return {
        "mae_gbp": F.avg(F.abs(pounds)),
        "rmse_gbp": F.sqrt(F.avg(pounds * pounds)),
        "r2": 1 - F.try_divide(F.sum(residual * residual), spread),
        "mae_log": F.avg(F.abs(residual)),
    }


def regression_metrics(
    df: DataFrame, actual: str = "log_salary", predicted: str = "prediction"
) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in metric_columns(actual, predicted).items()])


def fold_scores(scores: DataFrame, score: str = "r2") -> DataFrame:
    """Mean and population deviation of the fold scores, per model."""
    return scores.groupBy("model").agg(
        F.avg(score).alias("cv_r2_mean"), F.stddev_pop(score).alias("cv_r2_std")
    )


def actual_and_predicted(
    df: DataFrame, actual: str = "log_salary", predicted: str = "prediction"
) -> DataFrame:
    """Pairs in pounds, for a predicted-versus-actual plot."""
    return df.select(F.exp(actual).alias("actual"), F.exp(predicted).alias("predicted"))
