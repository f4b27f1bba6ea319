"""Choosing a salary model from a long table of predictions.

Every candidate leaves its predictions as rows (model, fold, key, actual, predicted): of each
fold by the fit without that fold, and of the held-out rows (fold null) by the fit on all
others. Metrics, comparison and choice are aggregations over that table, so they do not
depend on what kind of model made a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import CATEGORICAL_FEATURES, CV_FOLDS
from vacanta.functions.values import rounded_pounds
from vacanta.operators.features import LABEL, NUMERIC_FEATURES, fold_count, fold_of, is_holdout
from vacanta.operators.metrics import fold_scores, metric_columns
from vacanta.plans import boosted_trees
from vacanta.plans.linear_models import Sums
from vacanta.session import scratch_path

HELD_OUT = -1


@dataclass(frozen=True)
class Features:
    labels: Sequence[str] = tuple(CATEGORICAL_FEATURES)
    numbers: Sequence[str] = tuple(NUMERIC_FEATURES)
    target: str = LABEL
    key: str = "id"


def parted(table: DataFrame, features: Features, folds: int = CV_FOLDS, spare: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """The written table with ``part`` (a fold's number, or ``HELD_OUT``), and the number of folds."""
    keys, spare = [features.key], list(spare)
    path = scratch_path(table.sparkSession, "model-rows")
    table.withColumn("held", is_holdout(keys, spare=spare)).write.parquet(path)
    rows = table.sparkSession.read.parquet(path)
    parts = fold_count(rows.filter("NOT held").count(), folds)
    part = F.when(F.col("held"), HELD_OUT).otherwise(fold_of(keys, parts, spare=spare)).cast("int")
    return rows.withColumn("part", part).drop("held"), parts


# By part: the prediction for its rows of a model fitted without it and without the held-out rows.
Predictions = dict[int, Column]
Candidate = Callable[[DataFrame, int, Features], Predictions]


def linear_candidates(penalties: dict[str, float]) -> Callable[[DataFrame, int, Features], dict[str, Predictions]]:
    """Several penalties from one scan of the rows."""

    def fit(rows: DataFrame, folds: int, f: Features) -> dict[str, Predictions]:
        sums = Sums.of(rows, F.col("part"), f.labels, f.numbers, f.target)
        every = range(folds)
        return {
            name: {
                part: sums.fit([p for p in every if p != part], alpha).prediction(f.labels, f.numbers)
                for part in (*every, HELD_OUT)
            }
            for name, alpha in penalties.items()
        }

    return fit


def boosted_candidate(name: str = "boosted_trees", **options) -> Callable[[DataFrame, int, Features], dict[str, Predictions]]:
    def fit(rows: DataFrame, folds: int, f: Features) -> dict[str, Predictions]:
        return {
            name: {
                part: boosted_trees.fit(
                    rows.filter(~F.col("part").isin(part, HELD_OUT)), f.labels, f.numbers, f.target, f.key, **options
                ).prediction()
                for part in (*range(folds), HELD_OUT)
            }
        }

    return fit


DEFAULT = (linear_candidates({"linear_regression": 0.0, "ridge": 1.0}), boosted_candidate())


def predicted(
    rows: DataFrame, folds: int, features: Features, candidates: Sequence = DEFAULT
) -> tuple[DataFrame, dict[str, Predictions]]:
    """The long table of predictions, one scan of the rows, and the fitted candidates."""
    fitted: dict[str, Predictions] = {}
    for candidate in candidates:
        fitted |= candidate(rows, folds, features)

    def of_part(found: Predictions) -> Column:
        out = F.lit(None).cast("double")
        for part, value in found.items():
            out = F.when(F.col("part") == part, value).otherwise(out)
        return out

    each = F.array(
        *(F.struct(F.lit(name).alias("model"), of_part(found).alias("predicted")) for name, found in fitted.items())
    )
    long = rows.select(
        F.col(features.key).alias("key"),
        F.when(F.col("part") != HELD_OUT, F.col("part")).alias("fold"),
        F.col(features.target).alias("actual"),
        F.inline(each),
    )
    return long, fitted


def comparison(predictions: DataFrame) -> DataFrame:
    """One row per model, best first: fold scores, and metrics over the held-out rows."""
    by_fold = predictions.groupBy("model", "fold").agg(
        *(c.alias(name) for name, c in metric_columns("actual", "predicted").items())
    )
    folds = fold_scores(by_fold.filter("fold IS NOT NULL"))
    held = by_fold.filter("fold IS NULL").drop("fold")
    return held.join(folds, "model", "left").select(
        "model", "cv_r2_mean", "cv_r2_std", "mae_gbp", "rmse_gbp", "r2", "mae_log"
    ).orderBy(F.desc_nulls_last("r2"), "model")


def best_model(compared: DataFrame) -> DataFrame:
    """The first row of a comparison: greatest score on the held-out rows, then the name."""
    return compared.orderBy(F.desc_nulls_last("r2"), "model").limit(1)


def held_out_pairs(predictions: DataFrame, best: DataFrame) -> DataFrame:
    """(key, actual, predicted) in pounds, of the chosen model's held-out rows."""
    chosen = F.broadcast(best.select("model"))  # one row
    return (
        predictions.filter("fold IS NULL")
        .join(chosen, "model", "left_semi")
        .select("key", F.exp("actual").alias("actual"), F.exp("predicted").alias("predicted"))
    )


def priced(requests: DataFrame, value: Column, spread: float) -> DataFrame:
    """Requests with a model's estimate in whole pounds and the interval around it."""
    return requests.withColumns(
        {
            "predicted_salary": rounded_pounds(F.exp(value)),
            "lower_bound": rounded_pounds(F.exp(value - spread)),
            "upper_bound": rounded_pounds(F.exp(value + spread)),
        }
    )
