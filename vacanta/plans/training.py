"""Train, compare, store and load the salary regressors."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    CATEGORICAL_FEATURES,
    CV_FOLDS,
    MIN_TRAINING_ROWS,
    SPLIT_SEED,
)
from vacanta.operators.features import (
    FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    feature_table,
    fold_count,
    fold_of,
    is_holdout,
)
from vacanta.operators.metrics import fold_scores, regression_metrics
from vacanta.session import shared_folder

# What tells rows without a key apart when they are split.
SPARE = [*FEATURES, LABEL]
_COMMON = {"featuresCol": "features", "labelCol": LABEL}


def preprocessing() -> list[Estimator]:
    """One-hot labels (unseen ones give all zeros) and standardised numbers.

    The indexer puts unseen labels in an extra last slot, and the encoder drops the
    last slot. Numbers are divided by the sample deviation.
    """
    indexed = [f"{name}_index" for name in CATEGORICAL_FEATURES]
    encoded = [f"{name}_vector" for name in CATEGORICAL_FEATURES]
    return [
        StringIndexer(
            inputCols=CATEGORICAL_FEATURES,
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*encoded, "scaled"], outputCol="features"),
    ]


def linear_regression(train: DataFrame) -> Estimator:
    return LinearRegression(solver="normal", **_COMMON)


def ridge(train: DataFrame, alpha: float = 1.0) -> Estimator:
    """Squared-error loss plus ``alpha`` times the squared weights.

    Spark averages the loss over rows and scales it by the label's deviation, so the
    weight is converted with the two figures of the training part.
    """
    n, deviation = train.agg(F.count(LABEL), F.stddev_pop(LABEL)).first()
    return LinearRegression(
        solver="normal",
        elasticNetParam=0.0,
        standardization=False,
        regParam=alpha * (deviation or 0.0) / max(n, 1),
        **_COMMON,
    )


def random_forest(train: DataFrame, trees: int = 300) -> Estimator:
    return RandomForestRegressor(
        numTrees=trees, maxDepth=10, minInstancesPerNode=3, seed=SPLIT_SEED, **_COMMON
    )


def boosted_trees(train: DataFrame, rounds: int = 300) -> Estimator:
    """Gradient-boosted trees; columns are sampled per node."""
    return GBTRegressor(
        maxIter=rounds,
        maxDepth=4,
        stepSize=0.05,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=SPLIT_SEED,
        **_COMMON,
    )


Candidates = dict[str, Callable[[DataFrame], Estimator]]
CANDIDATES: Candidates = {
    "linear_regression": linear_regression,
    "ridge": ridge,
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
}


def fit(train: DataFrame, candidate: Callable[[DataFrame], Estimator]) -> PipelineModel:
    """Preprocessing and regressor fitted on ``train`` together."""
    return Pipeline(stages=[*preprocessing(), candidate(train)]).fit(train)


@dataclass
class Training:
    """Outcome of a comparison; ``comparison`` has one row per model, best first."""

    comparison: DataFrame
    best_name: str
    best_model: PipelineModel
    holdout_predictions: DataFrame
    n_training_rows: int

    @property
    def metadata(self) -> DataFrame:
        best = self.comparison.filter(F.col("model") == self.best_name)
        return best.select(
            F.col("model").alias("best_model_name"),
            F.lit(self.n_training_rows).cast("bigint").alias("n_training_rows"),
            F.struct("cv_r2_mean", "cv_r2_std", "mae_gbp", "rmse_gbp", "r2", "mae_log").alias(
                "metrics"
            ),
        )


def _best_first(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.desc("r2"), "model")


def train(
    processed: DataFrame,
    candidates: Candidates = CANDIDATES,
    folds: int = CV_FOLDS,
    keys: tuple[str, ...] = ("id",),
) -> Training:
    """Cross-validate and compare the candidates, and keep the best on the test part.

    Fits are distributed; the driver only walks over candidates and folds. The
    feature table is narrow and read by every fit, so it is kept (spilling to disk)
    until the comparison is done. Preprocessing is fitted within each fold, so the
    held-out fold has no part in it. ``folds=0`` leaves cross-validation out.
    """
    spark = processed.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        # Boosting cuts its lineage here every few rounds.
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    split = feature_table(processed, keys).withColumn(
        "_holdout", is_holdout(list(keys), spare=SPARE)
    )
    table = split.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train, n_all = table.agg(F.count_if(~F.col("_holdout")), F.count(F.lit(1))).first()
        if n_all < MIN_TRAINING_ROWS:
            warnings.warn(
                f"{n_all} rows with a salary are too few (below {MIN_TRAINING_ROWS}) "
                "for metrics to be trusted",
                stacklevel=2,
            )
        parts = fold_count(n_train, folds) if folds else 0
        training = table.filter(~F.col("_holdout"))
        holdout = table.filter("_holdout")
        folded = training.withColumn("_fold", fold_of(list(keys), max(parts, 1), spare=SPARE))
        scores, results, fitted = [], [], {}
        for name, candidate in candidates.items():
            for k in range(parts):
                model = fit(folded.filter(F.col("_fold") != k), candidate)
                tested = model.transform(folded.filter(F.col("_fold") == k))
                scores.append((name, regression_metrics(tested).first()["r2"]))
            fitted[name] = fit(training, candidate)
            row = regression_metrics(fitted[name].transform(holdout)).first()
            results.append((name, *row))
        cv = spark.createDataFrame(scores, "model string, r2 double")
        held = spark.createDataFrame(
            results, "model string, mae_gbp double, rmse_gbp double, r2 double, mae_log double"
        )
        comparison = _best_first(held.join(fold_scores(cv), "model", "left")).select(
            "model", "cv_r2_mean", "cv_r2_std", "mae_gbp", "rmse_gbp", "r2", "mae_log"
        )
        best = _best_first(held).first()["model"]
    finally:
        table.unpersist()
    predictions = fitted[best].transform(split.filter("_holdout"))
    return Training(comparison, best, fitted[best], predictions, n_all)


# --- stored models ----------------------------------------------------------------


@dataclass
class SalaryModel:
    """A fitted pipeline and the facts reported with its predictions."""

    pipeline: PipelineModel
    name: str = "unknown"
    n_training_rows: int = 0
    mae_gbp: float = 0.0
    r2: float = 0.0


def save(training: Training, path: str) -> None:
    """Pipeline, comparison (CSV) and metadata (JSON) below ``path``."""
    training.best_model.write().overwrite().save(f"{path}/pipeline")
    training.comparison.coalesce(1).write.mode("overwrite").csv(f"{path}/comparison", header=True)
    training.metadata.write.mode("overwrite").json(f"{path}/metadata")


_METADATA = (
    "best_model_name string, n_training_rows bigint, "
    "metrics struct<cv_r2_mean: double, cv_r2_std: double, mae_gbp: double, "
    "rmse_gbp: double, r2: double, mae_log: double>"
)


def load(spark: SparkSession, path: str) -> SalaryModel | None:
    """The stored model, or None if there is none. Absent metadata gives defaults."""
    try:
        spark.read.text(f"{path}/pipeline/metadata").schema
    except AnalysisException:
        return None
    pipeline = PipelineModel.load(f"{path}/pipeline")
    try:
        card = spark.read.schema(_METADATA).json(f"{path}/metadata").first()
    except AnalysisException:
        card = None
    if card is None:
        return SalaryModel(pipeline)
    metrics = card["metrics"].asDict() if card["metrics"] else {}
    return SalaryModel(
        pipeline,
        card["best_model_name"] or "unknown",
        card["n_training_rows"] or 0,
        metrics.get("mae_gbp") or 0.0,
        metrics.get("r2") or 0.0,
    )


def model_card(spark: SparkSession, model: SalaryModel | None) -> DataFrame:
    """One row about the model; no row when there is none."""
    rows = [] if model is None else [(model.name, model.n_training_rows, model.mae_gbp, model.r2)]
    facts = spark.createDataFrame(
        rows, "name string, n_training_rows bigint, mae_gbp double, r2 double"
    )
    return facts.select(
        "name",
        "n_training_rows",
        F.bround("mae_gbp", 0).cast("bigint").alias("mae_gbp"),
        F.bround("r2", 3).alias("r2"),
    )
