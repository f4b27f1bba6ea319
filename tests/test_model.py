import math
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacanta.fixed_values import CATEGORICAL_FEATURES
from vacanta.operators.features import (
    FEATURES,
    NUMERIC_FEATURES,
    feature_table,
    fill_features,
    fold_count,
    fold_of,
    is_holdout,
    model_rows,
)
from vacanta.operators.metrics import fold_scores, regression_metrics
from vacanta.plans import scoring, training
from vacanta.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    """Salaries that depend on role and skills, with some noise."""
    df = spark.range(400).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 2 == 0, "Data Analyst").otherwise("Data Engineer").alias("role_category"),
        F.when(F.col("id") % 3 == 0, "Senior").otherwise("Mid-level").alias("seniority"),
        F.when(F.col("id") % 5 > 0, "London").alias("region"),
        F.lit("permanent").alias("contract_type"),
        F.lit("full_time").alias("contract_time"),
        (F.col("id") % 7).cast("int").alias("n_skills_total"),
        (F.col("id") % 11 * 100).cast("int").alias("description_length"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100000).alias("noise"),
    )
    log = 10.5 + (F.col("id").cast("int") % 2) * 0.3 + F.col("n_skills_total") * 0.05 + F.col("noise")
    return df.withColumn("salary_midpoint", F.exp(log)).persist()


def test_model_rows(spark):
    df = spark.createDataFrame(
        [("A", None, 45000.0, "9"), ("B", "x", None, "1"), ("C", "x", 5000.0, "1"), ("D", "x", 9e5, "1")],
        "role_category string, region string, salary_midpoint double, n_skills_total string",
    )
    kept = model_rows(df).collect()
    assert [(r.role_category, r.region, r.seniority, r.n_skills_total) for r in kept] == [("A", "Unknown", "Unknown", 9.0)]
    table = feature_table(df)
    assert table.columns == [*FEATURES, "log_salary"] and len(set(FEATURES)) == len(FEATURES) == 16
    assert math.isclose(table.first().log_salary, math.log(45000))
    with pytest.raises(KeyError, match="salary_midpoint"):
        model_rows(df.drop("salary_midpoint"))


def test_rows_without_key_are_split_by_content(rows):
    none = rows.withColumn("id", F.lit(None).cast("string"))
    folds = none.groupBy(fold_of(["id"], 5, spare=["salary_midpoint"])).count().collect()
    assert len(folds) == 5 and max(r["count"] for r in folds) < 150


def test_split_depends_on_the_key_alone(rows):
    part = rows.select("id", is_holdout(["id"]).alias("h"), fold_of(["id"], 5).alias("f"))
    a = {r.id: (r.h, r.f) for r in part.collect()}
    b = {r.id: (r.h, r.f) for r in part.repartition(7).filter("id < '3'").collect()}
    assert all(a[k] == v for k, v in b.items())
    assert 50 < sum(h for h, _ in a.values()) < 110
    assert [fold_count(n) for n in (5, 29, 1000)] == [2, 2, 5]


def test_metrics(spark):
    y, p = np.log([30000.0, 50000.0, 80000.0]), np.log([33000.0, 45000.0, 80000.0])
    df = spark.createDataFrame(list(zip(map(float, y), map(float, p))), "log_salary double, prediction double")
    got = regression_metrics(df).first()
    assert got.mae_gbp == pytest.approx(8000 / 3)
    assert got.rmse_gbp == pytest.approx(math.sqrt((3000**2 + 5000**2) / 3))
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got.mae_log == pytest.approx(abs(y - p).mean())
    scores = spark.createDataFrame([("m", 0.1), ("m", 0.3)], "model string, r2 double")
    assert tuple(fold_scores(scores).first()) == ("m", pytest.approx(0.2), pytest.approx(0.1))


def test_ridge_equals_the_closed_form(rows):
    table = feature_table(rows, ("id",))
    model = training.fit(table, lambda train: training.ridge(train, 25.0))
    out = model.transform(table).select("features", "log_salary", "prediction").collect()
    x = np.array([r.features.toArray() for r in out])
    y = np.array([r.log_salary for r in out])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(x.shape[1]), xc.T @ yc)
    assert [r.prediction for r in out] == pytest.approx(list(y.mean() + xc @ w), abs=1e-6)


def test_train_save_load_score(spark, rows):
    few = {
        "linear_regression": training.linear_regression,
        "ridge": training.ridge,
        "random_forest": lambda t: training.random_forest(t, trees=3),
        "boosted_trees": lambda t: training.boosted_trees(t, rounds=2),
    }
    done = training.train(rows, few, folds=2)
    table = done.comparison.collect()
    assert {r.model for r in table} == set(few)
    assert [r.r2 for r in table] == sorted((r.r2 for r in table), reverse=True)
    assert done.best_name == table[0].model and table[0].r2 > 0.9 and table[0].cv_r2_mean > 0.9
    assert done.n_training_rows == 400
    assert done.holdout_predictions.count() == rows.filter(is_holdout(["id"])).count()

    path = scratch_path(spark, "test-model")
    assert training.load(spark, path) is None
    assert training.model_card(spark, None).count() == 0
    training.save(done, path)
    model = training.load(spark, path)
    assert (model.name, model.n_training_rows) == (done.best_name, 400)
    card = training.model_card(spark, model).first()
    assert card.name == done.best_name and card.r2 == round(table[0].r2, 3)

    requests = spark.createDataFrame(
        [
            ("a", "Data Engineer", "Senior", "London", "permanent", "full_time", ["Python", "Nope", "Python"]),
            ("b", "Never seen", "Senior", "Mars", "x", "y", None),
            ("c", None, "Senior", "London", "permanent", "full_time", ["Python"]),
            ("d", "x" * 121, "", "London", "permanent", "full_time", ["s"] * 61),
        ],
        "key string, role_category string, seniority string, region string, contract_type string, "
        "contract_time string, skills array<string>",
    )
    sound, rejected = scoring.split_requests(requests)
    scored = {r.key: r for r in scoring.score(sound, model).collect()}
    assert scored.keys() == {"a", "b"}
    a = scored["a"]
    assert a.skills_recognised == ["Python", "Python"] and a.skills_ignored == ["Nope"]
    assert 10_000 < a.lower_bound < a.predicted_salary < a.upper_bound < 500_000
    assert a.description_length == 1200 and scored["b"].skills_recognised == []
    problems = {r.key: r.problems for r in rejected.collect()}
    assert problems["c"] == ["role_category must have 1 to 120 characters"]
    assert len(problems["d"]) == 3


def test_few_rows_warn(rows):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        training.train(rows.limit(30), {"linear_regression": training.linear_regression}, folds=0)
    assert any("too few" in str(w.message) for w in seen)


def test_request_features_count_repeats(spark):
    df = spark.createDataFrame([(["Python", "Python", "AWS", "?"],)], "skills array<string>")
    row = scoring.request_features(df).first()
    assert (row.n_Programming_Languages, row.n_Cloud_Platforms, row.n_skills_total) == (2, 1, 3)
    assert set(CATEGORICAL_FEATURES).isdisjoint(NUMERIC_FEATURES)
    assert fill_features(df).first().region == "Unknown"
