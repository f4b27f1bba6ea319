import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacanta.plans import boosted_trees, model_choice
from vacanta.plans.linear_models import Sums


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for i in range(240):
        role, place = rng.choice(["A", "B", "C"]), rng.choice(["x", "y", "rare" if i % 60 == 0 else "y"])
        n, size = rng.randint(0, 6), rng.uniform(100, 900)
        y = 10 + {"A": 0, "B": 0.4, "C": 0.9}[role] + 0.1 * n + size / 2000 + rng.gauss(0, 0.1)
        out.append((str(i), role, place, float(n), size, y, i % 4))
    kind = "id string, role string, place string, n double, size double, y double, part int"
    return spark.createDataFrame(out, kind).repartition(3).cache()


LABELS, NUMBERS = ("role", "place"), ("n", "size")


def plain_design(known, tested):
    """One-hot labels and scaled numbers, as fitted on the known rows."""
    columns, rest = [], []
    for name in LABELS:
        for value in sorted({r[name] for r in known}):
            columns.append([float(r[name] == value) for r in known])
            rest.append([float(r[name] == value) for r in tested])
    for name in NUMBERS:
        v = np.array([r[name] for r in known])
        columns.append((v - v.mean()) / v.std(ddof=1))
        rest.append((np.array([r[name] for r in tested]) - v.mean()) / v.std(ddof=1))
    return np.array(columns).T, np.array(rest).T


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_folds_from_sums_equal_separate_fits(rows, alpha):
    sums = Sums.of(rows, F.col("part"), LABELS, NUMBERS, "y")
    every = rows.collect()
    for fold in range(4):
        known, tested = [r for r in every if r.part != fold], [r for r in every if r.part == fold]
        x, xt = plain_design(known, tested)
        y, yt = (np.array([r.y for r in part]) for part in (known, tested))
        centred = x - x.mean(axis=0)
        if alpha:
            w = np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
        else:
            w = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
        want = y.mean() + (xt - x.mean(axis=0)) @ w
        model = sums.fit([p for p in range(4) if p != fold], alpha)
        got = rows.filter(F.col("part") == fold).select("id", model.prediction(LABELS, NUMBERS).alias("p"))
        got = dict(map(tuple, got.collect()))
        seen = {v for r in known for v in (r.role, r.place)}
        for r, p in zip(tested, want, strict=True):
            if alpha or {r.role, r.place} <= seen:
                assert got[r.id] == pytest.approx(p, abs=1e-7)
        if all({r.role, r.place} <= seen for r in tested):
            r2 = 1 - ((yt - want) ** 2).sum() / ((yt - yt.mean()) ** 2).sum()
            assert sums.r2(model, [fold]) == pytest.approx(r2, abs=1e-6)


def test_all_folds_and_penalties_read_the_rows_once(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    from vacanta.plans.linear_models import products

    plan = products(stored, F.col("part"), LABELS, NUMBERS, "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_sum" in plan


def test_no_rows_and_no_spread(spark, rows):
    none = Sums.of(rows.limit(0), F.col("part"), LABELS, NUMBERS, "y")
    assert none.fit([0]).intercept == 0.0
    same = rows.withColumn("y", F.lit(3.0)).withColumn("n", F.lit(1.0))
    sums = Sums.of(same, F.col("part"), LABELS, NUMBERS, "y")
    model = sums.fit([0, 1], 1.0)
    assert model.intercept == pytest.approx(3.0) and sums.r2(model, [2]) is None


def plain_boosting(rows, rounds, depth, rate, key="id"):
    """The same trees by trying every split over the rows."""
    base = np.mean([r["y"] for r in rows])
    predicted = {r["id"]: base for r in rows}
    for number in range(rounds):
        columns = boosted_trees.sampled_columns([*LABELS, *NUMBERS], number, 0.8)
        import hashlib

        drawn = [r for r in rows if int(hashlib.md5(f"{r['id']}|{number}".encode()).hexdigest()[:8], 16) % 100 < 80]
        splits = [(c, v) for c in columns for v in sorted({r[c] for r in rows})]

        def left(r, c, v):
            return r[c] != v if c in LABELS else r[c] <= v

        def grow(some, level):
            def weight(part):
                return -sum(predicted[r["id"]] - r["y"] for r in part) / (len(part) + 1.0)

            def score(part):
                return sum(predicted[r["id"]] - r["y"] for r in part) ** 2 / (len(part) + 1.0)

            best = None
            if level < depth:
                for c, v in splits:
                    a = [r for r in some if left(r, c, v)]
                    b = [r for r in some if not left(r, c, v)]
                    if a and b:
                        gain = round(score(a) + score(b) - score(some), 9)
                        rank = (-gain, c, v if c in LABELS else "", 0.0 if c in LABELS else v)
                        if gain > 0 and (best is None or rank < best[0]):
                            best = rank, c, v, a, b
            if best is None:
                w = weight(some) if level else 0.0
                return lambda r: w
            _, c, v, a, b = best
            fa, fb = grow(a, level + 1), grow(b, level + 1)
            return lambda r: fa(r) if left(r, c, v) else fb(r)

        tree = grow(drawn, 0)
        for r in rows:
            predicted[r["id"]] += rate * tree(r)
    return predicted


@pytest.mark.parametrize("written_every", [1, 5])
def test_boosting_equals_trying_every_split(rows, monkeypatch, written_every):
    monkeypatch.setattr(boosted_trees, "WRITE_EVERY", written_every)
    model = boosted_trees.fit(rows, LABELS, NUMBERS, "y", "id", rounds=3, depth=3, rate=0.3)
    got = dict(map(tuple, rows.select("id", model.prediction()).collect()))
    want = plain_boosting([r.asDict() for r in rows.collect()], 3, 3, 0.3)
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_boosting_learns_with_few_bins(rows):
    model = boosted_trees.fit(rows, LABELS, NUMBERS, "y", "id", rounds=25, rate=0.3, bins=8)
    errors = rows.select((F.col("y") - model.prediction()).alias("e")).agg(F.stddev_pop("e"), F.stddev_pop("e")).first()[0]
    spread = rows.agg(F.stddev_pop("y")).first()[0]
    assert errors < 0.35 * spread
    assert boosted_trees.fit(rows.limit(0), LABELS, NUMBERS, "y", "id", rounds=2).prediction() is not None


def test_choice_from_the_long_table(spark):
    rows = [("a", None, str(i), float(i), i + 0.1) for i in range(6)] + [("b", None, str(i), float(i), i + 0.5) for i in range(6)]
    rows += [("a", k, str(i), float(i), i + 0.1 * (k + 1)) for k in range(2) for i in range(4)]
    long = spark.createDataFrame(rows, "model string, fold int, key string, actual double, predicted double")
    compared = model_choice.comparison(long)
    a, b = compared.collect()
    assert (a.model, b.model) == ("a", "b") and b.cv_r2_mean is None
    assert a.r2 == pytest.approx(1 - 0.06 / 17.5)
    scores = [1 - 4 * d * d / 5 for d in (0.1, 0.2)]
    assert a.cv_r2_mean == pytest.approx(np.mean(scores)) and a.cv_r2_std == pytest.approx(np.std(scores))
    best = model_choice.best_model(compared)
    pairs = model_choice.held_out_pairs(long, best).collect()
    assert len(pairs) == 6 and pairs[0].predicted == pytest.approx(np.exp(np.log(pairs[0].actual) + 0.1))
