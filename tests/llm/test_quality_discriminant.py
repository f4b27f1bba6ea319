import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import SMALL, prose
from vacanta.llm import quality_discriminant
from vacanta.llm.queries import JOBS


def labelled(workers, n=400):
    """Prose, and prose that is shouted, marked up or repeated."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = prose(i, rng.randint(20, 200)).split()
        bad = i % 4 == 0
        if bad:
            kind = rng.randrange(3)
            words = [[w.upper() + "!!", w + "***", words[k // 9 * 9]][kind] for k, w in enumerate(words)]
        rows.append((i, " ".join(words), int(not bad)))
    return workers.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_rows_are_told_apart(workers):
    rows = labelled(workers)
    found = quality_discriminant.measured(rows, keep=("doc_id", "quality"))
    model = quality_discriminant.train(rows.filter("doc_id < 300"), found.drop("quality"))
    scored = quality_discriminant.scored(found.filter("doc_id >= 300"), model, keep=("doc_id", "quality")).collect()
    good = [r.score for r in scored if r.quality]
    bad = [r.score for r in scored if not r.quality]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert all(0 <= r.score <= 1 for r in scored)


def plain_model(x, y, pooled, round_):
    """Densities by determinants and inverses of the shrunk covariances."""
    within = sum((y == k).sum() * np.cov(x[y == k], rowvar=False, bias=True) for k in (0, 1)) / len(y)
    scale = np.sqrt(np.maximum(np.diag(within), 1e-6))
    found = []
    for k in (0, 1):
        own = (1 - pooled) * np.cov(x[y == k], rowvar=False, bias=True) + pooled * within
        own = own / np.outer(scale, scale)
        own = (1 - round_) * own + round_ * np.trace(own) / len(scale) * np.eye(len(scale))
        found.append((x[y == k].mean(axis=0), own * np.outer(scale, scale)))
    return found


def test_scores_equal_densities_by_definition(workers):
    rows = labelled(workers, 200)
    found = quality_discriminant.measured(rows, keep=("doc_id", "quality"))
    model = quality_discriminant.train(rows, found.drop("quality"))
    got = {r.doc_id: r.score for r in quality_discriminant.scored(found, model).collect()}
    texts = rows.orderBy("doc_id").collect()
    x = np.array([quality_discriminant.statistics(r.text) for r in texts])
    y = np.array([r.quality for r in texts])
    classes = plain_model(x, y, quality_discriminant.POOLED, quality_discriminant.ROUND)
    for r, v in zip(texts, x, strict=True):
        logs = [
            -0.5 * (v - m) @ np.linalg.solve(c, v - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in classes
        ]
        margin = quality_discriminant.TEMPERATURE * (logs[1] - logs[0]) + np.log(((y == 1).sum() + 0.5) / ((y == 0).sum() + 0.5))
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -500, 500))), abs=1e-6)


def test_statistics_by_hand():
    found = dict(zip(quality_discriminant.NAMES, quality_discriminant.statistics("Ab cd cd\nx#1!\n\nx#1!"), strict=True))
    share = {k: np.exp(v) - quality_discriminant.LEAST for k, v in found.items()}
    assert found["words"] == pytest.approx(np.log(6)) and found["words_per_line"] == pytest.approx(np.log1p(5 / 3))
    assert share["symbols"] == pytest.approx(2 / 14) and share["punctuation"] == pytest.approx(2 / 14)
    assert share["capitals"] == pytest.approx(1 / 8) and share["digits"] == pytest.approx(2 / 14)
    assert share["same_as_last"] == pytest.approx(2 / 4) and share["repeated_lines"] == pytest.approx(1 / 3)
    assert share["repeated_windows"] == pytest.approx(0) and share["short_words"] == pytest.approx(3 / 5)


def test_repeated_keys_and_labels_count_so_often(workers):
    """Rows of one id, labelled more than once, weigh as if written out; the join adds none."""
    docs = workers.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "X! Y!"), (None, "z"), (3, "c d")], "doc_id long, text string")
    labels = workers.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (None, 1), (3, None), (4, 1), (3, 7)], "doc_id long, quality int")
    found = quality_discriminant.measured(docs)
    assert found.count() == 5
    model = quality_discriminant.train(labels, found)
    a, b = (np.array(quality_discriminant.statistics(t)) for t in ("a b c", "X! Y!"))
    assert model.offset == pytest.approx(np.log(4.5 / 3.5))
    assert model.means[1] == pytest.approx(a) and model.means[0] == pytest.approx((2 * a + b) / 3)
    assert np.isfinite(model.scores(np.array([a, b]))).all()


def test_without_both_classes_and_odd_rows(workers, build, odd):
    none = workers.createDataFrame([], "doc_id long, text string, quality int")
    found = quality_discriminant.measured(none)
    assert quality_discriminant.scored(found, quality_discriminant.train(none, found)).collect() == []
    rows = quality_discriminant.measured(build(odd))
    empty = quality_discriminant.train(none, found)
    assert {r.score for r in quality_discriminant.scored(rows, empty).collect()} == {0.5}
    training = labelled(workers, 80)
    model = quality_discriminant.train(training, quality_discriminant.measured(training))
    scores = quality_discriminant.scored(rows, model).collect()
    assert len(scores) == len(odd) and all(0 <= r.score <= 1 for r in scores)


def test_query(workers):
    rows = JOBS["op13_quadratic_discriminant"](workers, SMALL).collect()
    assert len(rows) == workers.read.parquet(f"{SMALL}/documents.parquet").count()
    quality = {r.doc_id: r.quality for r in workers.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    held = [(quality[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([a == b for a, b in held]) > 0.8
