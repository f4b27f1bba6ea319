import random
import zlib

import numpy as np

from tests.llm.conftest import prose
from vacanta.llm import toxicity
from vacanta.llm.queries import JOBS


def labelled(workers, n=400):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        words = prose(1000 + i, 120).split()
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grobian", "mistkerl", "schuft"]))
        rows.append((i, " ".join(words), int(toxic)))
    return workers.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_rows_are_told_apart(workers):
    rows = labelled(workers)
    model = toxicity.train(rows.filter("doc_id < 300"), rows)
    scored = toxicity.scored(rows.filter("doc_id >= 300"), model, keep=("doc_id", "toxic")).collect()
    toxic = [r.score for r in scored if r.toxic]
    clean = [r.score for r in scored if not r.toxic]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.95
    assert all(0 <= r.score <= 1 for r in scored)


def test_spark_scores_equal_plain_scores(workers):
    rows = labelled(workers, 200)
    model = toxicity.train(rows, rows)
    for r in toxicity.scored(rows, model, keep=("text",)).collect():
        grams = set(toxicity.buckets_of(r.text).tolist())
        margin = model.bias + sum(model.weights[g] for g in sorted(grams))
        assert abs(r.score - 1 / (1 + np.exp(-margin))) < 1e-9


def test_repeated_keys_do_not_grow_the_sample(workers):
    """A third of all rows under one id, labelled a hundred times, leave the model as it is."""
    rows = labelled(workers, 200)
    model = toxicity.train(rows, rows)
    one = rows.filter("doc_id = 4")
    many = rows.unionByName(one.crossJoin(workers.range(100)).drop("id"))
    again = toxicity.train(many, many)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def plain_margins(texts, labels):
    """Ratios by definition and a slow gradient descent, over n-grams as text."""
    grams = [{t[i : i + n] for n in toxicity.ORDERS for i in range(len(t) - n + 1)} for t in texts]
    n1, n0 = sum(labels), len(labels) - sum(labels)
    ratios = {}
    for g in set().union(*grams):
        a = sum(g in x for x, y in zip(grams, labels, strict=True) if y)
        b = sum(g in x for x, y in zip(grams, labels, strict=True) if not y)
        r = np.log((a + n1 / (n1 + n0)) / n1) - np.log((b + n0 / (n1 + n0)) / n0)
        G = 2 * sum(
            o * np.log(o / e)
            for seen, size in ((a, n1), (b, n0))
            for o, e in ((seen, (a + b) * size / (n1 + n0)), (size - seen, (n1 + n0 - a - b) * size / (n1 + n0)))
            if o
        )
        if a + b >= toxicity.MIN_TEXTS and abs(r) >= toxicity.MIN_RATIO and G >= toxicity.MIN_EVIDENCE:
            ratios[g] = r
    order = sorted(ratios)
    x = np.array([[ratios[g] if g in s else 0.0 for g in order] for s in grams])
    y, w, b = np.array(labels, float), np.zeros(len(order)), np.log(n1 / n0)
    for _ in range(4000):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w -= 0.02 * (x.T @ error + toxicity.PENALTY * w)
        b -= 0.02 * error.sum()
    return x @ w + b


def test_fit_agrees_with_a_plain_solver(workers):
    rows = labelled(workers, 120)
    model = toxicity.train(rows, rows)
    kept = rows.orderBy("doc_id").collect()
    slow = plain_margins([r.text.lower() for r in kept], [r.toxic for r in kept])
    fast = np.array([np.log(s / (1 - s)) for s in (toxicity.score_text(r.text, model) for r in kept)])
    assert np.corrcoef(slow, fast)[0, 1] > 0.97
    assert ((slow > 0) == (fast > 0)).mean() > 0.97


def test_ngrams_by_hand():
    """A bucket per distinct n-gram, whatever surrounds it; case does not matter."""
    found = set(toxicity.buckets_of("abcde").tolist())
    assert found == set(toxicity.buckets_of("ABCD").tolist()) | set(toxicity.buckets_of("bcde").tolist()) | found
    assert len(found) == 3  # abcd, bcde, abcde
    assert set(toxicity.buckets_of("bcde").tolist()) < set(toxicity.buckets_of("xx bcde yy").tolist())


def test_unseen_ngram_has_no_ratio():
    ratios = toxicity.log_count_ratios(np.array([0.0, 5.0]), np.array([0.0, 0.0]), 10, 90)
    assert abs(ratios[0]) < 1e-12 and ratios[1] > 2


def test_without_both_classes(workers, build, odd):
    none = workers.createDataFrame([], "doc_id long, text string, toxic int")
    assert toxicity.score_text("x", toxicity.train(none, none)) == 0.5
    one = workers.createDataFrame([(1, "x", 1), (2, "y", 1), (3, "z", None)], "doc_id long, text string, toxic int")
    assert toxicity.score_text("x", toxicity.train(one, one)) > 0.5
    rows = toxicity.scored(build(odd), toxicity.train(labelled(workers, 80), labelled(workers, 80))).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(build([]), toxicity.train(none, none)).collect() == []


def test_query(workers):
    folder = "/root/testdata/sf0.001"
    rows = JOBS["op6_toxicity_ngrams"](workers, folder).collect()
    assert len(rows) == workers.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
