import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacanta.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, tree string, anchor string, score string"


def table(workers, rows):
    return workers.createDataFrame([(*r, None, "x", "y") for r in rows], SCHEMA)


def mined(workers, rows, **changes):
    used = hard_negatives.usable(table(workers, rows), F.col("vec_id"), F.col("embedding"), F.col("label"), 256)
    return sorted(map(tuple, hard_negatives.hard_negatives(used, F.col("id") % 10 == 0, **changes).collect()))


def plain(rows, k=5):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for n, (a, v, label) in enumerate(kept):
        if a % 10:
            continue

        def ranked(same):
            rest = [(-sum(x * y for x, y in zip(v, w)), i, m) for m, (i, w, t) in enumerate(kept) if (t == label) is same and m != n]
            return sorted(rest)

        others = ranked(False)
        for p, i, _ in ranked(True)[:k]:
            inside = [x for x in others if 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(inside)]
    return sorted(out)


def clustered(seed, n, width=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = centres[i % 4]
        rows.append((i, [c + rng.gauss(0, 0.6) for c in centre], rng.choice([i % 4, i % 4, rng.randrange(4)])))
    return rows


@pytest.mark.parametrize("tree_rows", [16_384, 150])
def test_against_all_pairs(workers, tree_rows):
    rows = clustered(tree_rows, 700)
    assert mined(workers, rows, tree_rows=tree_rows, chunk=30) == plain(rows)


def test_ties_repeats_and_one_common_vector(workers):
    """A third of all rows hold one vector; many scores are equal; ids repeat."""
    rng = random.Random(3)
    rows = clustered(1, 120)
    rows += [(200 + i, [1.0] * 6, i % 3) for i in range(90)]
    rows += [(400 + i, [float(rng.randint(0, 1)) for _ in range(6)], i % 2) for i in range(60)]
    rows += rows[:15]
    assert mined(workers, rows, tree_rows=70) == plain(rows)


def test_odd_rows(workers):
    good = [(i, [float(i % 3), 1.0, -0.5], i % 2) for i in range(24)]
    odd = [
        (None, [1.0, 1.0, 1.0], 0), (30, None, 0), (31, [1.0, None, 1.0], 1), (32, [float("nan")] * 3, 0),
        (33, [float("inf"), 0.0, 0.0], 1), (34, [1.0] * 3, None), (40, [], 0), (41, [2.0], 1), (42, [1.0] * 9, 0),
    ]
    assert mined(workers, good + odd) == plain(good + odd)
    assert mined(workers, []) == []
    assert mined(workers, [(1, [1.0], 0)]) == []
    assert mined(workers, [(10, [1.0], 0), (20, [-1.0], 0), (30, [1.0], 1)]) == []


def test_boxes_hold_their_rows():
    rng = np.random.default_rng(2)
    vectors, labels = rng.integers(-99, 99, (1000, 5)), rng.integers(0, 3, 1000)
    order, starts = hard_negatives.str_order(vectors, labels)
    assert sorted(order) == list(range(1000))
    assert np.diff(np.append(starts, 1000)).max() <= hard_negatives.LEAF
    levels = hard_negatives._levels(vectors[order], labels[order], starts)
    assert len(levels[-1][0]) == 1 and (levels[-1][0] == vectors.min(axis=0)).all()
    assert (levels[0][2] == levels[0][3]).mean() > 0.8  # leaves of one label


def test_a_search_prunes(monkeypatch):
    """Far boxes are not read, and the best rows are still found."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1000, (16, 4))
    vectors = np.repeat(centres, 250, axis=0).astype(np.int64) + rng.integers(-20, 20, (4000, 4))
    labels = np.zeros(4000, dtype=np.int64)
    order, starts = hard_negatives.str_order(vectors, labels)
    asked = vectors[::500]
    shape = (len(asked), 1)
    queries = hard_negatives.Queries(
        asked, labels[: len(asked)], np.full(len(asked), -1), np.full(shape, hard_negatives.LEAST), np.full(shape, hard_negatives.MOST), True, 5
    )
    read = []
    leaf = hard_negatives.Search._leaf
    monkeypatch.setattr(hard_negatives.Search, "_leaf", lambda self, row, a, v, *x: (read.append(len(row) * len(v)), leaf(self, row, a, v, *x)))
    search = hard_negatives.Search(queries)
    search.tree(vectors[order], order, labels, order, starts)
    scores = asked @ vectors.T
    for a in range(len(asked)):
        want = sorted((-int(s), i, i) for i, s in enumerate(scores[a]))[:5]
        assert search.best[a, 0] == want
    assert sum(read) < 0.2 * scores.size


def test_exact_beyond_doubles():
    a, b = np.array([[(1 << 28) + 1, 3]]), np.array([[(1 << 28) + 1], [1]])
    assert hard_negatives._product(a, b).tolist() == [[((1 << 28) + 1) ** 2 + 3]]
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives._product(a << 20, b << 20)
