import random

import numpy as np

from tests.llm.conftest import prose
from vacanta.llm import components, dart_minhash


def brute_classes(pairs):
    def shingles(text):
        words = (text or "").split()
        n = min(5, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            same = (pairs[i][1] or "") == (pairs[j][1] or "")
            both = len(sets[i] & sets[j])
            if same or (both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both)):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(pairs))]


def partition(labels):
    groups = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, []).append(i)
    return sorted(map(tuple, groups.values()))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.RandomState(0)
    agree, want = [], []
    for _ in range(40):
        elements = rng.randint(0, 2**62, 200).astype(np.uint64)
        a = rng.exponential(2, 200) + 0.01
        b = a * rng.uniform(0.4, 1.6, 200)
        agree.append((dart_minhash.dart_signature(elements, a, 256) == dart_minhash.dart_signature(elements, b, 256)).mean())
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agree) - np.mean(want)) < 0.02


def test_classes_against_all_pairs(build):
    rng = random.Random(3)
    pairs = []
    for g in range(40):
        base = prose(100 + g, 120).split()
        pairs.append((len(pairs), " ".join(base)))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 4))):
                copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
            pairs.append((len(pairs), " ".join(copy)))
    rows = {r.doc_id: r for r in dart_minhash.near_duplicates(build(pairs)).collect()}
    got = partition([rows[i].class_id for i, _ in pairs])
    assert got == partition(brute_classes(pairs))
    for r in rows.values():
        members = [i for i in rows if rows[i].class_id == r.class_id]
        assert r.class_id == min(members) and r.class_size == len(members)
    assert sum(r.first for r in rows.values()) == len(got)


def test_large_group_of_noisy_copies(build):
    """A bucket of many copies with noise above and below the wanted similarity: every link counts."""
    rng = random.Random(4)
    base = prose(7, 150).split()
    pairs = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 6, 12))):
            copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
        pairs.append((i, " ".join(copy)))
    rows = {r.doc_id: r for r in dart_minhash.near_duplicates(build(pairs)).collect()}
    assert partition([rows[i].class_id for i, _ in pairs]) == partition(brute_classes(pairs))


def brute_links(pairs):
    """Links and classes by all pairs, counted on numbers of shingles."""
    sets = []
    for _, t in pairs:
        words = t.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    links = [0] * len(pairs)
    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
    return links


def similar_group(size, template=150, own=8):
    """Texts that are all similar: a template and a few words of their own at its end."""
    base = prose(11, template)
    return [f"{base} " + " ".join(f"own{i}x{k}" for k in range(own)) for i in range(size)]


def test_links_of_a_large_group(build, monkeypatch):
    """Every text of a large similar group counts all others, over several blocks."""
    monkeypatch.setattr(dart_minhash, "BLOCK_TEXTS", 40)
    pairs = list(enumerate(similar_group(300)))
    rows = {r.doc_id: r for r in dart_minhash.near_duplicates(build(pairs)).collect()}
    assert {r.n_links for r in rows.values()} == {299}
    assert {(r.class_id, r.class_size) for r in rows.values()} == {(0, 300)}


def test_template_family_below_the_limit(build):
    """Texts of one template share buckets but no link, except that each has one partner."""
    rng = random.Random(6)
    base = prose(12, 150).split()
    pairs = []
    for g in range(100):
        tail = [f"own{g}x{k}" for k in range(50)]
        pairs.append((2 * g, " ".join(base + tail)))
        tail[rng.randrange(5, 45)] = "edit"
        pairs.append((2 * g + 1, " ".join(base + tail)))
    want = brute_links(pairs)
    assert set(want) == {1}
    rows = {r.doc_id: r for r in dart_minhash.near_duplicates(build(pairs)).collect()}
    assert [rows[i].n_links for i, _ in pairs] == want
    assert partition([rows[i].class_id for i, _ in pairs]) == partition(brute_classes(pairs))


def test_overlaps_and_forest():
    rng = np.random.RandomState(1)
    sets = [np.unique(rng.randint(0, 30_000, n)) for n in (0, 5, 9_000, 20_000, 20_000)]
    got = dart_minhash.overlaps(sets[:3], sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:3]]
    linked = np.zeros((5, 5), dtype=bool)
    for u, v in ((0, 1), (1, 2), (0, 2), (3, 4)):
        linked[u, v] = linked[v, u] = True
    assert len(dart_minhash.forest(linked)) == 3


def test_weighted(build):
    line = "one two three four five six seven eight nine ten"
    pairs = [(1, "\n".join([line] * 20) + " alpha beta gamma delta epsilon zeta"), (2, "\n".join([line] * 20) + " other words end it here now")]
    assert len({r.class_id for r in dart_minhash.near_duplicates(build(pairs)).collect()}) == 2
    assert len({r.class_id for r in dart_minhash.near_duplicates(build(pairs), weighted=True).collect()}) == 1


def test_odd_rows(build, odd):
    rows = dart_minhash.near_duplicates(build(odd)).collect()
    assert len(rows) == len(odd)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[4].class_id == by_id[5].class_id == 4
    assert by_id[1].class_id == by_id[2].class_id == 1  # null and empty are the same text
    assert by_id[3].class_id == 3
    assert by_id[6].n_copies == 2
    assert dart_minhash.near_duplicates(build([])).collect() == []


def test_components_of_a_long_chain(workers):
    links = workers.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (301, 300)], "a long, b long")
    got = {r.node: r.component for r in components.connected(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}
    assert components.connected(links.filter("a < 0")).collect() == []
