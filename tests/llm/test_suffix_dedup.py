import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.conftest import SMALL, prose
from vacanta.llm import suffix_dedup
from vacanta.llm.queries import JOBS


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(b[i : i + 400]) for b in data for i in range(len(b) - 399))
    for b in data:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 399):
            if seen[hash(b[i : i + 400])] > 1:
                gone[i : i + 400] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        yield len(b), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")


def check(build, pairs):
    rows = suffix_dedup.repeated_spans(build(pairs)).collect()
    key = lambda r: (str(r[0]), *r[1:])
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256, r.kept_text) for r in rows]
    want = [(i, *w) for (i, _), w in zip(pairs, brute([t for _, t in pairs]), strict=True)]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_query_against_brute_force(workers):
    docs = workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in JOBS["op10_bucket_refinement"](workers, SMALL).collect()}
    for d, (n, spans, digest, text) in zip(docs, brute([d.text for d in docs]), strict=True):
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_spans, r.kept_sha256, r.text) == (n, len(spans), digest, text)
        assert r.n_removed == sum(b - a for a, b in spans)


def test_planted_repeats(build):
    shared = prose(60, 150)
    pairs = [(i, prose(200 + i, 40 + 9 * i) + shared[i : len(shared) - 2 * i] + prose(300 + i, 60)) for i in range(8)]
    pairs += [
        (20, shared[:400]),
        (21, shared[:399]),
        (22, prose(70, 90) * 3),  # repeats inside one text
        (23, "At " * 500),  # a period shorter than the anchors' reach
        (24, "é" * 450 + prose(71, 50)),
        (25, "x" * 400),
        (26, "y" * 401),
        (27, prose(72, 200) + "é" * 300),
    ]
    check(build, pairs)


def test_edits_at_every_distance(build):
    rng = random.Random(9)
    base = prose(80, 400)
    pairs = [(0, base)]
    for i in range(1, 25):
        copy = list(base)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(len(copy))] = "#"
        pairs.append((i, "".join(copy)[rng.randint(0, 500) : len(base) - rng.randint(0, 500)]))
    check(build, pairs)


def test_odd_rows(build, odd):
    check(build, odd)
    assert suffix_dedup.repeated_spans(build([])).collect() == []


def test_text_of_several_segments(build):
    """A passage at the far end of a text of over 600,000 bytes is met again elsewhere."""
    shared, long = prose(95, 100), prose(96, 130_000)
    assert len(long) > suffix_dedup.SEGMENT + 100_000
    check(build, [(1, long + shared), (2, prose(97, 50) + shared + prose(98, 20)), (3, long[500_000:500_900])])


def test_shuffled_texts_and_segments(build, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_TEXTS", 0)
    shared = prose(90, 120)
    check(build, [(1, prose(91, 500) + shared), (2, shared + prose(92, 500))])
    data = (prose(93, 3000)).encode()
    whole = [x.tolist() for x in suffix_dedup.anchors(data)]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 777)
    assert [x.tolist() for x in suffix_dedup.anchors(data)] == whole
