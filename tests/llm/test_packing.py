import random

import numpy as np
import public_tokenizers

from tests.llm.conftest import SMALL
from vacanta.llm import bpe, packing
from vacanta.llm.queries import BYTE_RANKS, FREE_ID, JOBS


def plain_best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(size - n)
    return sorted(rooms)


def test_best_fit_against_a_plain_search():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.randint(1, 70)
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 80))]
        rows = packing.best_fit_decreasing(lengths, size)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in row) for row in rows) == plain_best_fit(lengths, size)


def packed(build, pairs, **options):
    return packing.packed_rows(build(pairs), BYTE_RANKS, public_tokenizers.PATTERN, FREE_ID, **options).collect()


def test_round_trip(build, odd):
    rows = packed(build, odd, row_tokens=500, group_bytes=20_000)
    parts = {}
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u2")
        ends = r.segment_ends
        assert len(ids) == 500 and ends[0] == 0 and ends[-1] <= 500
        assert (ids[ends[-1] :] == FREE_ID).all()
        assert r.position_resets == ends[:-1] + ([ends[-1]] if ends[-1] < 500 else [])
        for start, end, doc, chunk in zip(ends, ends[1:], r.doc_ids, r.chunks, strict=False):
            parts.setdefault(doc, []).append((chunk, ids[start:end].tolist()))
    codec = bpe.codec(BYTE_RANKS, public_tokenizers.PATTERN)
    for doc in {i for i, _ in odd}:
        want = sorted(
            (n, ids[at : at + 500])
            for i, text in odd
            if i == doc
            for ids in [np.frombuffer(codec.encode(text or ""), dtype="<u4").tolist()]
            for n, at in enumerate(range(0, len(ids), 500))
        )
        assert sorted(parts.get(doc, [])) == want


def test_text_ids_and_repeated_rows(workers):
    """Ids keep their type, large ones their digits; repeated rows are dealt over the groups."""
    rows = [("a", "one two three"), (None, "four"), ("b", "x " * 300)] + [("c", "same text " * 30)] * 400
    frame = workers.createDataFrame(rows, "doc_id string, text string")
    got = packing.packed_rows(frame, BYTE_RANKS, public_tokenizers.PATTERN, FREE_ID, row_tokens=100, group_bytes=4_000).collect()
    assert sorted(str(d) for r in got for d in r.doc_ids if d != "c") == ["None", "a", *["b"] * 4]
    sizes = [sum(r.segment_ends[-1] for r in got if r.pack_group == g) for g in {r.pack_group for r in got}]
    assert len(sizes) > 20 and max(sizes) < 4 * sum(sizes) / len(sizes)
    large = workers.createDataFrame([((1 << 60) + 1, "a b"), (None, "c")], "doc_id long, text string")
    got = packing.packed_rows(large, BYTE_RANKS, public_tokenizers.PATTERN, FREE_ID).collect()
    assert {d for r in got for d in r.doc_ids} == {(1 << 60) + 1, None}


def test_query_round_trip(workers):
    """Every document of the table comes back from the registered query."""
    docs = workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    parts = {}
    for r in JOBS["op9_best_fit_packing"](workers, SMALL).collect():
        ids = np.frombuffer(r.ids, dtype="<u2")
        for start, end, doc, chunk in zip(r.segment_ends, r.segment_ends[1:], r.doc_ids, r.chunks, strict=False):
            parts.setdefault(doc, {})[chunk] = ids[start:end].astype("<u4").tobytes()
    codec = bpe.codec(BYTE_RANKS, public_tokenizers.PATTERN)
    for d in docs:
        found = parts.pop(d.doc_id, {})
        assert b"".join(found[n] for n in range(len(found))) == codec.encode(d.text or "")
    assert not parts


def test_no_rows(build):
    assert packed(build, []) == []
    assert packed(build, [(1, None), (2, "")]) == []


def test_little_padding(build):
    rng = random.Random(3)
    pairs = [(i, "word " * rng.randint(1, 900)) for i in range(400)]
    rows = packed(build, pairs, row_tokens=1000)
    used = sum(r.segment_ends[-1] for r in rows)
    assert used / (1000 * len(rows)) > 0.97
