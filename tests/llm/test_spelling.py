import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import SMALL
from vacanta.llm import spelling
from vacanta.llm.queries import JOBS

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_words(rows):
    counts = {}
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                run = run.translate(LOWER)
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    form, near = {}, {}
    for w in counts:
        others = [v for v in counts if is_near(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, near[w], counts.get(form[w])))
    return sorted(rows, key=str)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def typed(seed, n_words=60, n=900):
    """Words of few letters (doubled ones too) with typing errors, very unevenly frequent."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabé") for _ in range(rng.randint(6, 10))) for _ in range(n_words)]
    out = []
    for _ in range(n):
        w = words[int(n_words * rng.random() ** 4)]
        if rng.random() < 0.15:
            i, c = rng.randrange(len(w)), rng.choice("abéÿ")
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
        out.append(w)
    return [(i, " ".join(out[i * 30 : (i + 1) * 30])) for i in range(n // 30)]


def test_near_in_block_by_hand():
    parts = ["abc", "abd", "abcd", "xabc", "abc"]
    i, j, longer = spelling.near_in_block(parts, np.array([0, 0, 0, 0, 1]), np.array([True] * 5))
    got = {(parts[a], parts[b], bool(k)) for a, b, k in zip(i, j, longer, strict=True)}
    assert got == {
        ("abc", "abd", False), ("abd", "abc", False), ("abc", "abcd", True), ("abd", "abcd", True), ("abc", "xabc", True),
    }


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(build, seed):
    rows = typed(seed)
    assert found(spelling.variants(build(rows))) == plain_variants(plain_words(rows))


@pytest.mark.parametrize(("limit", "window"), [(2, 48), (8192, 2), (3, 3)])
def test_large_and_wide_blocks_are_dealt_anew(workers, limit, window):
    """A common beginning of a third of all words, long words, and every dealing give one result."""
    rng = random.Random(5)
    words = {"common" + "".join(rng.choice("ab") for _ in range(6)): 3 for _ in range(40)}
    words |= {w: n for _, t in typed(9) for w in t.split() if len(w) >= 7 for n in [rng.randint(2, 50)]}
    long = "".join(rng.choice("abc") for _ in range(400))
    words |= {long: 90, long[:-1]: 3, long[:200] + "x" + long[200:]: 4, "z" + long[1:]: 5, "y" + long: 6}
    frame = workers.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(frame, limit, window).collect()}
    want = {}
    for w in words:
        others = [v for v in words if is_near(w, v)]
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            want[w] = (len(others), words[best], best)
    assert got == want


def test_roots_follow_forms_to_the_last(build):
    counts = {"letters": 2000, "letterz": 200, "letterzz": 20, "leterzz": 2, "unrelated": 5}
    texts, n = [], 0
    for w, k in counts.items():
        kept = 0
        while kept < k:
            if zlib.crc32(f"{n}:{w}".encode()) % 31:
                texts.append((n, w.upper()))
                kept += 1
            n += 1
    got = {r.word: (r.form, r.root) for r in spelling.variants(build(texts)).collect()}
    assert got["leterzz"] == ("letterzz", "letters") and got["letterzz"] == ("letterz", "letters")
    assert got["letters"] == (None, "letters") and got["unrelated"] == (None, "unrelated")


def test_odd_rows(build, odd):
    rows = [*odd, (None, "Ünïcode ünïcode Ünïcode " + "q" * 30_000), (7, "Ünïcode × " + "q" * 30_000 + " " + "q" * 29_999 + " " + "q" * 29_999)]
    counts = plain_words(rows)
    assert found(spelling.variants(build(rows))) == plain_variants(counts)
    assert any(len(w) > 20_000 for w in counts)
    assert spelling.variants(build([])).collect() == []


def test_query_equals_plain_code(workers):
    rows = [(r.doc_id, r.text) for r in workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.word: r for r in JOBS["op11_bit_sliced_spelling"](workers, SMALL).collect()}
    counts = plain_words(rows)
    assert {w: r.n for w, r in got.items()} == counts
    letters = sorted({c for w in counts for c in w})
    for w in sorted(counts)[::17]:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        near = [v for v in edits - {w} if v in counts]
        assert got[w].n_near == len(near)
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        assert got[w].form == (best if best and counts[best] >= 10 * counts[w] else None)
