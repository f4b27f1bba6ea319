import hashlib
import re
import string

from pyspark.sql import functions as F

from tests.llm.conftest import SMALL, prose
from vacanta.llm import decontamination
from vacanta.llm.queries import JOBS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(documents, benchmark):
    windows = {}
    for item, text in benchmark:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    for text in documents:
        w, hit, items = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    items |= found
                    hit.update(range(i, i + n))
        yield len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)


def test_query_against_brute_force(workers):
    docs = workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    bench = workers.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = {r.doc_id: r for r in JOBS["op7_prefix_filtered_join"](workers, SMALL).collect()}
    want = brute([d.text for d in docs], [(b.item_id, b.text) for b in bench])
    for d, (n, hit, items, bad) in zip(docs, want, strict=True):
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), bad)
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def check(build, workers, pairs, bench):
    benchmark = workers.createDataFrame(bench, "item_id long, text string")
    rows = decontamination.contaminated(build(pairs), benchmark).collect()
    key = lambda r: (str(r[0]), *r[1:])
    want = [(i, *w) for (i, _), w in zip(pairs, brute([t for _, t in pairs], bench), strict=True)]
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_windows_and_short_items(build, workers):
    passage = prose(50, 40)
    bench = [(1, passage), (2, "Short Item"), (3, "lone"), (4, None), (5, "..."), (1, passage), (7, passage[20:] + " more")]
    p = passage.split()
    pairs = [
        (1, prose(51, 30) + " " + passage.upper() + " " + prose(52, 30)),
        (2, " ".join(p[5:18])),
        (3, " ".join(p[5:17])),  # one word too few
        (4, "short... ITEM short item lone"),
        (5, " ".join(p[:13]) + " " + prose(53, 400)),  # hit, but under a twentieth
        (6, " ".join(p[3:16] + p[4:17])),
    ]
    check(build, workers, pairs, bench)


def test_odd_rows(build, workers, odd):
    bench = [(1, "één ünï 中文 end"), (2, "Ünï"), (3, prose(2, 80)), (4, "a")]
    check(build, workers, odd, bench)
    check(build, workers, odd, [])
    check(build, workers, [], bench)


def test_large_vocabulary_needs_no_literals(build, workers, monkeypatch):
    monkeypatch.setattr(decontamination, "LITERAL_WORDS", 3)
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    check(build, workers, [(1, prose(50, 60)), (2, prose(51, 60))], [(1, prose(50, 30))])


def test_no_python(workers):
    path = f"{SMALL}/documents.parquet"
    plan = workers.read.parquet(path).select(F.size(decontamination.words_of(F.col("text"))))
    assert "Python" not in plan._jdf.queryExecution().toString()
