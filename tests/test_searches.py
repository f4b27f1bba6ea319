import gzip
import json
import os

import pytest

from vacanta.plans import refresh
from vacanta.session import scratch_path
from vacanta.sources import searches
from vacanta.sources.searches import failed_records, found_postings, load_searches
from vacanta.streaming.ingest import ingest


def advert(number, **more):
    return json.dumps({"id": f"a{number}", "title": f" Analyst {number} ", **more}, ensure_ascii=False)


def page(folder, query, name, content, time=None):
    place = folder / f"query={query}"
    place.mkdir(parents=True, exist_ok=True)
    file = place / name
    file.write_bytes(content if isinstance(content, bytes) else content.encode())
    if time is not None:
        os.utime(file, ns=(time, time))


def found(records):
    return sorted((r.query, r.id, r.title) for r in found_postings(records).collect())


def test_searches_are_tagged_and_faults_stay_alone(spark, tmp_path):
    page(tmp_path, "data%20analyst", "1.json", "\n".join([advert(1), "", "{broken", advert(2, extra=[1])]))
    page(tmp_path, "data engineer", "1.json.gz", gzip.compress((advert(3) + "\r\n" + advert(3)).encode()))
    page(tmp_path, "bad", "1.json.gz", b"no gzip at all")
    page(tmp_path, "bad", "2.json", b'\xff\xfe\n' + advert(4, title="Büro").encode())
    page(tmp_path, "bad", "_hidden.json", advert(5))
    page(tmp_path, "empty", "1.json", "")
    records = load_searches(spark, str(tmp_path))
    assert found(records) == [
        ("bad", "a4", "Büro"),
        ("data analyst", "a1", "Analyst 1"),
        ("data analyst", "a2", "Analyst 2"),
        ("data engineer", "a3", "Analyst 3"),
        ("data engineer", "a3", "Analyst 3"),
    ]
    failed = {(r.query, os.path.basename(r.file), r.failure.split(":")[0]) for r in failed_records(records).collect()}
    assert failed == {
        ("data analyst", "1.json", "not JSON"),
        ("bad", "1.json.gz", "OSError"),
        ("bad", "2.json", "not UTF-8"),
    }


@pytest.mark.parametrize("piece_bytes", [1, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("last", ["", "\n"])
def test_pages_are_cut_at_lines(spark, tmp_path, piece_bytes, last):
    lines = [advert(i, description="ü" * (i * 7 % 40)) for i in range(12)]
    page(tmp_path, "x", "1.json", "\n".join(lines[:9]) + last)
    page(tmp_path, "x", "2.json", "\n".join(lines[9:]) + last)
    records = load_searches(spark, str(tmp_path), piece_bytes=str(piece_bytes))
    assert sorted(r.record for r in records.collect()) == sorted(lines)
    size = sum(p.stat().st_size for p in tmp_path.rglob("*.json"))
    assert records.rdd.getNumPartitions() >= size // piece_bytes


def test_no_pages_give_no_rows(spark, tmp_path):
    records = load_searches(spark, str(tmp_path))
    assert found(records) == []
    assert failed_records(records).count() == 0


def test_a_stream_reads_each_page_once_also_within_one_tick(spark, tmp_path):
    pages, log, store = tmp_path / "pages", str(tmp_path / "log"), scratch_path(spark, "searches-store")

    def take():
        ingest(found_postings(load_searches(spark, str(pages), streaming=True)), store, log).awaitTermination()
        return sorted((r.query, r.id) for r in refresh.current(spark, store).select("query", "id").collect())

    page(pages, "x", "b.json", advert(1), time=10**18)
    assert take() == [("x", "a1")]
    page(pages, "x", "a.json", advert(2), time=10**18)  # same tick, smaller name
    page(pages, "y", "a.json", advert(3), time=10**17)  # a search of its own
    assert take() == [("x", "a1"), ("x", "a2"), ("y", "a3")]
    assert take() == [("x", "a1"), ("x", "a2"), ("y", "a3")]
    page(pages, "x", "c.json", advert(4), time=10**18 + 1)
    page(pages, "x", "d.json", "{broken", time=10**18 + 1)
    assert take() == [("x", "a1"), ("x", "a2"), ("x", "a4"), ("y", "a3")]
    stored = refresh.sightings(spark, store)  # every one, not only the first
    assert sorted(r.id for r in stored.select("id").collect()) == ["a1", "a2", "a3", "a4"]


def test_a_piece_reads_little_more_than_itself(tmp_path):
    """Pieces of a page are read once altogether, not a block of the reader's size each."""
    lines = [advert(i, description="x" * (i % 50)) for i in range(30_000)]
    page(tmp_path, "x", "1.json", "\n".join(lines))
    taken = []

    class File:
        def __init__(self, path):
            self.file = open(path, "rb")

        def __enter__(self):
            return self

        def __exit__(self, *fault):
            self.file.close()

        def seek(self, at):
            return self.file.seek(at)

        def read(self, n):
            taken.append(len(block := self.file.read(n)))
            return block

    class Files:
        open_input_file = staticmethod(File)

    reader = searches._source()({"path": str(tmp_path), "piece_bytes": "65536"}).reader(None)
    pieces = [p for part in reader.partitions() for p in part.pieces]
    got = [x for file, _, *ends in pieces for found in reader.lines(Files, file, *ends) for x in found]
    assert b"".join(got) == "\n".join(lines).encode() and len(pieces) > 20
    assert sum(taken) < 1.2 * pieces[-1][3]


def test_tasks_do_not_grow_with_small_pieces(tmp_path):
    lines = "\n".join(advert(i) for i in range(20_000))
    for query in ("x", "y"):
        page(tmp_path, query, "1.json", lines)
    reader = searches._source()({"path": str(tmp_path), "piece_bytes": "50"}).reader(None)
    parts = reader.partitions()
    assert 2 < len(parts) < 2 * searches.MANY_TASKS
    ends = [p[2:] for part in parts if part.query == "x" for p in part.pieces]
    assert len(ends) > 9000 and [a[1] for a in ends[:-1]] == [b[0] for b in ends[1:]]
