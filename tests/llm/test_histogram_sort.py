import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from vacanta.llm import histogram_sort
from vacanta.llm.queries import JOBS
from vacanta.session import scratch_path


def key(value):
    return int(hashlib.md5(value.encode()).hexdigest()[:15], 16)


def test_query_against_a_full_sort(workers):
    docs = workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in JOBS["op2_histogram_sort"](workers, SMALL).collect()}
    order = sorted((key(t), key(str(i)), i, t) for i, t in docs)
    total = sum(len(t.encode()) + 1 for *_, t in order)
    below, slots = 0, {}
    for _, _, i, t in order:
        shard, size = below * 16 // total, len(t.encode()) + 1
        slot = slots.get(shard, 0)
        r = got.pop(i)
        assert (r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) == (
            size,
            zlib.crc32(t.encode()),
            "bytes",
            shard,
            slot,
            None,
        )
        below, slots[shard] = below + size, slot + 1
    assert not got


def keyed(docs):
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        histogram_sort.hash_key(F.col("text")).alias("k1"),
        histogram_sort.hash_key(F.col("doc_id")).alias("k2"),
        histogram_sort.row_key().alias("k3"),
        F.lit("x").alias("cell"),
    )
    path = scratch_path(docs.sparkSession, "keyed")
    narrow.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def gapless(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_hot_group_is_shared_out(build):
    pairs = [(i, "copy") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 5000)]
    rows = histogram_sort.histogram_shards(keyed(build(pairs)), 4).collect()
    assert len(rows) == 5000 and gapless(rows)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 20


@pytest.mark.parametrize("spread", [1000, 10])
def test_repeated_rows_without_id_are_shared_out(build, monkeypatch, spread):
    """A third of all rows are one row without id; no shard is more than a row off."""
    monkeypatch.setattr(histogram_sort, "HEAVY_ROWS", spread)
    rows = histogram_sort.histogram_shards(keyed(build([(None, "the same")] * 1000 + [(i, f"text {i}") for i in range(2000)])), 16).collect()
    assert len(rows) == 3000 and gapless(rows)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 20


def test_odd_rows(build, odd):
    rows = histogram_sort.histogram_shards(keyed(build(odd)), 3).collect()
    assert len(rows) == len(odd) and gapless(rows)
    assert histogram_sort.histogram_shards(keyed(build([])), 3).collect() == []
