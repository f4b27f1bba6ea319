import hashlib

import corpus_pipeline
import public_tokenizers
import pytest

from tests.llm.conftest import SMALL, prose
from tests.llm.test_dart_minhash import brute_classes
from tests.llm.test_decontamination import brute as brute_hits
from vacanta.llm import bpe
from vacanta.llm.queries import BYTE_RANKS, JOBS


@pytest.fixture()
def stage(workers):
    stages = dict(corpus_pipeline.STAGES)
    return lambda name, docs: stages[name](workers, docs, SMALL)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_against_brute_force(workers):
    docs = workers.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    kept = {r.doc_id for r in JOBS["op1_tokeniser_fertility"](workers, SMALL).filter("kept").collect()}
    left = [d for d in docs if d.doc_id in kept]
    classes = brute_classes([(d.doc_id, d.text) for d in left])
    first = {}
    for d, c in zip(left, classes, strict=True):
        first.setdefault(c, d)
    left = sorted(first.values(), key=lambda d: d.doc_id)
    bench = [(b.item_id, b.text) for b in workers.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hits = brute_hits([d.text for d in left], bench)
    left = [d for d, (*_, bad) in zip(left, hits, strict=True) if not bad]
    rows = {r.doc_id: r for r in corpus_pipeline.run(workers, SMALL).collect()}
    assert set(rows) == {d.doc_id for d in left}
    new = dict(JOBS["op3_feistel_pseudonyms"](workers, SMALL).select("doc_id", "text").collect())
    codec = bpe.codec(BYTE_RANKS, public_tokenizers.PATTERN)
    for doc_id, r in rows.items():
        assert bytes(r.ids) == codec.encode(new[doc_id])
        assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(new[doc_id].encode()).hexdigest()


def test_near_dedup_keeps_one_of_each(build, stage):
    text = prose(40, 90)
    docs = build([(3, text), (2, text), (2, text), (None, text), (7, "alone"), (7, "alone"), (7, "other"), (None, "x"), (None, "x"), (None, None), (8, "")])
    rows = stage("near_dedup", docs)
    assert rows.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in rows.collect())
    assert got == sorted([("2", text), ("7", "alone"), ("7", "other"), ("None", "x"), ("8", "")])


@pytest.mark.parametrize("name", ["quality_rules", "near_dedup", "decontamination", "pii"])
def test_columns_and_odd_rows(build, stage, odd, name):
    docs = build(odd)
    rows = stage(name, docs)
    assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
    assert rows.count() <= len(odd)
    assert stage(name, build([])).count() == 0


def test_last_stage_takes_odd_rows(build, odd, stage):
    """A row each, with its ids; a null text is empty."""
    rows = stage("bpe", build(odd)).collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in rows) == sorted(
        (str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd
    )
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows)
    assert stage("bpe", build([])).count() == 0


def test_decontamination_drops_only_contaminated(build, stage, workers):
    passage = workers.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    docs = build([(1, passage), (None, passage), (2, prose(41, 60)), (2, passage), (None, None)])
    got = sorted((str(r.doc_id), r.text or "") for r in stage("decontamination", docs).collect())
    assert got == sorted([("2", prose(41, 60)), ("None", "")])
