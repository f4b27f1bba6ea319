import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import SMALL
from vacanta.llm import bpe
from vacanta.llm.queries import BYTE_RANKS, JOBS

PIECES = ["a", "e", "th", "'", "'s", "'re", "r", "l", " ", "  ", "\n", "\t", "é", "中", "😀", "1", "..", "!", "ing", "\x1c", " "]


@pytest.fixture()
def small_leaves(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 5)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 7)
    monkeypatch.setattr(bpe, "FIRST_WINDOW", 1)
    monkeypatch.setattr(bpe, "DECODE_LEAF", 3)
    with open(BYTE_RANKS, "rb") as lines:
        return bpe.ByteBpe(bpe.read_ranks(lines), public_tokenizers.PATTERN)


def test_tree_equals_the_library(small_leaves):
    rng = random.Random(5)
    for n in range(6000):
        parts = PIECES[: rng.randint(2, len(PIECES))]
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        want = small_leaves._core.encode_ordinary(text)
        assert small_leaves.encode(text) == struct.pack(f"<{len(want)}I", *want), text
        assert small_leaves.decode(small_leaves.encode(text)) == text.encode()


def test_one_very_long_piece(small_leaves):
    rng = random.Random(6)
    for letters in ("a", "ab", "aeinrst"):
        text = "".join(rng.choice(letters) for _ in range(3000))
        want = small_leaves._core.encode_ordinary(text)
        assert small_leaves.encode(text) == struct.pack(f"<{len(want)}I", *want)


def test_rows(build, odd):
    rows = bpe.encode_texts(
        build(odd), BYTE_RANKS, public_tokenizers.PATTERN, outputs=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")
    ).collect()
    assert len(rows) == len(odd)
    for row, (doc_id, text) in zip(rows, odd, strict=True):
        text = text or ""
        assert row.doc_id == doc_id
        assert row.n_tokens * 4 == len(row.ids)
        assert row.ids_sha256 == hashlib.sha256(bytes(row.ids)).hexdigest()
        assert row.decoded == text
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_library(workers):
    """The registered query over the whole table, against the library's own encoding."""
    with open(BYTE_RANKS, "rb") as lines:
        plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(lines), special_tokens={})
    texts = dict(workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = JOBS["op5_monoid_bpe"](workers, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_no_rows(build):
    assert bpe.encode_texts(build([]), BYTE_RANKS, public_tokenizers.PATTERN).collect() == []
