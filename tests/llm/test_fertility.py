import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from vacanta.llm import bpe, fertility
from vacanta.llm.queries import BYTE_RANKS, JOBS, PIECE_MODEL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The base counts, one word at a time."""
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(hit)


def test_query_against_brute_force(workers):
    texts = dict(workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = JOBS["op1_tokeniser_fertility"](workers, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    with open(BYTE_RANKS, "rb") as lines:
        plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(lines), special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
        words = WORD.findall(texts[r.doc_id])
        tokens = [t for w in words for t in plain.encode_ordinary(" " + w)]
        cut = [p for w in words for p in pieces.encode(w)]
        assert r.n_tokens == len(tokens)
        assert math.isclose(r.chars_per_token, want[1] / len(tokens))
        assert math.isclose(r.chars_per_piece, want[1] / len(cut))
        assert math.isclose(r.fallback_share, sum(map(pieces.is_byte, cut)) / len(cut))
        p = np.array(list(Counter(tokens).values())) / len(tokens)
        entropy = -(p * np.log2(p)).sum() / math.log2(min(len(tokens), fertility.ENTROPY_TOKENS))
        assert math.isclose(r.entropy_share, entropy, rel_tol=1e-9)


def test_clean_prose_is_kept_and_junk_is_not(workers):
    rows = JOBS["op1_tokeniser_fertility"](workers, SMALL)
    labels = workers.read.parquet(f"{SMALL}/labels.parquet")
    joined = rows.join(labels, "doc_id").filter(~F.col("base_failed"))
    kept = {q: (n, k) for q, n, k in joined.groupBy("quality").agg(F.count("*"), F.count_if("kept")).collect()}
    assert kept[1][0] == kept[1][1]
    assert 0 not in kept or kept[0][1] < kept[0][0]


def test_odd_rows(build, odd):
    docs = build(odd)
    rows = fertility.measured(docs, BYTE_RANKS, public_tokenizers.PATTERN, PIECE_MODEL)
    assert rows.columns == [*docs.columns, "fertility"]
    found = rows.select("doc_id", "text", "fertility", fertility.in_band(F.col("lang")).alias("kept")).collect()
    assert len(found) == len(odd)
    for r in found:
        assert r.fertility.n_words == brute(r.text)[0]
        assert r.fertility.n_repeat_words == brute(r.text)[4]
        if not r.fertility.n_words:
            assert r.fertility.chars_per_token is None and r.kept
    assert fertility.measured(build([]), BYTE_RANKS, public_tokenizers.PATTERN, PIECE_MODEL).collect() == []


def test_scripts():
    assert fertility.script_of("straße é") == "Latin"
    assert fertility.script_of("привет ok") == "Cyrillic"
    assert fertility.script_of("中文字 a") == "Han"
    assert fertility.script_of("1 2 3") is None
    assert fertility.script_of("สวัสดี") == "Thai" and fertility.script_of("ᠮᠣᠩᠭᠣᠯ") == fertility.OTHER


def test_other_scripts_and_letterless_texts(build):
    """Digits and the same few letters over and over are out of band, varied text is not."""
    rng = random.Random(6)

    def words(letters, n=120):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))

    thai, georgian = "".join(map(chr, range(0xE01, 0xE2F))), "".join(map(chr, range(0x10D0, 0x10F1)))
    texts = [words("0123456789"), words("#-/ ."), words("ก"), "ა ა " * 300, words(thai), words(georgian), words(thai, 3)]
    rows = fertility.measured(build(list(enumerate(texts))), BYTE_RANKS, public_tokenizers.PATTERN, PIECE_MODEL)
    kept = dict(rows.select("doc_id", fertility.in_band()).collect())
    assert [kept[i] for i in range(7)] == [False, False, False, False, True, True, True]


def test_rich_texts_are_not_beyond_the_entropy_band(build):
    """Thousands of distinct tokens, and few tokens that are all distinct."""
    with open(BYTE_RANKS, "rb") as lines:
        ranks = bpe.read_ranks(lines)
    words = [t[1:].decode() for t in sorted(ranks, key=ranks.get) if re.fullmatch(rb" [a-z]{4,}", t)]
    texts = [" ".join(words[:n]) for n in (*range(50, 90), 1025, 6000)]
    assert len(words) >= 6000
    rows = fertility.measured(build(list(enumerate(texts))), BYTE_RANKS, public_tokenizers.PATTERN, PIECE_MODEL)
    found = rows.select("fertility", fertility.in_band(None).alias("kept")).collect()
    for r, text in zip(found, texts, strict=True):
        assert r.fertility.n_tokens == len(text.split())
        assert 0.999 < r.fertility.entropy_share <= 1.0 and r.kept
