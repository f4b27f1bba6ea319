"""Quality by tokeniser fertility: how public vocabularies cut a text into tokens.

Two vocabularies measure each word by itself, the byte-level one with the space before
it, the other one with byte fallback:

* characters per token: low where the vocabulary does not know the words;
* byte-fallback share: tokens that are single bytes because no piece fits;
* token entropy of a text, divided by the largest entropy so many tokens (1,024 at most)
  can have, and at most 1. It is low where few tokens make up the text, however long it is.

Each measure has a band per language, or per script where the language has no band. A
text outside a band is rejected. Bands are wide: a text has to be far from prose to fall
outside. Measures need ``MIN_TOKENS`` tokens to mean anything, so shorter texts pass.

All words of a text count. The work is one pass without a shuffle; words met before are
looked up in a bounded dictionary, so a repeated word is encoded once per worker.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.llm.bpe import codec, worker_path

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_TOKENS = 50
CACHED_WORDS = 150_000
SLICE = 128  # texts measured at once
# Prose uses few distinct tokens however long it is; entropy is compared with so many.
ENTROPY_TOKENS = 1024


@dataclass(frozen=True)
class Band:
    """Accepted ranges, ends included."""

    chars_per_token: tuple[float, float]
    chars_per_piece: tuple[float, float]
    fallback_share: tuple[float, float] = (0.0, 0.25)
    entropy_share: tuple[float, float] = (0.5, 1.0)


SCRIPTS = (
    "Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Han", "Hangul", "Hiragana", "Katakana", "Thai", "Devanagari",
    "Bengali", "Tamil", "Armenian", "Georgian",
)
OTHER = "other"  # letters of no script above

MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("chars_per_token", T.DoubleType()),
        T.StructField("chars_per_piece", T.DoubleType()),
        T.StructField("fallback_share", T.DoubleType()),
        T.StructField("entropy_share", T.DoubleType()),
        T.StructField("script", T.StringType()),
    ]
)


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words inside a window of ``width`` words that occurs twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    top = int(ids.max()) + 1
    key = ids[:n].astype(np.int64)
    for k in range(1, width):
        if top ** (k + 1) >= 2**62:  # too many for one number: number the prefixes first
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * top + ids[k : n + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice)
    edge = np.zeros(len(ids) + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


@lru_cache(maxsize=2)
def _pieces(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


class Vocabulary:
    """What both vocabularies make of each word met so far; bounded, numbered by word."""

    def __init__(self, bpe, pieces):
        self._buffer, self._pieces = bpe.buffer, partial(pieces.encode, num_threads=1)
        self._token_bytes = np.array([len(t) for t in bpe.tokens], dtype=np.int64)
        self._is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.n_tokens = self.n_pieces = self.n_bytes = np.zeros(0, dtype=np.int64)
        self.tokens = np.zeros(0, dtype=np.int32)

    def learn(self, words: set[str]) -> None:
        """Numbers and encodes the words that are not known yet, all in one call."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > max(CACHED_WORDS, len(words)):
            self._forget()
            new = list(words)
        if not new:
            return
        # One text of all words: no match of the pattern holds more than one space before
        # a word, so cutting the ids at the words' bytes gives each word's own ids.
        tokens = np.frombuffer(self._buffer("".join(" " + w for w in new)), dtype="<u4").astype(np.int32)
        ends = np.cumsum(self._token_bytes[tokens])
        word_ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in new])
        cut = np.searchsorted(ends, word_ends, side="right")
        pieces = self._pieces(new)
        n_pieces = np.fromiter(map(len, pieces), np.int64, len(pieces))
        byte = self._is_byte[np.fromiter(chain.from_iterable(pieces), np.int64, int(n_pieces.sum()))]
        so_far = np.concatenate([[0], np.cumsum(byte)])
        n_bytes = np.diff(so_far[np.concatenate([[0], np.cumsum(n_pieces)])])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.n_tokens = np.concatenate([self.n_tokens, np.diff(cut, prepend=0)])
        self.n_pieces = np.concatenate([self.n_pieces, n_pieces])
        self.n_bytes = np.concatenate([self.n_bytes, n_bytes])
        self.tokens = np.concatenate([self.tokens, tokens])


_SCRIPT = {name: regex.compile(rf"\p{{Script={name}}}") for name in SCRIPTS}


_LATIN = regex.compile(r"\p{Script=Latin}").search
_NOT_LATIN = regex.compile(r"[\p{L}--\p{Script=Latin}]", regex.V1).search
_WORD = re.compile(r"[^\x20\x09-\x0D]+").findall


def script_of(text: str) -> str | None:
    """The script of most letters among those of ``SCRIPTS``, else ``OTHER``; None without letters."""
    if not _NOT_LATIN(text):
        return "Latin" if _LATIN(text) else None
    letters = {name: len(found.findall(text)) for name, found in _SCRIPT.items()}
    best = max(letters, key=letters.get)
    return best if letters[best] else OTHER


def measures(texts: list[str | None], known: Vocabulary) -> list[tuple]:
    """The fields of ``MEASURES`` for each text."""
    texts = [t or "" for t in texts]
    words = [_WORD(t) for t in texts]
    known.learn(set().union(*words))
    n_words = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.fromiter(map(known.number.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
    of = np.repeat(np.arange(len(texts)), n_words)
    size = len(texts)

    def total(values, at):
        return np.bincount(at, weights=values, minlength=size)

    n_tokens = total(known.n_tokens[codes], of).astype(np.int64)
    n_pieces = total(known.n_pieces[codes], of)
    n_bytes = total(known.n_bytes[codes], of)

    # Entropy: distinct words of each text, their tokens weighted by the words' counts.
    top = len(known.number) + 1
    pair, times = np.unique(of * top + codes, return_counts=True)
    at, code = pair // top, pair % top
    starts = np.cumsum(known.n_tokens) - known.n_tokens
    lengths = known.n_tokens[code]
    step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    token = known.tokens[np.repeat(starts[code], lengths) + step]
    top = int(token.max(initial=0)) + 1
    key = np.repeat(at, lengths) * top + token
    order = np.argsort(key)
    key, weight = key[order], np.repeat(times, lengths)[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.add.reduceat(weight, first) if len(first) else np.zeros(0)
    at = key[first] // top
    p = count / n_tokens[at]
    entropy = total(-p * np.log2(p), at)

    rows, end = [], 0
    for i, text in enumerate(texts):
        start, end = end, end + len(words[i])
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        chars = len(text) - sum(map(text.count, SPACE))
        base = (
            len(words[i]),
            chars,
            sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated_words(codes[start:end]),
        )
        n = int(n_tokens[i])
        if not n:
            rows.append((*base, 0, None, None, None, None, None))
            continue
        rows.append(
            (
                *base,
                n,
                chars / n,
                chars / max(1.0, float(n_pieces[i])),
                float(n_bytes[i]) / max(1.0, float(n_pieces[i])),
                min(1.0, float(entropy[i]) / math.log2(min(n, ENTROPY_TOKENS))) if n > 1 else 1.0,
                script_of(text),
            )
        )
    return rows


# Lower ends of characters per token lie three per cent and more under what prose of that
# language measures with a multilingual vocabulary of 50,000 tokens.
BANDS = {
    "en": Band(chars_per_token=(1.97, 12.0), chars_per_piece=(1.80, 12.0)),
    "de": Band(chars_per_token=(2.02, 12.0), chars_per_piece=(1.85, 12.0)),
    "es": Band(chars_per_token=(1.85, 12.0), chars_per_piece=(1.60, 12.0)),
    "fr": Band(chars_per_token=(1.86, 12.0), chars_per_piece=(1.65, 12.0)),
    "Latin": Band(chars_per_token=(1.5, 12.0), chars_per_piece=(1.5, 12.0)),
    "Cyrillic": Band(chars_per_token=(1.0, 12.0), chars_per_piece=(1.0, 12.0)),
    "Greek": Band(chars_per_token=(0.8, 12.0), chars_per_piece=(0.8, 12.0), fallback_share=(0, 0.4)),
    "Arabic": Band(chars_per_token=(0.8, 12.0), chars_per_piece=(0.8, 12.0), fallback_share=(0, 0.4)),
    "Hebrew": Band(chars_per_token=(0.7, 12.0), chars_per_piece=(0.7, 12.0), fallback_share=(0, 0.4)),
    "Han": Band(chars_per_token=(0.3, 4.0), chars_per_piece=(0.3, 4.0), fallback_share=(0, 0.8)),
    "Hangul": Band(chars_per_token=(0.3, 4.0), chars_per_piece=(0.3, 4.0), fallback_share=(0, 0.9)),
    "Hiragana": Band(chars_per_token=(0.3, 4.0), chars_per_piece=(0.3, 4.0), fallback_share=(0, 0.8)),
    "Katakana": Band(chars_per_token=(0.3, 4.0), chars_per_piece=(0.3, 4.0), fallback_share=(0, 0.8)),
    # Scripts that the vocabularies hold few pieces of: characters fall back to their bytes,
    # whose entropy is low, so only the repetition of very few of them is far from prose.
    **{
        name: Band(chars_per_token=(0.3, 6.0), chars_per_piece=(0.3, 6.0), fallback_share=(0, 1), entropy_share=(0.25, 1.0))
        for name in ("Thai", "Devanagari", "Bengali", "Tamil", "Armenian", "Georgian", OTHER)
    },
}


def measured(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    model_file: str,
    text: str = "text",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """The columns in ``keep`` (None: all) and ``fertility``, a struct of ``MEASURES``.

    Null and empty texts have no words and null ratios. There is one row out for each row
    in, repeated rows and null ids included; a column already called ``fertility`` is
    replaced. No row, no result.
    """
    kept = [c for c in (documents.columns if keep is None else keep) if c != "fertility"]
    rest = documents.select(*kept, F.col(text).alias("_fertility_text")) if text not in kept else documents.select(*kept)
    at = len(kept) if text not in kept else kept.index(text)
    schema = T.StructType([*rest.schema.fields[: len(kept)], T.StructField("fertility", MEASURES)])
    kind = pa.struct(
        [
            (f.name, {"bigint": pa.int64(), "double": pa.float64()}.get(f.dataType.simpleString(), pa.string()))
            for f in MEASURES.fields
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(codec(worker_path(rank_file), pattern), _pieces(worker_path(model_file)))
        names = MEASURES.fieldNames()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                found = measures(part.column(at).to_pylist(), known)
                rows = [dict(zip(names, x, strict=True)) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(rows, kind)], names=schema.fieldNames()
                )

    return rest.mapInArrow(measure, schema)


def base_failed(found: str = "fertility"):
    """Fewer than 50 words, or more than half of them in repeated three-word windows."""
    n, again = F.col(f"{found}.n_words"), F.col(f"{found}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)


def in_band(
    language=None, bands: dict[str, Band] | None = None, found: str = "fertility"
):
    """True where all measures lie in the band of the language, else of the script.

    ``language`` is a Column or None. A text of fewer than ``MIN_TOKENS`` tokens or without
    words is in band: nothing speaks against it. Longer ones without any letter are not,
    whatever their language is said to be. A script that ``bands`` lacks accepts all.
    """
    bands = BANDS if bands is None else bands
    language = F.lit(None).cast("string") if language is None else language
    script = F.col(f"{found}.script")
    key = F.when(language.isin([*bands]) & script.isNotNull(), language).otherwise(script)
    inside = F.lit(True)
    for name, band in bands.items():
        own = F.lit(True)
        for measure in ("chars_per_token", "chars_per_piece", "fallback_share", "entropy_share"):
            low, high = getattr(band, measure)
            own = own & F.col(f"{found}.{measure}").between(low, high)
        inside = F.when(key.eqNullSafe(name), own).otherwise(inside)
    return F.when(F.col(f"{found}.n_tokens") < MIN_TOKENS, True).otherwise(script.isNotNull() & F.coalesce(inside, F.lit(True)))
