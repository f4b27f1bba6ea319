"""Byte-level BPE encoding and decoding by monoid tree reduction.

A stretch of text is an element of a monoid: the lengths of its pattern pieces and the
packed ids of each piece. ``encode halves recursively``: a text is halved down to leaves,
each leaf is encoded alone, and neighbours are joined by encoding a window around their
border again. The window grows until the pieces outside it provably stay as they are:

* Left of the border, a piece that ends at least ``REACH`` characters before the end of
  its stretch never looked past that end, so it is the same in the longer text.
* Right of the border, the pattern has no look-behind, so its matches depend only on
  where a match starts. Once a stable window piece ends where a piece of the right
  stretch starts, all later pieces are the same.

Inside one very long piece the same reduction runs on tokens. A sequence of tokens is the
BPE encoding of its bytes exactly if every two neighbours are (encoding both together
gives the two back), so a window of tokens is final as soon as its two borders pass that
test; until then it doubles. Decoding concatenates byte strings up the same tree.

Rank file and pattern are arguments. Texts never leave the task that read them, so there
is no shuffle, and a lost executor only costs its own input splits.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_CHARS = 4096
# A piece of the pattern looks at most this many characters past its own end.
REACH = 2
# Pieces of more bytes than this are themselves encoded by halves.
LEAF_BYTES = 256
FIRST_WINDOW = 8
# Pieces kept encoded per Python worker; cleared when full.
CACHED_PIECES = 200_000
DECODE_LEAF = 4096


class _Pieces(dict):
    """Packed ids by piece, found when first asked for; bounded."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self._bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self._bpe._tokens(piece.encode("utf-8", "surrogatepass")))
        if sys.byteorder == "big":
            ids.byteswap()
        packed = ids.tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class ByteBpe:
    """Encodes text to packed little-endian 32-bit ids, and back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._core = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._single = self._core._core_bpe.encode_single_piece
        self._known = _Pieces(self)
        core = self._core._core_bpe
        self.buffer = lambda text: core.encode_to_tiktoken_buffer(text, set())

    # --- tokens of one piece -------------------------------------------------------

    def _tokens(self, piece: bytes) -> list[int]:
        """Token ids of one piece, by halves if it is long."""
        if len(piece) <= LEAF_BYTES:
            return self._single(piece) if piece else []
        half = len(piece) // 2
        return self._join_tokens(self._tokens(piece[:half]), self._tokens(piece[half:]))

    def _fits(self, left: int, right: int) -> bool:
        return self._single(self.tokens[left] + self.tokens[right]) == [
            left,
            right,
        ]

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        size = FIRST_WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            window = self._single(
                b"".join(map(self.tokens.__getitem__, left[a:] + right[:b]))
            )
            if (a == 0 or self._fits(left[a - 1], window[0])) and (
                b == len(right) or self._fits(window[-1], right[b])
            ):
                return left[:a] + window + right[b:]
            size *= 2

    # --- pieces of a text ----------------------------------------------------------

    def _encoded(self, text: str, start: int, end: int) -> tuple[list[str], list[bytes]]:
        """Pieces of text[start:end] and their packed ids, by recursive halving."""
        if end - start <= LEAF_CHARS:
            pieces = self._split(text, start, end) if end > start else []
            return pieces, list(map(self._known.__getitem__, pieces))
        half = (start + end) // 2
        return self._joined(self._encoded(text, start, half), self._encoded(text, half, end))

    def _joined(self, left, right):
        (pieces, ids), (more, more_ids) = left, right
        back, loose = 0, len(pieces)
        while loose and back < REACH:  # pieces that may have looked past the border
            loose -= 1
            back += len(pieces[loose])
        head = "".join(pieces[loose:])
        size = FIRST_WINDOW
        while True:
            taken = min(size, len(more))
            window = self._split(head + "".join(more[:taken]))
            whole = taken == len(more)
            ends, at = {}, len(head)
            for k in range(taken + 1):
                ends[at] = k
                at += len(more[k]) if k < taken else 0
            total, at = at, 0
            if whole:
                kept, resume = window, taken
            else:
                kept, resume = [], None
                for piece in window:
                    at += len(piece)
                    if at + REACH > total:
                        break
                    kept.append(piece)
                    if at in ends:
                        resume = ends[at]
                        break
            if resume is not None:
                del pieces[loose:], ids[loose:]
                pieces += kept
                ids += map(self._known.__getitem__, kept)
                pieces += more[resume:]
                ids += more_ids[resume:]
                return pieces, ids
            size *= 2

    def encode(self, text: str) -> bytes:
        """Packed ids of a text; every match of the pattern is encoded by itself."""
        return b"".join(self._encoded(text, 0, len(text))[1])

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids, concatenated up a tree of halves."""
        ids = memoryview(packed).cast("I")
        if sys.byteorder == "big":
            ids = memoryview(array("I", (int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4))))
        return self._decoded(ids)

    def _decoded(self, ids: memoryview) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self._decoded(ids[:half]) + self._decoded(ids[half:])


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines of base64 token and rank."""
    return {
        base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())
    }


@lru_cache(maxsize=2)
def codec(rank_file: str, pattern: str) -> ByteBpe:
    """One codec per Python worker and vocabulary."""
    with open(rank_file, "rb") as lines:
        return ByteBpe(read_ranks(lines), pattern)


def worker_path(rank_file: str) -> str:
    """Where a worker finds a vocabulary file: its own path, or a file Spark distributed."""
    import os

    return rank_file if os.path.exists(rank_file) else SparkFiles.get(os.path.basename(rank_file))


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType()),
    ]
)


def encode_texts(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    outputs: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded_sha256"),
) -> DataFrame:
    """Encodes the whole text of each row and decodes the ids again.

    One row out for one row in, in any order. ``outputs`` may name n_tokens, ids_sha256
    and decoded_sha256 (lowercase hex), ids (packed little-endian unsigned 32-bit) and
    decoded (text). Null and empty texts give no tokens, the digests of no bytes and an
    empty decoded text. Columns in ``keep`` go through as they are (null ids and repeated
    rows included); any other column, whatever its name, is left out. No row, no result.
    """
    fields = [RESULT[name] for name in outputs]
    narrow = documents.select(*keep, F.col(text).alias("_bpe_text"))
    schema = T.StructType([f for f in narrow.schema.fields if f.name != "_bpe_text"] + fields)
    types = [pa.int64() if f.dataType == T.LongType() else pa.binary() if f.dataType == T.BinaryType() else pa.string() for f in fields]
    n_kept = len(keep)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(worker_path(rank_file), pattern)

        def values(value: str | None) -> tuple:
            ids = bpe.encode(value or "")
            found = {"n_tokens": len(ids) // 4, "ids": ids}
            if "ids_sha256" in outputs:
                found["ids_sha256"] = hashlib.sha256(ids).hexdigest()
            if "decoded_sha256" in outputs or "decoded" in outputs:
                decoded = bpe.decode(ids)
                found["decoded_sha256"] = hashlib.sha256(decoded).hexdigest()
                found["decoded"] = decoded.decode("utf-8", "replace") if "decoded" in outputs else ""
            return tuple(found[name] for name in outputs)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # few results in memory at once
                part = batch.slice(start, 256)
                rows = [values(x.as_py()) for x in part.column(n_kept)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_kept], *columns], names=schema.fieldNames()
                )

    return narrow.mapInArrow(encode, schema)
