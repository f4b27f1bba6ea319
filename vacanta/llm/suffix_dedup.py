"""Repeated byte strings across a corpus, by refining buckets of suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts elsewhere.
Bucket-pointer refinement sorts suffixes into buckets by their first q bytes, and splits
a bucket by the buckets of the suffixes at later offsets, so that what one split finds is
used by the next. Sorting every suffix of a corpus would move many times its size, so the
same refinement runs on blocks of neighbouring suffixes:

1. Every start of a string has an anchor: the byte offset, 72 to 327 bytes later, whose
   following eight bytes hash lowest. Equal strings have equal anchors, so strings are
   compared only with strings whose anchor lies at the same distance. The starts that
   share an anchor are one block, about 130 starts on average.
2. A block's bucket is its core: the bytes that all its strings have in common, the q-gram
   around the anchor. A block alone in its bucket repeats nowhere and is done.
3. A block whose union (all bytes of its strings) occurs twice repeats everywhere and is
   done; one of each kind stays as a witness for blocks that still need it.
4. Other blocks are split, by the distance to the anchor, into blocks of 32, 4 and at last
   1 starts. Smaller blocks have longer cores and shorter unions, so buckets split until
   each block is done. Only blocks at the ends of a repeat get that far.

Buckets are keys of partial aggregations and are never gathered. Cores and unions travel
as hashes (a bucket of two cores with one hash is split later; unions have 128 bits). Text
moves only for documents with a shared core, keyed by its own digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.dart_minhash import mix
from vacanta.session import scratch_path

LENGTH = 400
GRAM = 8
NEAREST, REACH = 72, 256  # an anchor's distances from a start: NEAREST up to NEAREST + REACH - 1
STEPS = (32, 4, 1)  # starts in a block after each split
SEGMENT = 1 << 19
# So many text digests of 16 bytes may be broadcast; more are joined by a shuffle.
BROADCAST_TEXTS = 500_000
_PLACE = np.uint64((1 << 20) - 1)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text's strings and the least and largest distance of their starts."""
    found = []
    for first in range(0, max(0, len(data) - LENGTH + 1), SEGMENT):
        part = data[first : first + SEGMENT + LENGTH - 1]
        n = len(part) - GRAM + 1
        grams = np.empty(n, dtype=np.uint64)
        for shift in range(GRAM):
            size = (len(part) - shift) // GRAM
            grams[shift::GRAM] = np.frombuffer(part, dtype="<u8", offset=shift, count=size)
        order = (mix(grams) & ~_PLACE) | np.arange(n, dtype=np.uint64)
        order = order[NEAREST : len(part) - LENGTH + NEAREST + REACH]
        starts = len(order) - REACH + 1
        padded = np.full(-(-len(order) // REACH) * REACH, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(order)] = order
        blocks = padded.reshape(-1, REACH)
        up = np.minimum.accumulate(blocks, axis=1).ravel()
        down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(down[:starts], up[REACH - 1 : REACH - 1 + starts]) & _PLACE
        found.append(least.astype(np.int64) + first)
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    anchor = np.concatenate(found)
    edge = np.flatnonzero(np.diff(anchor)) + 1
    low, high = np.append(0, edge), np.append(edge, len(anchor)) - 1
    at = anchor[low]
    return at, at - high, at - low


def block_hashes(data: bytes, at: int, near: int, size: int) -> tuple[int, bytes]:
    """Hash of the core and of the union of the block of starts at - near - size + 1 .. at - near.

    Where the union reaches over an end of the text it is cut there, and how much was cut
    is part of the hash.
    """
    core = data[at - near : at - near - size + 1 + LENGTH]
    low, high = at - near - size + 1, at - near + LENGTH
    cut = max(0, -low) * 1024 + max(0, high - len(data))
    union = data[max(0, low) : high]
    return xxhash.xxh3_64_intdigest(core) - (1 << 63), xxhash.xxh3_128_digest(union, seed=cut)


_BLOCK = "text_id binary, at int, low smallint, high smallint, near smallint"
_HASHED = f"{_BLOCK}, witness tinyint, core long, whole binary"
_TYPES = [pa.binary(), pa.int32(), pa.int16(), pa.int16(), pa.int16(), pa.int8(), pa.int64(), pa.binary()]
_NAMES = ["text_id", "at", "low", "high", "near", "witness", "core", "whole"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(_TYPES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
    )


def _first_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text_id, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = content.as_py().encode("utf-8", "surrogatepass")
            for at, low, high in zip(*(x.tolist() for x in anchors(data)), strict=True):
                rows.append((text_id, at, low, high, NEAREST, 0, *block_hashes(data, at, NEAREST, REACH)))
            if len(rows) > 20_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _split_blocks(size: int, step: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_id, content, blocks in zip(*batch.columns, strict=True):
                text_id, data = text_id.as_py(), content.as_py().encode("utf-8", "surrogatepass")
                for block in blocks.as_py():
                    at, low, high = block["at"], block["low"], block["high"]
                    for near in range(block["near"], block["near"] + size, step):
                        if near <= high and near + step > low:
                            hashes = block_hashes(data, at, near, step)
                            rows.append((text_id, at, low, high, near, block["witness"], *hashes))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return split


def _refined(blocks: DataFrame, size: int, kept) -> tuple[DataFrame, DataFrame]:
    """Repeated blocks, and blocks (with witnesses) that have to be split."""
    member = F.struct("text_id", "at", "low", "high", "near")
    unions = kept(
        blocks.groupBy("core", "whole").agg(
            F.count("*").alias("n"),
            F.sum(1 - F.col("witness")).alias("n_open"),
            F.min(member).alias("one"),
        )
    )
    is_open = (F.col("n") == 1) & (F.col("n_open") == 1)
    cores = unions.groupBy("core").agg(
        F.count("*").alias("n_unions"), F.sum(is_open.cast("int")).alias("n_alone")
    )
    repeated = unions.filter((F.col("n") > 1) & (F.col("n_open") > 0)).select("core", "whole")
    found = (
        blocks.filter("witness = 0")
        .join(repeated, ["core", "whole"], "left_semi")
        .select("text_id", "at", "low", "high", "near", F.lit(size).alias("size"))
    )
    # A core with one union has nothing left to compare.
    cores = kept(cores.filter("n_unions > 1 and n_alone > 0").select("core"))
    rest = (
        unions.join(cores, "core", "left_semi")
        .select("one.*", F.when(is_open, 0).otherwise(1).cast("tinyint").alias("witness"))
    )
    return found, rest


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, digests, left = [], [], []
        for content, blocks in zip(batch.column(1), batch.column(2), strict=True):
            data = content.as_py().encode("utf-8", "surrogatepass")
            merged: list[list[int]] = []
            ranges = [
                (
                    b["at"] - min(b["high"], b["near"] + b["size"] - 1),
                    b["at"] - max(b["low"], b["near"]) + LENGTH,
                )
                for b in blocks.as_py()
            ]
            for start, end in sorted(ranges):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            cuts = [0, *(x for span in merged for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            spans.append([{"start": s, "end": e} for s, e in merged])
            digests.append(hashlib.sha256(kept).hexdigest())
            left.append(kept.decode("utf-8", "replace"))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, kind), pa.array(digests, pa.string()), pa.array(left, pa.string())],
            names=["text_id", "spans", "kept_sha256", "left"],
        )


def repeated_spans(
    documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: ``keep``, n_bytes, spans, kept_sha256, kept_text.

    ``spans`` are the maximal runs of removed bytes, (start, end) in UTF-8 bytes, end
    exclusive; ``kept_sha256`` is the digest of the bytes outside them and ``kept_text``
    these bytes as text, a character that lost some of its bytes as U+FFFD. A null text is
    empty; texts of fewer than 400 bytes lose nothing. Equal rows and null ids give a row
    each, and equal texts of 400 bytes or more lose everything. No row, no result. Columns
    outside ``keep`` are ignored.
    """
    spark = documents.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "repeats")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    content = F.coalesce(F.col(text), F.lit(""))
    texts = documents.select(F.unhex(F.md5(content)).alias("text_id"), content.alias("text"))
    long_texts = texts.filter(F.octet_length("text") >= LENGTH)
    every = kept(long_texts.mapInArrow(_first_blocks, _HASHED))
    # Written before the join, so that a core with very many blocks can be split there.
    shared = kept(every.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"))
    blocks = kept(every.join(shared, "core", "left_semi"))

    needed = blocks.select("text_id").distinct()
    if needed.count() <= BROADCAST_TEXTS:
        needed = F.broadcast(needed)
    sources = kept(
        long_texts.join(needed, "text_id", "left_semi")
        .groupBy("text_id")
        .agg(F.first("text").alias("text"))
    )

    def with_text(found: DataFrame, *columns: str) -> DataFrame:
        """A text and all its blocks in one row; their number is bounded by its length."""
        listed = found.groupBy("text_id").agg(F.collect_list(F.struct(*columns)).alias("blocks"))
        return sources.join(listed, "text_id").select("text_id", "text", "blocks")

    size, repeats = REACH, None
    for step in (*STEPS, None):
        found, rest = _refined(blocks, size, kept)
        repeats = found if repeats is None else repeats.unionByName(found)
        if step is not None:
            open_blocks = with_text(rest, "at", "low", "high", "near", "witness")
            blocks = kept(open_blocks.mapInArrow(_split_blocks(size, step), _HASHED))
            size = step

    removed = with_text(repeats.distinct(), "at", "low", "high", "near", "size").mapInArrow(
        _removal, "text_id binary, spans array<struct<start:int,end:int>>, kept_sha256 string, left string"
    )
    removed = kept(removed)
    rows = documents.select(
        *(F.col(c).alias(f"_k_{c}") for c in keep),
        F.unhex(F.md5(content)).alias("text_id"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        content.alias("whole"),
    )
    digests = removed.select("text_id")
    if removed.count() <= BROADCAST_TEXTS:  # else texts and digests meet by a shuffle
        digests = F.broadcast(digests)
    none = F.array().cast("array<struct<start:int,end:int>>")
    untouched = rows.join(digests, "text_id", "left_anti").select(
        "*", none.alias("spans"), F.sha2("whole", 256).alias("kept_sha256"), F.col("whole").alias("left")
    )
    touched = rows.drop("whole").join(digests, "text_id", "left_semi").join(removed, "text_id")
    return untouched.drop("whole").unionByName(touched).select(
        *(F.col(f"_k_{c}").alias(c) for c in keep),
        "n_bytes",
        "spans",
        "kept_sha256",
        F.col("left").alias("kept_text"),
    )
