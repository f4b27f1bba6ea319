"""Near-duplicates by DartMinHash: sparse weighted signatures, banded join, exact check.

An element of weight w owns the strip [0, w) of a plane whose other axis is the rank.
Darts hit the plane at unit rate; where and in which order follows from a hash of the
element alone, so equal elements see equal darts in all documents. Every dart belongs to
one of ``k`` coordinates. A document keeps, per coordinate, the dart of lowest rank among
those inside its elements' strips. Two documents agree in a coordinate with a probability
equal to their weighted Jaccard similarity. Only ranks up to (k ln k + 2k) / weight are
looked at, which leaves no coordinate empty as a rule (else the range doubles), so a
signature costs about k ln k hashes however many elements there are beyond that.

Equal texts are one node. Bands of eight coordinates put texts into buckets: at a
similarity of 0.8 a pair shares one of 40 buckets with probability 0.9994, at 0.85 with
more than 0.99999. Every pair of a bucket is checked exactly on the whole texts, whatever
the bucket's size. The pairs of a bucket of up to ``WHOLE`` texts are rows. A larger one is
cut into blocks, and a task compares two blocks at a time by products of their shingle
tables; it returns how many links each text has there and a forest of links that connects
the same texts, not the links. A pair that shares several large buckets counts in the first
of them, and not as a row. So the comparisons grow with the square of a bucket, but rows
only with its texts times its blocks. Classes are the connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.components import connected
from vacanta.session import scratch_path

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 8
# Buckets of more texts are compared by blocks of about so many texts or shingles; the
# results are the same.
WHOLE = 8
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 4_000_000
COLUMNS = 4096
CACHED_WORDS = 500_000
# So many text digests of 16 bytes may be broadcast.
BROADCAST_TEXTS = 500_000
_M = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def shingles(text: str | None, hashes: _WordHashes, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles, ascending, and how often each occurs.

    Words are what white space separates. A text of fewer words than a shingle has one
    shingle of all its words; a text without words has none.
    """
    words = (text or "").split()
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    found = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        found = mix(found * _M + h[i : i + n])
    return np.unique(found, return_counts=True)


def dart_signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The id of the first dart of each of ``k`` coordinates; weights are positive."""
    budget = (k * math.log(k) + 2 * k) / float(weights.sum())
    while True:
        ranks, places, ids = [], [], []
        area, low, width = 0, 0.0, 1.0
        while True:
            at = np.flatnonzero(weights > low)
            if not len(at):
                break
            mean = budget * width
            block = max(1, math.ceil(mean + 2 * math.sqrt(mean))) if mean >= 1 else 1
            rank, number = np.zeros(len(at)), 0
            while len(at):
                step = np.arange(number, number + block, dtype=np.uint64)
                seed = mix(elements[at, None] + (step + np.uint64(area << 40)) * _M)
                gap = -np.log(((mix(seed + np.uint64(1)) >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / width
                reached = rank[:, None] + np.cumsum(gap, axis=1)
                over = low + (mix(seed + np.uint64(2)) >> np.uint64(11)) * 2.0**-53 * width
                hit = (reached < budget) & (over < weights[at, None])
                ranks.append(reached[hit])
                ids.append(seed[hit])
                more = reached[:, -1] < budget
                at, rank, number = at[more], reached[more, -1], number + block
            area, low, width = area + 1, low + width, max(1.0, low + width)
        rank, dart = np.concatenate(ranks), np.concatenate(ids)
        place = (mix(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank))
        filled, first = np.unique(place[order], return_index=True)
        if len(filled) == k:
            return dart[order][first]
        budget *= 2


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    found = np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        found = mix(found * _M + signature[r::rows][:bands])
    return found


def _signatures(texts: DataFrame, weighted: bool, bands: int, rows: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        for batch in batches:
            keys, found, sizes = [], [], []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:  # copies in one task need one signature
                    continue
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen.add(key)
                elements, counts = shingles(content.as_py(), hashes)
                if len(elements):
                    weights = counts.astype(float) if weighted else np.ones(len(elements))
                    signature = dart_signature(elements, weights, bands * rows)
                    keys.append(key)
                    found.append(band_hashes(signature, bands, rows).view(np.int64).tolist())
                    sizes.append(int(counts.sum()) if weighted else len(elements))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                names=["key", "bands", "size"],
            )

    return texts.mapInArrow(sign, "key binary, bands array<long>, size long")


def _similar(pairs: DataFrame, weighted: bool, similarity: float) -> DataFrame:
    """(a, b) of the rows (a, b, text_a, text_b) with the similarity or more."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, held = _WordHashes(), None, None
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                hub = batch.column(1)[i].as_py()
                if hub != last:
                    last, held = hub, shingles(batch.column(3)[i].as_py(), hashes)
                own = shingles(batch.column(2)[i].as_py(), hashes)
                _, x, y = np.intersect1d(own[0], held[0], assume_unique=True, return_indices=True)
                if weighted:
                    shared = int(np.minimum(own[1][x], held[1][y]).sum())
                    total = int(own[1].sum() + held[1].sum()) - shared
                else:
                    shared = len(x)
                    total = len(own[0]) + len(held[0]) - shared
                if total and shared >= similarity * total:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))],
                names=["a", "b"],
            )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``a`` shares with each set of ``b``."""
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    found = np.zeros((len(a), len(b)), dtype=np.int64)
    if not len(shared):
        return found

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        known = shared[at] == values
        at, of = at[known], of[known]
        order = np.argsort(at, kind="stable")
        return at[order], of[order]

    (at_a, of_a), (at_b, of_b) = placed(a), placed(b)
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        tables = []
        for at, of, n in ((at_a, of_a, len(a)), (at_b, of_b, len(b))):
            start, end = np.searchsorted(at, (low, low + width))
            table = np.zeros((n, width), dtype=np.float32)
            table[of[start:end], at[start:end] - low] = 1
            tables.append(table)
        found += np.rint(tables[0] @ tables[1].T).astype(np.int64)
    return found


def _unary(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set that holds an element as often as it counts, each time as another one."""
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(elements, counts) + nth.astype(np.uint64) * _M)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix connects, without a circle."""
    left, found = np.ones(len(linked), dtype=bool), []
    for start in range(len(linked)):
        if left[start]:
            left[start], stack = False, [start]
            while stack:
                u = stack.pop()
                new = np.flatnonzero(linked[u] & left)
                left[new] = False
                found += [(u, int(v)) for v in new]
                stack += new.tolist()
    return found


def _by_blocks(texts: DataFrame, weighted: bool, similarity: float) -> DataFrame:
    """(a, b, n) of the texts (key, text, large): b null, n links of a; or a link of a forest.

    ``large`` holds a text's large buckets and the number of blocks of each.
    """

    def compare(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_pylist()
        bucket, i, j = (group.column(c)[0].as_py() for c in ("bucket", "i", "j"))
        own = np.asarray(group.column("own").to_pylist())
        hashes = _WordHashes()
        sets = []
        for content in group.column("text"):
            elements, counts = shingles(content.as_py(), hashes)
            sets.append(_unary(elements, counts) if weighted else elements)
        earlier = [np.array([b for b in x if b < bucket], dtype=np.int64) for x in group.column("buckets").to_pylist()]
        x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
        none = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        if not len(x) or not len(y):
            return none
        hit = overlaps([earlier[k] for k in x], [earlier[k] for k in y]) == 0
        if i == j:
            hit &= ~np.eye(len(x), dtype=bool)
        x_left, y_left = hit.any(axis=1), hit.any(axis=0)
        x, y, hit = x[x_left], y[y_left], hit[np.ix_(x_left, y_left)]
        if not len(x):
            return none
        shared = overlaps([sets[k] for k in x], [sets[k] for k in y])
        size = np.array([len(s) for s in sets])
        total = size[x][:, None] + size[y][None, :] - shared
        hit &= shared >= similarity * total
        linked = np.zeros((len(keys), len(keys)), dtype=bool)
        linked[np.ix_(x, y)] = hit
        linked |= linked.T
        degrees = linked.sum(axis=1)
        rows = [(keys[k], None, int(degrees[k])) for k in np.flatnonzero(degrees)]
        rows += [(*sorted((keys[u], keys[v])), None) for u, v in forest(linked)]
        a, b, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(n, pa.int64())})

    own = F.pmod(F.xxhash64("key", "in.bucket"), "in.blocks")
    return (
        texts.select("key", "text", F.col("large.bucket").alias("buckets"), F.explode("large").alias("in"))
        .select("key", "text", "buckets", "in.bucket", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("in.blocks") - 1)).alias("other"))
        .select("key", "text", "buckets", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .groupBy("bucket", "i", "j")
        .applyInArrow(compare, "a binary, b binary, n long")
    )


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    weighted: bool = False,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_copies, n_links, text_md5, first.

    ``class_id`` is the smallest id of the documents that links connect, ``n_copies`` the
    documents of equal text (itself included), ``n_links`` the number of other texts found
    similar to its own. ``first`` is true for the document that stands for its class: the
    one whose id is ``class_id``, in a class without ids those of its smallest digest. ``weighted`` weighs a shingle by its number of occurrences, in
    signature and check; otherwise every distinct shingle weighs 1.

    A null text counts as empty; texts without words are linked only to equal texts. A
    row without id belongs to its class but is never its id (a class of such rows has a
    null class_id). Repeated rows give a row each. No row, no result. Other columns are
    ignored, so their names cannot clash.
    """
    spark = documents.sparkSession

    def kept(name: str, frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"near-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    content = F.coalesce(F.col(text), F.lit(""))
    keyed = documents.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.md5(content)).alias("key"), content.alias("text")
    )
    members = kept("members", keyed.select("doc_id", "key"))
    signed = kept(
        "signatures",
        _signatures(keyed.select("key", "text"), weighted, bands, rows)
        .groupBy("key")
        .agg(F.first("bands").alias("bands"), F.first("size").alias("size")),
    )
    placed = signed.select("key", "size", F.explode("bands").alias("bucket"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("size") / BLOCK_SHINGLES)).alias("blocks")
    # Written before the join, so that a bucket of very many texts can be split there.
    shared = kept("shared", placed.groupBy("bucket").agg(F.count("*").alias("n"), blocks).filter("n > 1"))
    places = kept("places", placed.select("key", "bucket").join(shared, "bucket"))

    # All pairs of small buckets that share no large one, where they are compared by blocks.
    large = kept(
        "large",
        places.filter(F.col("n") > WHOLE).groupBy("key").agg(F.collect_list(F.struct("bucket", "blocks")).alias("large")),
    )
    small = places.filter(F.col("n") <= WHOLE).join(
        large.select("key", F.col("large.bucket").alias("others")), "key", "left"
    )
    apart = ~F.coalesce(F.arrays_overlap("others_a", "others_b"), F.lit(False))
    whole = (
        small.select("bucket", F.col("key").alias("a"), F.col("others").alias("others_a"))
        .join(small.select("bucket", F.col("key").alias("b"), F.col("others").alias("others_b")), "bucket")
        .filter("a < b")
        .filter(apart)
        .select("a", "b")
    )
    pairs = kept("pairs", whole.distinct())

    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(large.select("key")).distinct()
    if needed.count() <= BROADCAST_TEXTS:  # else texts and keys meet by a shuffle
        needed = F.broadcast(needed)
    texts = (
        keyed.select("key", "text")
        .join(needed, "key", "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    texts = kept("texts", texts)
    compared = (
        pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    )
    links = kept("links", _similar(compared, weighted, similarity))
    by_blocks = kept("by-blocks", _by_blocks(texts.join(large, "key"), weighted, similarity))
    classes = connected(links.unionByName(by_blocks.filter("b is not null").select("a", "b")))
    degree = (
        links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n"))
        .unionByName(by_blocks.filter("b is null").select(F.col("a").alias("node"), "n"))
        .groupBy("node")
        .agg(F.sum("n").alias("n_links"))
    )
    counted = (
        members.groupBy("key")
        .agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"))
        .join(classes.join(degree, "node"), F.col("key") == F.col("node"), "left")
        .select("key", "least", "n_copies", F.coalesce("component", "key").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    counted = kept("classes", counted)
    # The first text of a class: smallest id, then smallest digest, texts without ids last.
    order = F.struct(F.col("least").isNull().alias("none"), "least", "key")
    whole_class = counted.groupBy("class").agg(
        F.min(order).alias("of"), F.sum("n_copies").alias("class_size")
    )
    whole_class = kept("whole-classes", whole_class)  # written: a hot class can be split
    by_key = counted.join(whole_class, "class").select(
        "key",
        F.col("of.least").alias("class_id"),
        F.col("of.key").alias("first_key"),
        "class_size",
        "n_copies",
        "n_links",
    )
    first = (F.col("key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return members.join(by_key, "key").select(
        "doc_id",
        "class_id",
        "class_size",
        "n_copies",
        "n_links",
        F.col("key").alias("text_md5"),
        first.alias("first"),
    )
