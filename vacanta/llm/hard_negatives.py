"""Hard negatives by a packed R-tree over integer vectors.

Rows are dealt by label and first coordinate into tasks, and each task packs its rows by
sort-tile-recursive order: slabs of labels, slabs of one coordinate within them, tiles of
the next within those, until a leaf holds ``LEAF`` rows. Boxes of leaves are packed
``FAN`` at a time into those of the level above, up to one root. A tree of at most ``TREE``
rows is one row of a table, which is written once and read by every search.

A box bounds each coordinate, so every product of a coordinate with the anchor's lies in
an interval, and so does the inner product. A search goes down from the root with all
anchors at once and drops boxes whose interval misses the wanted scores, lies strictly
below the k-th best so far, or whose labels cannot do. The leaves that are left form a
queue per anchor, best upper bound first, which is taken in steps of 1, 2, 4 ... leaves;
an anchor whose next bound is strictly below all it still needs is done. Ties count
by the smaller id, hence "strictly".

The anchors are a stated set of queries: they go to the tasks in chunks of about
``ANCHORS``, with the k-th best scores of a sixteenth of the trees, which are searched
first. So a task returns few rows besides the final ones. Nothing else is broadcast, and
the driver holds one chunk at a time.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacanta.session import scratch_path

LEAF = 64
FAN = 8
TREE = 16_384
TILED = 3  # coordinates that tiles are cut by
ANCHORS = 4_096
SEED = 16
EXACT = float(1 << 53)
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max

_TREE_TYPE = "tree long, width int, vectors binary, ids binary, labels binary, numbers binary, starts binary"
_HIT_TYPE = "anchor long, slot int, score long, id long, number long"


def usable(rows: DataFrame, vec_id: Column, vector: Column, label: Column, scale: int) -> DataFrame:
    """(id, label, vector, number) of the rows that take part; components become floor(scale * x).

    Rows without id, label or vector and those with a null or non-finite component take no
    part. ``number`` tells repeated rows apart.
    """
    narrow = rows.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    path = scratch_path(rows.sparkSession, "negatives-rows")
    vector = F.col("vector")
    good = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    (
        narrow.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & good)
        .select("id", "label", whole.alias("vector"), F.monotonically_increasing_id().alias("number"))
        .write.parquet(path)
    )
    return rows.sparkSession.read.parquet(path)


def _stacked(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of one width; shorter vectors end in zeros, which add nothing to a product."""
    out = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def str_order(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive order of the rows, and where leaves start."""
    axes = np.argsort(-vectors.var(axis=0), kind="stable")[:TILED] if len(vectors) else np.zeros(0, int)
    leaves: list[np.ndarray] = []

    def tile(rows: np.ndarray, axes: np.ndarray) -> None:
        n = -(-len(rows) // LEAF)
        if n <= 1 or not len(axes):
            leaves.extend(rows[i : i + LEAF] for i in range(0, len(rows), LEAF))
            return
        slabs = int(np.ceil(n ** (1 / len(axes))))
        size = -(-n // slabs) * LEAF
        rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
        for i in range(0, len(rows), size):
            tile(rows[i : i + size], axes[1:])

    by_label = np.argsort(labels, kind="stable")
    starts = np.flatnonzero(np.diff(labels[by_label], prepend=labels[by_label[:1]] - 1)) if len(labels) else []
    begin = 0
    for end in [*starts[1:], len(labels)] if len(labels) else []:
        # Labels of few rows share a slab.
        if end - begin >= LEAF or end == len(labels):
            tile(by_label[begin:end], axes)
            begin = end
    order = np.concatenate(leaves) if leaves else np.zeros(0, int)
    return order, np.cumsum([0, *map(len, leaves)])[:-1].astype(np.int64)


def pack(rows: DataFrame, tree_rows: int = TREE) -> DataFrame:
    """A table of trees over ``rows`` (id, label, vector, number); each row is in one tree.

    Tasks take ranges of (label, first coordinate, number), which no value can make
    larger than its share.
    """
    spark = rows.sparkSession

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tree(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            vectors = _stacked([np.array(v, dtype=np.int64) for v in table["vector"].to_pylist()])
            ids, labels, numbers = (table[c].to_numpy().astype(np.int64) for c in ("id", "label", "number"))
            order, starts = str_order(vectors, labels)
            values = {
                "tree": int(numbers.min()),
                "width": vectors.shape[1],
                "vectors": vectors[order].astype("<i8").tobytes(),
                "ids": ids[order].astype("<i8").tobytes(),
                "labels": labels[order].astype("<i8").tobytes(),
                "numbers": numbers[order].astype("<i8").tobytes(),
                "starts": starts.astype("<i8").tobytes(),
            }
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values.values(), types, strict=True)], names=list(values)
            )

        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, tree_rows - n)
                batch = batch.slice(taken.num_rows)
                waiting.append(taken)
                n += taken.num_rows
                if n == tree_rows:
                    yield tree(waiting)
                    waiting, n = [], 0
        if n:
            yield tree(waiting)

    tasks = max(1, -(-rows.count() // tree_rows))
    first = F.get("vector", F.lit(0))
    path = scratch_path(spark, "negatives-trees")
    (
        rows.repartitionByRange(tasks, "label", first, "number")
        .sortWithinPartitions("label", first, "number")
        .select("id", "label", "vector", "number")
        .mapInArrow(build, _TREE_TYPE)
        .write.parquet(path)
    )
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Queries:
    """Anchors and, for each, slots of wanted scores: at least ``low``, at most ``high``."""

    vectors: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    low: np.ndarray  # anchors x slots
    high: np.ndarray
    same_label: bool
    k: int


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact product of integer matrices: in floats where they hold every sum, else in integers."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), dtype=np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if most >= 2.0**62:
        raise ValueError("scores of these vectors leave 64 bits")
    return a @ b


def _levels(vectors: np.ndarray, labels: np.ndarray, starts: np.ndarray):
    """Boxes of all levels, leaves first: (low, high, least label, greatest label)."""
    level = (
        np.minimum.reduceat(vectors, starts),
        np.maximum.reduceat(vectors, starts),
        np.minimum.reduceat(labels, starts),
        np.maximum.reduceat(labels, starts),
    )
    found = [level]
    while len(level[0]) > 1:
        at = np.arange(0, len(level[0]), FAN)
        level = tuple(f.reduceat(x, at) for f, x in zip((np.minimum, np.maximum) * 2, level, strict=True))
        found.append(level)
    return found


class Search:
    """The best rows of every slot of some queries, over the trees of one task."""

    def __init__(self, queries: Queries):
        self.q = queries
        self.best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        self.need = queries.low.copy()  # no lower score can count

    def _widened(self, width: int) -> np.ndarray:
        v = self.q.vectors
        return np.pad(v[:, :width], ((0, 0), (0, max(0, width - v.shape[1]))))

    def _admitted(self, level, anchors: np.ndarray, above: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of (anchor, box), and which boxes may hold wanted rows."""
        low, high, least, greatest = level
        positive, negative = np.maximum(anchors, 0), np.minimum(anchors, 0)
        upper = _product(positive, high.T) + _product(negative, low.T)
        lower = _product(positive, low.T) + _product(negative, high.T)
        mine = self.q.labels[:, None]
        if self.q.same_label:
            able = (least <= mine) & (mine <= greatest)
        else:
            able = (least != mine) | (greatest != mine)
        if above is not None:
            able &= np.repeat(above, FAN, axis=1)[:, : able.shape[1]]
        wanted = np.zeros_like(able)
        for slot in range(self.need.shape[1]):
            need, most = self.need[:, slot, None], self.q.high[:, slot, None]
            wanted |= (need <= most) & (upper >= need) & (lower <= most)
        return upper, able & wanted

    def tree(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> None:
        anchors = self._widened(vectors.shape[1])
        levels = _levels(vectors, labels, starts)
        admitted, upper = None, None
        for level in reversed(levels):
            upper, admitted = self._admitted(level, anchors, admitted)
            if not admitted.any():
                return
        # The queue: admitted leaves of each anchor, best upper bound first.
        upper = np.where(admitted, upper, LEAST)
        queue = np.argsort(-upper.astype(np.float64), axis=1, kind="stable")
        length = admitted.sum(axis=1)
        ends = np.append(starts[1:], len(vectors))
        taken, step = 0, 1
        while taken < length.max():
            some = np.arange(taken, min(taken + step, queue.shape[1]))
            leaf = queue[:, some]
            least = np.where(self.need <= self.q.high, self.need, MOST).min(axis=1)
            active = (some < length[:, None]) & (np.take_along_axis(upper, leaf, axis=1) >= least[:, None])
            if not active.any():
                break
            row, column = np.nonzero(active)
            at = leaf[row, column]
            order = np.argsort(at, kind="stable")
            row, at = row[order], at[order]
            cuts = np.flatnonzero(np.diff(at, prepend=-1))
            for begin, end in zip(cuts, [*cuts[1:], len(at)], strict=True):
                here = slice(starts[at[begin]], ends[at[begin]])
                self._leaf(row[begin:end], anchors, vectors[here], ids[here], labels[here], numbers[here])
            taken += step
            step *= 2

    def _leaf(self, row, anchors, vectors, ids, labels, numbers) -> None:
        scores = _product(anchors[row], vectors.T)
        same = labels == self.q.labels[row, None]
        able = same & (numbers != self.q.numbers[row, None]) if self.q.same_label else ~same
        for slot in range(self.need.shape[1]):
            hits = able & (scores >= self.need[row, slot, None]) & (scores <= self.q.high[row, slot, None])
            for i in np.flatnonzero(hits.any(axis=1)):
                a = int(row[i])
                best = self.best.setdefault((a, slot), [])
                for j in np.flatnonzero(hits[i]).tolist():
                    found = (-int(scores[i, j]), int(ids[j]), int(numbers[j]))
                    if len(best) < self.q.k or found < best[-1]:
                        bisect.insort(best, found)
                        del best[self.q.k :]
                if len(best) == self.q.k:
                    self.need[a, slot] = max(self.need[a, slot], -best[-1][0])

    def rows(self) -> pa.RecordBatch:
        found = [(int(self.q.numbers[a]), slot, -s, i, n) for (a, slot), best in self.best.items() for s, i, n in best]
        columns = zip(*found, strict=True) if found else [()] * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("anchor", "slot", "score", "id", "number")
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def _searching(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, numbers, starts = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels", "numbers", "starts"))
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), row["width"])
                search.tree(vectors, ids, labels, numbers, starts)
        yield search.rows()

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "number")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _found(trees: DataFrame, queries: Queries) -> DataFrame:
    """The k best rows of every slot: those of some trees first, then what can still count."""
    spark = trees.sparkSession
    seed = F.pmod(F.xxhash64("tree"), F.lit(SEED)) == 0
    path = scratch_path(spark, "negatives-hits")
    first = trees.filter(seed).mapInArrow(_searching(spark.sparkContext.broadcast(queries)), _HIT_TYPE)
    _best(first, queries.k).write.parquet(path)
    first = spark.read.parquet(path)
    at = {int(n): i for i, n in enumerate(queries.numbers)}
    low = queries.low.copy()
    # At most one row for each slot of the chunk.
    for r in first.filter(F.col("rank") == queries.k).select("anchor", "slot", "score").collect():
        low[at[r.anchor], r.slot] = max(low[at[r.anchor], r.slot], r.score)
    rest = Queries(queries.vectors, queries.labels, queries.numbers, low, queries.high, queries.same_label, queries.k)
    others = trees.filter(~seed).mapInArrow(_searching(spark.sparkContext.broadcast(rest)), _HIT_TYPE)
    return _best(first.drop("rank").unionByName(others), queries.k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    chunk: int = ANCHORS,
    tree_rows: int = TREE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` are (id, label, vector, number) as of ``usable``. An anchor's positives are the
    ``positives`` other rows of its label with the greatest inner products. For each, the
    ``negatives`` best rows of other labels whose score is at least ``percent`` of the
    positive's and not above it; a negative positive score leaves no such range. Rows are
    ordered by score, then by id; repeated rows each count, as anchors too. Vectors of
    unequal length are filled with zeros. Scores beyond 64 bits raise an error. No row or no
    anchor, no result.
    """
    spark = rows.sparkSession
    trees = pack(rows, tree_rows)
    asked = rows.filter(is_anchor)
    n = asked.count()
    chunks = max(1, -(-n // chunk))
    folder = scratch_path(spark, "negatives-found")
    part = F.pmod(F.xxhash64("number"), F.lit(chunks))
    for c in range(chunks):
        # One chunk of a stated size, not all anchors.
        anchors = asked.filter(part == c).select("id", "label", "vector", "number").toPandas()
        vectors = _stacked([np.array(v, dtype=np.int64) for v in anchors["vector"]])
        labels, numbers, ids = (anchors[x].to_numpy(dtype=np.int64) for x in ("label", "number", "id"))
        all_scores = np.full((len(anchors), 1), LEAST), np.full((len(anchors), 1), MOST)
        best = _found(trees, Queries(vectors, labels, numbers, *all_scores, True, positives)).collect()
        at = {int(x): i for i, x in enumerate(numbers)}
        low = np.full((len(anchors), positives), MOST)
        high = np.full((len(anchors), positives), LEAST)
        for r in best:
            low[at[r.anchor], r["rank"] - 1] = -(-percent * r.score // 100)
            high[at[r.anchor], r["rank"] - 1] = r.score
        found = _found(trees, Queries(vectors, labels, numbers, low, high, False, negatives))
        named = spark.createDataFrame(
            [(r.anchor, r["rank"] - 1, int(ids[at[r.anchor]]), r.id, r.score) for r in best],
            "anchor long, slot int, anchor_id long, positive_id long, positive_score long",
        )
        found.join(F.broadcast(named), ["anchor", "slot"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)
