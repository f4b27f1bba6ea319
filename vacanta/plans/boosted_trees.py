"""Gradient-boosted regression trees by histograms of gradients and curvatures.

A tree grows level by level. One aggregation per level adds up gradient and curvature per
(node, feature, bin) over all rows, first within tasks; absent labels are no entries, their sums
are the node's less the label's. The histogram is bounded by nodes x (numbers x bins +
labels), so the driver picks the splits: the greatest second-order gain
GL^2/(HL+penalty) + GR^2/(HR+penalty) - G^2/(H+penalty), ties to the smaller feature name and value.
Rows are sampled per tree by a hash of their key, columns per tree by a hash of their name,
so a fit does not depend on how the rows are spread. Rows carry their prediction; it is
written every few trees, so that neither plans nor lost work grow with the number of trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path

BINS = 256
WRITE_EVERY = 5


@dataclass(frozen=True)
class Split:
    """Numbers: left if at most ``value``. Labels (``value`` None): left if absent."""

    column: str
    label: str | None
    value: float | None
    left: float  # weights of the two sides, if no further split follows
    right: float

    def goes_left(self) -> Column:
        if self.label is None:
            return F.col(self.column) <= F.lit(self.value)
        return ~F.col(self.column).cast("string").eqNullSafe(F.lit(self.label))


Tree = dict[int, Split]  # by node: 1 is the root, 2i and 2i + 1 are the sides of i


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def prediction(self) -> Column:
        return reduce(lambda a, t: a + self.rate * tree_value(t), self.trees, F.lit(self.base))


def tree_value(tree: Tree) -> Column:
    def below(node: int, weight: float) -> Column:
        split = tree.get(node)
        if split is None:
            return F.lit(weight)
        return F.when(split.goes_left(), below(2 * node, split.left)).otherwise(below(2 * node + 1, split.right))

    return below(1, 0.0)


def node_of(tree: Tree) -> Column:
    """The node a row has come to; 0 where it stands in a leaf that cannot be split."""

    def below(node: int) -> Column:
        split = tree.get(node)
        if split is None:
            return F.lit(node)
        return F.when(split.goes_left(), below(2 * node)).otherwise(below(2 * node + 1))

    return below(1)


def sampled_columns(names: Sequence[str], tree: int, share: float) -> list[str]:
    """The columns of smallest hash of (name, tree)."""
    order = sorted(names, key=lambda n: hashlib.md5(f"{n}|{tree}".encode()).hexdigest())
    return sorted(order[: max(1, int(share * len(names)))])


def sampled(key: str, tree: int, share: float) -> Column:
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(tree))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(100)) < int(round(100 * share))


def edges(rows: DataFrame, numbers: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Upper ends of the bins: all values if they are few, else quantiles; one scan."""
    if not numbers:
        return {}
    few = [F.array_sort(F.slice(F.collect_set(n), 1, bins + 1)).alias(n) for n in numbers]
    counted = rows.agg(*[F.approx_count_distinct(n).alias(n) for n in numbers]).first()
    many = [n for n in numbers if counted[n] > bins // 2]
    exact = [f for f, n in zip(few, numbers, strict=True) if n not in many]
    share = [i / bins for i in range(1, bins + 1)]
    ranks = [F.percentile_approx(n, share, 100 * bins).alias(n) for n in many]
    found = rows.agg(*exact, *ranks).first()
    return {n: sorted({float(x) for x in found[n] or [] if x is not None}) for n in numbers}


def _binned(column: str, ends: list[float]) -> Column:
    """The upper end of a number's bin; those beyond the last count as the last."""
    last = max(len(ends) - 1, 0)
    at = F.least(F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col(column))), F.lit(last))
    return F.get(F.array(*map(F.lit, ends)), at)


def histogram(rows: DataFrame, tree: Tree, numbers: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """(node, column, label, value, g, h) of the rows' gradients; column '' is the node's total."""

    def entry(column: str, label: Column, value: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), label.cast("string").alias("label"), value.cast("double").alias("value"))

    none = F.lit(None)
    entries = F.array(
        entry("", none, none),
        *(entry(n, none, F.col(f"{n}_bin")) for n in numbers),
        *(entry(n, F.col(n), none) for n in labels),
    )
    return (
        rows.select(node_of(tree).alias("node"), "gradient", F.explode(entries).alias("e"))
        .groupBy("node", "e.column", "e.label", "e.value")
        .agg(F.sum("gradient").alias("g"), F.count(F.lit(1)).cast("double").alias("h"))
    )


def best_splits(found: list, depth: int, penalty: float, least_weight: float) -> Tree:
    """The split of greatest gain of each node of a level, where one gains."""
    totals = {r.node: (r.g, r.h) for r in found if r.column == ""}
    best: dict[int, tuple] = {}

    def offer(node: int, column: str, label: str | None, value: float | None, gl: float, hl: float) -> None:
        g, h = totals[node]
        gr, hr = g - gl, h - hl
        if min(hl, hr) < least_weight:
            return
        gain = gl * gl / (hl + penalty) + gr * gr / (hr + penalty) - g * g / (h + penalty)
        gain = round(gain, 9)
        rank = (-gain, column, label or "", value or 0.0)
        if gain > 0 and (node not in best or rank < best[node][0]):
            best[node] = rank, Split(column, label, value, -gl / (hl + penalty), -gr / (hr + penalty))

    by_number: dict[tuple[int, str], list] = {}
    for r in found:
        if r.node >= 1 << depth and r.column:
            if r.label is not None:
                g, h = totals[r.node]
                offer(r.node, r.column, r.label, None, g - r.g, h - r.h)
            elif r.value is not None:
                by_number.setdefault((r.node, r.column), []).append(r)
    for (node, column), bins in by_number.items():
        bins.sort(key=lambda r: r.value)
        gl, hl = np.cumsum([b.g for b in bins]), np.cumsum([b.h for b in bins])
        for i, b in enumerate(bins[:-1]):
            offer(node, column, None, float(b.value), float(gl[i]), float(hl[i]))
    return {node: split for node, (_, split) in best.items()}


def fit(
    rows: DataFrame,
    labels: Sequence[str],
    numbers: Sequence[str],
    target: str,
    key: str,
    rounds: int = 300,
    depth: int = 4,
    rate: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    penalty: float = 1.0,
    least_weight: float = 1.0,
    bins: int = BINS,
) -> Boosted:
    """Trees for the squared error: gradient = prediction - target, curvature = 1.

    Labels and numbers must be filled. Starts at the target's mean (0 without rows).
    """
    spark = rows.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boosting")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    ends = edges(rows, numbers, bins)
    base = rows.agg(F.avg(target)).first()[0]
    model = Boosted(float(base or 0.0), rate)
    if base is None:
        return model
    bin_columns = {f"{n}_bin": _binned(n, ends[n]) for n in numbers}
    now = kept(
        rows.select(key, *labels, *(F.col(n).cast("double").alias(n) for n in numbers), F.col(target).alias("target"))
        .withColumns(bin_columns)
        .withColumn("predicted", F.lit(model.base))
    )
    written = 0
    for number in range(rounds):
        since = Boosted(0.0, rate, model.trees[written:])
        columns = sampled_columns([*labels, *numbers], number, column_share)
        drawn = now.filter(sampled(key, number, row_share)).withColumn(
            "gradient", F.col("predicted") + since.prediction() - F.col("target")
        )
        tree: Tree = {}
        for level in range(depth):
            found = histogram(
                drawn, tree, [n for n in numbers if n in columns], [n for n in labels if n in columns]
            ).collect()
            splits = best_splits(found, level, penalty, least_weight)
            if not splits:
                break
            tree |= splits
        model.trees.append(tree)
        if len(model.trees) - written == WRITE_EVERY and number + 1 < rounds:
            fresh = Boosted(0.0, rate, model.trees[written:])
            now = kept(now.withColumn("predicted", F.col("predicted") + fresh.prediction()))
            written = len(model.trees)
    return model
