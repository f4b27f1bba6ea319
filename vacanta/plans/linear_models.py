"""Linear and ridge regression from sums of products, all folds from one scan.

A row is its labels (one 1 each), its numbers, 1 and the target. One aggregation adds up the
products of all pairs of a row's entries per part of the table (fold, or held-out rows);
most entries of a row are absent labels, which take part in no product. Everything
else is arithmetic on these sums: the training part of a fold is the whole minus the fold, means
and deviations for scaling are in the sums, and so are the squared errors on the part
left out. So a comparison of any number of penalties over any number of folds reads the rows once.

The sums number at most (labels + numbers + 2) squared per part and are held by the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE, TARGET = "1", "y"


def _label(column: str, value: str) -> str:
    return f"{column}={value}"


def products(
    rows: DataFrame, part: Column, labels: Sequence[str], numbers: Sequence[str], target: str
) -> DataFrame:
    """(part, a, b, value): sums of the products of each pair of entries.

    Labels and numbers must be filled. Partial sums are made before the shuffle, which
    moves a row per task, part and pair that occurs.
    """

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("name"), value.cast("double").alias("value"))

    entries = F.array(
        entry(F.lit(ONE), F.lit(1.0)),
        entry(F.lit(TARGET), F.col(target)),
        *(entry(F.lit(n), F.col(n)) for n in numbers),
        *(entry(F.concat(F.lit(f"{n}="), F.col(n).cast("string")), F.lit(1.0)) for n in labels),
    )
    size = 2 + len(numbers) + len(labels)

    def with_later(first: Column, at: Column) -> Column:
        return F.transform(
            F.slice(F.col("entries"), at + 1, F.lit(size)),
            lambda second: F.struct(
                first["name"].alias("a"), second["name"].alias("b"), (first["value"] * second["value"]).alias("value")
            ),
        )

    pairs = F.flatten(F.transform("entries", with_later))
    return (
        rows.select(part.cast("int").alias("part"), entries.alias("entries"))
        .select("part", F.explode(pairs).alias("pair"))
        .groupBy("part", "pair.a", "pair.b")
        .agg(F.sum("pair.value").alias("value"))
    )


@dataclass(frozen=True)
class Linear:
    """prediction = intercept + weights of the numbers times them + weights of the labels."""

    intercept: float
    weights: dict[str, float] = field(default_factory=dict)

    def prediction(self, labels: Sequence[str], numbers: Sequence[str]) -> Column:
        """A label without a weight (unseen in training) adds nothing."""
        out = F.lit(self.intercept)
        for name in numbers:
            out = out + F.col(name) * F.lit(self.weights.get(name, 0.0))
        for name in labels:
            own = {k: w for k, w in self.weights.items() if k.startswith(f"{name}=")}
            if own:
                known = F.create_map(*(F.lit(x) for k, w in own.items() for x in (k.removeprefix(f"{name}="), w)))
                out = out + F.coalesce(F.try_element_at(known, F.col(name).cast("string")), F.lit(0.0))
        return out


@dataclass
class Sums:
    """Symmetric matrices of summed products, one per part."""

    names: list[str]
    parts: dict[int, np.ndarray]
    numbers: tuple[str, ...]

    @classmethod
    def of(cls, rows: DataFrame, part: Column, labels: Sequence[str], numbers: Sequence[str], target: str) -> Sums:
        found = products(rows, part, labels, numbers, target).collect()
        names = sorted({r.a for r in found} | {r.b for r in found})
        at = {n: i for i, n in enumerate(names)}
        parts: dict[int, np.ndarray] = {}
        for r in found:
            matrix = parts.setdefault(r.part, np.zeros((len(names), len(names))))
            matrix[at[r.a], at[r.b]] = matrix[at[r.b], at[r.a]] = r.value
        return cls(names, parts, tuple(numbers))

    def total(self, parts: Sequence[int]) -> np.ndarray:
        return sum((self.parts[p] for p in parts if p in self.parts), np.zeros((len(self.names),) * 2))

    def fit(self, parts: Sequence[int], alpha: float = 0.0) -> Linear:
        """Least squares on some parts; ``alpha`` times the squared weights of scaled entries is added.

        Numbers are scaled by the sample deviation of these parts. Without a penalty the
        weights of least norm are taken, as labels add up to the intercept. No rows give
        an intercept of 0.
        """
        m = self.total(parts)
        at = {n: i for i, n in enumerate(self.names)}
        if ONE not in at or not m[at[ONE], at[ONE]]:
            return Linear(0.0)
        n = m[at[ONE], at[ONE]]
        used = [x for x in self.names if x not in (ONE, TARGET) and m[at[x], at[x]] > 0]
        index = [at[x] for x in used]
        mean, mean_y = m[at[ONE], index] / n, m[at[ONE], at[TARGET]] / n
        spread = m[np.ix_(index, index)] - n * np.outer(mean, mean)
        against = m[index, at[TARGET]] - n * mean * mean_y
        deviation = np.sqrt(np.maximum(np.diag(spread), 0) / max(n - 1, 1))
        scale = np.array([d if x in self.numbers and d > 0 else 1.0 for x, d in zip(used, deviation, strict=True)])
        scaled, target = spread / np.outer(scale, scale), against / scale
        if alpha:
            w = np.linalg.solve(scaled + alpha * np.eye(len(used)), target)
        else:
            w = np.linalg.pinv(scaled, rcond=1e-10, hermitian=True) @ target
        w = w / scale
        return Linear(float(mean_y - w @ mean), dict(zip(used, w.tolist(), strict=True)))

    def r2(self, model: Linear, parts: Sequence[int]) -> float | None:
        """Share of the target's spread on some parts that the model explains; None without spread."""
        m = self.total(parts)
        at = {n: i for i, n in enumerate(self.names)}
        n = m[at[ONE], at[ONE]]
        v = np.array([-model.weights.get(x, 0.0) for x in self.names])
        v[at[ONE]], v[at[TARGET]] = -model.intercept, 1.0
        around = m[at[TARGET], at[TARGET]] - m[at[ONE], at[TARGET]] ** 2 / n if n else 0.0
        return float(1 - v @ m @ v / around) if around > 0 else None
