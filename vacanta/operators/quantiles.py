"""Exact interpolated quantiles and box-plot whiskers, without gathering a group.

The built-in exact percentile keeps every distinct value of a group in the memory of
one task. Here a value falls into one of a fixed number of equal-width slots between
known bounds, and into one of as many equal-width parts of its slot, so

* rows shrink to ``(group, slot, part, value, n)`` counts before any shuffle,
* a group's running total is taken over its slots (at most ``SLOTS`` of them),
* only the slots that hold a wanted rank are looked into, by a running total over their
  parts, and only the parts that hold one by a running total over values.

No step orders or holds all values of a group or of a slot. Values within a part are
closer than the bounds' distance divided by ``SLOTS`` squared. The results are the same
numbers the built-in percentile gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 2048
Bounds = tuple[float, float]


def _slot_and_part(v: Column, bounds: Bounds) -> tuple[Column, Column]:
    low, high = bounds
    place = (v - F.lit(float(low))) / F.lit((high - low) / SLOTS)
    slot = F.floor(place)
    part = F.floor((place - slot) * SLOTS)
    # Never null for a value within the bounds. Saying so keeps the optimizer from
    # adding null checks in one branch only, which would split the shared shuffle.
    return F.coalesce(slot.cast("int"), F.lit(0)), F.coalesce(part.cast("int"), F.lit(0))


def value_counts(df: DataFrame, keys: Sequence[str], value: str, bounds: Bounds) -> DataFrame:
    """Counts per (keys, slot, part, value) of the values within ``bounds``, ends included.

    Values outside are not counted: choose bounds that the values cannot leave, or that
    say which values are meant.
    """
    v = F.col(value)
    slot, part = _slot_and_part(v, bounds)
    return (
        df.filter(v.between(*bounds))
        .select(*keys, slot.alias("_slot"), part.alias("_part"), v.alias("_value"))
        .groupBy(*keys, "_slot", "_part", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def weighted_counts(df: DataFrame, keys: Sequence[str], value: str, times: str, bounds: Bounds) -> DataFrame:
    """``value_counts`` of rows that stand for ``times`` rows each."""
    v = F.col(value)
    slot, part = _slot_and_part(v, bounds)
    return (
        df.filter(v.between(*bounds))
        .select(*keys, slot.alias("_slot"), part.alias("_part"), v.alias("_value"), F.col(times).alias("_times"))
        .groupBy(*keys, "_slot", "_part", "_value")
        .agg(F.sum("_times").alias("_n"))
    )


def slot_profile(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, slot): rows, rows in lower slots, rows of the group, extremes."""
    slots = counts.groupBy(*keys, "_slot").agg(
        F.sum("_n").alias("_rows"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
    )
    # With no keys the whole table is the group: its profile is at most SLOTS rows.
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    return slots.select(
        "*",
        (F.sum("_rows").over(group.orderBy("_slot")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(group).alias("_total"),
    )


def _rank(q: float) -> Column:
    """Position of quantile ``q`` among the group's values, from 0, with a fraction."""
    return (F.col("_total") - 1) * F.lit(float(q))


def _holds(rank: Column, before: Column, rows: Column) -> Column:
    return (rank >= before) & (rank < before + rows)


def quantiles(
    counts: DataFrame,
    profile: DataFrame,
    keys: Sequence[str],
    wanted: dict[str, float],
) -> DataFrame:
    """One row per group: the ``wanted`` quantiles by name, and ``count``."""
    ranks = {
        name: (F.floor(_rank(q)), F.ceil(_rank(q)), _rank(q)) for name, q in wanted.items()
    }
    wanted_here = reduce(
        or_,
        [
            _holds(edge, F.col("_before"), F.col("_rows"))
            for low, high, _ in ranks.values()
            for edge in (low, high)
        ],
    )
    slot, part = [*keys, "_slot"], [*keys, "_slot", "_part"]
    touched = profile.filter(wanted_here).select(*slot, "_before", "_total")
    parts = (
        counts.groupBy(*part)
        .agg(F.sum("_n").alias("_rows"))
        .join(touched, slot)
        .withColumn("_upto", F.sum("_rows").over(Window.partitionBy(*slot).orderBy("_part")))
        .withColumn("_before", F.col("_before") + F.col("_upto") - F.col("_rows"))
    )
    inside = counts.join(parts.filter(wanted_here).select(*part, "_before", "_total"), part)
    upto = F.sum("_n").over(Window.partitionBy(*part).orderBy("_value"))
    placed = inside.withColumn("_first", F.col("_before") + upto - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.max(F.when(_holds(rank, F.col("_first"), F.col("_n")), F.col("_value")))

    found = placed.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[at(low).alias(f"_{name}_below") for name, (low, _, _) in ranks.items()],
        *[at(high).alias(f"_{name}_above") for name, (_, high, _) in ranks.items()],
    )

    def between(name: str) -> Column:
        low, _, rank = ranks[name]
        below, above = F.col(f"_{name}_below"), F.col(f"_{name}_above")
        return below + (above - below) * (rank - low)

    return found.select(
        *keys,
        *[between(name).alias(name) for name in ranks],
        F.col("_total").alias("count"),
    )


def medians(df: DataFrame, keys: Sequence[str], value: str, bounds: Bounds) -> DataFrame:
    """``(keys, median, count)`` over the values within ``bounds``."""
    return medians_of(value_counts(df, keys, value, bounds), keys)


def medians_of(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``medians`` from counts of values."""
    return quantiles(counts, slot_profile(counts, keys), keys, {"median": 0.5})


def box_plots(df: DataFrame, keys: Sequence[str], value: str, bounds: Bounds) -> DataFrame:
    """Quartiles, whiskers and count per group with at least one value within ``bounds``.

    A whisker is the most extreme value within 1.5 interquartile ranges of the box. The
    extremes of a group's slots tell it, but for the slots a fence runs through; only
    those are looked into. ``keys`` must name at least one column without nulls. Every
    branch uses the same columns of the counts, so that their shuffle is made once.
    """
    return box_plots_of(value_counts(df, keys, value, bounds), keys)


def box_plots_of(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``box_plots`` from counts of values."""
    profile = slot_profile(counts, keys)
    boxes = quantiles(counts, profile, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fenced = profile.join(
        boxes.drop("count").select(
            "*", (F.col("q1") - reach).alias("_floor"), (F.col("q3") + reach).alias("_top")
        ),
        list(keys),
    )
    cut = (F.col("_low") < F.col("_floor")) | (F.col("_high") > F.col("_top"))
    edge = fenced.filter("_rows > 0").filter(
        cut & (F.col("_high") >= F.col("_floor")) & (F.col("_low") <= F.col("_top"))
    ).select(*keys, "_slot", "_floor", "_top")
    within_edge = (
        counts.join(edge, [*keys, "_slot"])
        .filter(F.col("_value").between(F.col("_floor"), F.col("_top")))
        .groupBy(*keys)
        .agg(F.min("_value").alias("_least"), F.max("_value").alias("_most"), F.sum("_n").alias("_found"))
    )
    whole = fenced.groupBy(*keys, "q1", "median", "q3").agg(
        F.sum("_rows").alias("count"),
        F.min(F.when(~cut, F.col("_low"))).alias("_low"),
        F.max(F.when(~cut, F.col("_high"))).alias("_high"),
    )
    return whole.join(within_edge, list(keys), "left").select(
        *keys,
        F.least("_low", F.when(F.col("_found") > 0, F.col("_least"))).alias("min"),
        "q1",
        "median",
        "q3",
        F.greatest("_high", F.when(F.col("_found") > 0, F.col("_most"))).alias("max"),
        "count",
    )
