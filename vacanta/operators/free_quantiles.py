"""Exact interpolated quantiles of any doubles, without bounds given beforehand.

Per group and quantile a bracket of values closes in on the wanted ranks. A sketch whose
rank error is bounded gives two values around them; one scan counts exactly what lies below
and inside, and sketches the inside again, until few distinct values are left there. Only
these are counted one by one. So no task holds a group's values, however they are spread:
over orders of magnitude, or as many copies of a few.

A round reads the group's keys and the value once and moves one sketch per task and bracket. Brackets are
sent to the rows while they are few, else both meet by the keys, from written tables, so that
a hot group can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacanta.session import scratch_path

ACCURACY = 10_000
# The sketch is read at these shares. A wanted rank lies between two of them; the bracket
# takes one more on either side, which is ten times the sketch's error.
STEPS = 1_000
GRID = [i / STEPS for i in range(STEPS + 1)]
FEW = 20_000  # rows or distinct values of a bracket that are counted one by one
ROUNDS = 6
BROADCAST_BRACKETS = 100_000


def quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """One row per group: ``keys``, the ``wanted`` quantiles by name, and ``count``.

    The numbers are those of linear interpolation between the two nearest ranks. Nulls, NaN
    and infinities are left out; groups of nothing else have no row. Null keys are a group.
    """
    spark = df.sparkSession
    rows = df.select(
        F.struct(*(F.col(k).alias(k) for k in keys), F.lit(0).alias("_all")).alias("group"), F.col(value).cast("double").alias("v")
    ).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "quantiles")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    def inside_of(brackets: DataFrame) -> DataFrame:
        """Each bracket with the values of its group up to its end."""
        some = F.broadcast(brackets) if brackets.count() <= BROADCAST_BRACKETS else brackets
        return rows.join(some, [rows["group"] == some["of"], rows["v"] <= some["high"]])

    totals = rows.groupBy("group").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    each = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in wanted.items()))
    brackets = kept(
        totals.select(F.col("group").alias("of"), "n", "low", "high", F.inline(each)).withColumn("rank", (F.col("n") - 1) * F.col("q"))
    )
    settled = None
    for left in range(ROUNDS, -1, -1):
        found = inside_of(brackets)
        inside = F.col("v") >= F.col("low")
        own = ["of", "name", "n", "rank", "low", "high"]
        counted = kept(
            found.groupBy(*own).agg(
                F.count_if(~inside).alias("before"),
                F.count_if(inside).alias("inside"),
                F.approx_count_distinct(F.when(inside, F.col("v"))).alias("distinct"),
            )
        )
        done = (F.col("low") == F.col("high")) | (F.least("inside", "distinct") <= FEW) if left else F.lit(True)
        ready = counted.filter(done)
        settled = ready if settled is None else settled.unionByName(ready)
        rest = counted.filter(~done)
        if not left or rest.isEmpty():
            break
        # Ranks among the values inside; the sketch is asked a little to either side.
        again = inside_of(rest).filter(inside)
        share = (F.col("rank") - F.col("before")) / F.col("inside")
        sketched = again.groupBy(*own, "before", "inside").agg(F.percentile_approx("v", GRID, ACCURACY).alias("grid"))
        at = F.floor(share * STEPS).cast("int")
        below, above = F.get("grid", at - 1), F.get("grid", at + 2)
        brackets = kept(
            sketched.select(
                "of", "name", "n", "rank",
                F.when(at > 0, below).otherwise(F.col("low")).alias("low"),
                F.when(at + 2 <= STEPS, above).otherwise(F.col("high")).alias("high"),
            )
        )
    settled = kept(settled)
    values = (
        inside_of(settled.filter("low < high"))
        .filter(F.col("v") >= F.col("low"))
        .groupBy("of", "name", "n", "rank", "before", "v")
        .agg(F.count(F.lit(1)).alias("copies"))
        .unionByName(
            settled.filter("low = high").select("of", "name", "n", "rank", "before", F.col("low").alias("v"), F.col("inside").alias("copies"))
        )
    )
    upto = F.sum("copies").over(Window.partitionBy("of", "name").orderBy("v"))
    placed = values.withColumn("first", F.col("before") + upto - F.col("copies"))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("first")) & (rank < F.col("first") + F.col("copies")), F.col("v")))

    low_rank = F.floor("rank")
    ends = placed.groupBy("of", "name", "n", "rank").agg(at_rank(low_rank).alias("a"), at_rank(F.ceil("rank")).alias("b"))
    one = ends.withColumn("quantile", F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank")))
    return one.groupBy("of").agg(
        *(F.max(F.when(F.col("name") == name, F.col("quantile"))).alias(name) for name in wanted), F.max("n").alias("count")
    ).select(*(F.col(f"of.{k}").alias(k) for k in keys), *wanted, "count")
