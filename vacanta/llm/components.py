"""Connected components of a table of links, by rounds of joins on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; ``component`` is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest neighbour, then every node links its smaller neighbours to it. A node of
    many links is pre-aggregated to its minimum before rows meet. Rounds grow with the
    logarithm of the number of nodes; each is written to the shared folder, so a lost
    executor costs no more than the round. Links of a node with itself and nulls are
    ignored; no links give no rows.
    """
    spark = links.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    def toward_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
        """Edges (u, v), u > v, after every node points its neighbours at the smallest."""
        if larger_only:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = edges
        # Written, so that the join's two sides are plain shuffles and a hot node can be split.
        least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        joined = both.join(least, "u")
        if larger_only:
            moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return moved.filter(F.col("u") != F.col("v")).distinct()

    edges = kept(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        edges = kept(toward_smallest(toward_smallest(edges, True), False))
        now = edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("s")
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
