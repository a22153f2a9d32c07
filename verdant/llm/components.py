"""Connected components of a graph of links, by alternating large-star and small-star rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.session import scratch_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (large: the greater ones; small: the smaller ones and itself) go to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            .where("a > b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its least node.

    Every round is written to the shared folder, so a lost executor costs one round at most.  A round ends with
    edges a > b; when none changes, every node points at the least of its component.
    """
    spark = links.sparkSession
    root, number = scratch_path(spark, "components"), 0

    def keep(edges: DataFrame) -> DataFrame:
        nonlocal number
        number += 1
        edges.write.parquet(f"{root}/{number}")
        return spark.read.parquet(f"{root}/{number}")

    def mark(edges: DataFrame) -> tuple:
        """Tells whether two rounds have the same distinct edges: their number and a checksum, in one job."""
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first())

    edges = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = None
    while (now := mark(edges)) != before:
        before, edges = now, keep(_star(_star(edges, True), False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
