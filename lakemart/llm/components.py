"""Connected components by alternating large and small stars.

Both steps are a minimum per node (a partial aggregate) and a join back, so a
node that touches a third of all links is reduced in each map task and split by
adaptive execution in the join. Each round is written to the shared folder;
two numbers per round (count and checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node that has a link: the least node that it
    reaches. ``links`` has columns a and b of one orderable type; direction,
    repetitions and links of a node with itself do not matter."""
    def written(edges: DataFrame, step: str) -> DataFrame:
        return scratch.table(edges.filter("a > b").distinct(), f"{name}-{step}")

    def mark(edges: DataFrame):
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "even")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The minima are written, so that the join's sides are plain exchanges, which a hot node lets split.
        least = scratch.table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-least")
        large = written(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "odd")
        least = scratch.table(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-low")
        edges = written(large.join(least, "a").select("b", "m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))), "even")
        now = mark(edges)
        if now == before:
            break
        before = now
    scratch.drop(f"{name}-odd", f"{name}-least", f"{name}-low")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
