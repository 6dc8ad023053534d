"""Connected components of a table of links by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.storage import scratch_path

MAX_ROUNDS = 50


def stored(frame: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes a table to the shared folder and reads it back: its lineage ends here."""
    path = path or scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component``: the smallest node that each linked node can reach.

    Alternates two steps until nothing changes. The large star links every
    larger neighbour of a node to the smallest node of its neighbourhood, the
    small star does the same for the smaller neighbours. Each round is a
    partially aggregated minimum and a join, so a node with very many
    neighbours is never gathered in one place. The rounds grow with the
    logarithm of the longest chain. Only nodes that have a link are returned;
    links of a node to itself and repeated links are harmless.
    """
    edges = stored(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter("u <> v").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(lowest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # Every edge now points from the larger node u to a smaller one.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast(
            "decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    # Settled edges are stars: every node points at the smallest of its component.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
