"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake.llm import scratch


def _minimum(links: DataFrame) -> DataFrame:
    """``(u, v, m)``: every link with the least node that ``u`` sees, itself included."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    seen = _minimum(down)
    to_least = seen.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return to_least.filter("u != v").distinct()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for all nodes of ``edges (u, v)``; the component is its least node.

    Links with a null end or from a node to itself are ignored. Each round is two rewirings (every
    neighbourhood becomes a star around its least node) and one table in the shared folder; the
    number of rounds grows with the logarithm of the longest path. Hubs are aggregated before the
    shuffle and joined, never gathered.
    """
    spark = edges.sparkSession
    edges = edges.select("u", "v").filter("u is not null and v is not null and u != v").distinct()
    current, path = scratch.put(edges, label)
    state = None
    while True:
        renewed, new_path = scratch.put(_small_star(_large_star(current)), label)
        scratch.drop(spark, path)
        current, path = renewed, new_path
        # Stars only: no node is both a centre and a leaf. The sums tell whether a round changed anything.
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v").cast("decimal(20,0)"))
        ).first()
        if now == state or now[0] == 0:
            break
        state = now
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(centres)
