"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm._common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its smallest node.

    ``edges`` has columns a and b. Every step keeps at most as many edges as there were and runs
    as joins and minima, so no node's neighbours are ever gathered in one place.
    Nulls and loops are ignored.
    """
    first = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, size = _measured(first)
    while size[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        was = size
        now, size = _measured(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if was == size:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _measured(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, with their number and a digest, both taken while writing."""
    seen = Observation()
    measures = F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
    table = stored(edges.observe(seen, *measures), "edges")
    return table, (seen.get["n"], seen.get["digest"])
