"""Connected components of an edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src long, dst long); component is the smallest node reachable.

    Every round keeps at most as many edges as the one before and nothing is
    gathered outside Spark: minima are combined before each shuffle, and each
    join is between two written tables, so that a node with very many edges is
    split by adaptive execution. Self loops keep lone nodes; an empty edge list
    gives no rows.
    """
    scratch = Scratch(edges.sparkSession)

    def keep(df: DataFrame) -> DataFrame:
        return scratch.keep(df.select("u", "v"), "edges")

    def star(side: DataFrame, larger: bool) -> DataFrame:
        """Points a node's neighbours (larger ones, or smaller ones and itself) to its smallest neighbour. ``side`` is read from written tables."""
        least = keep(side.groupBy("u").agg(F.min("v").alias("v"))).select("u", F.least("u", "v").alias("m"))
        joined = side.join(least, "u")
        if larger:
            pairs = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            pairs = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p")).select("p.*")
        return pairs.where("u <> v").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())

    nodes = keep(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    now = nodes.where("u <> v")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = keep(star(both, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        now = keep(star(now, False))
        after = state(now)
        if after == before:
            break
        before = after
        scratch.release(*(t for _, t in list(scratch.paths.values()) if t is not nodes and t is not now))
    roots = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    out = materialise(roots.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "components")
    scratch.close()
    return out
