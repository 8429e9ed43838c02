"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step gives every node's neighbours the smallest node that the node knows. Minima are partial
aggregates. They are written before they are joined back, so that both sides of that join are
plain scans and AQE can split the edges of a node that has very many: after a few rounds the
smallest node of a component has all of it as neighbours. Edges are written to the shared folder,
and what a later step has replaced is removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written edges with m, the smallest of u and its neighbours, and the table of minima."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("_m")).withColumnRenamed("u", "_u"), "minima")
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m")), least


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    large, least = _star(both)
    large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    large = written(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "large")
    discard(least)
    small, least = _star(large)
    out = written(small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").where("u <> v").distinct(), "edges")
    discard(large)
    discard(least)
    return out


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, root) for each node of `edges` (two columns of one orderable type) that is not
    the smallest of its component; root is the smallest. Self-loops and repeats are ignored."""
    now = edges.toDF("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(now, "edges")
    seen = None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return now.toDF("node", "root")
        seen, before = state, now
        now = _round(now)
        discard(before)
    raise RuntimeError(f"components: no end after {most_rounds} rounds")
