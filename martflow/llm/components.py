"""Connected components of an edge table by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = down.join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that occurs in an edge; root is the least
    node of its component.

    Each round rewires every node to the least neighbour it knows of (first
    upwards, then downwards), which halves distances, so rounds grow with the
    logarithm of the longest chain.  Least neighbours are found map-side first
    and written, so that the edges meet them in a join of two plain shuffles: a
    hub's edges are a side that adaptive execution cuts into pieces.  Every round
    is written to the shared folder.  Self loops and repeated edges are
    harmless; an empty table gives an empty result.
    """
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(),
                      "edges")
    before = _state(now)
    while before[0]:
        now = materialize(_small_star(_large_star(now)).filter("u <> v").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
