"""Connected components of an edge table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of one
    integer type); component is the smallest node that can be reached.

    Large-star and small-star steps in turn (Kiveris et al., "Connected
    Components in MapReduce and Beyond"): each round links every node's larger
    neighbours, then its smaller ones, to the least node around it, until all
    edges point at roots.  A node's neighbours are never gathered: their
    minimum is an aggregate with a map-side step, joined back to the edges.
    Rows with a null are ignored, repeated edges count once; an empty table
    gives an empty result.  Every round is written to the shared folder.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = edges.where("a is not null and b is not null and a <> b")
    now = staged(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        # one row: edges, and order-independent sums that change with the set
        mark = tuple(
            now.agg(
                F.count(F.lit(1)),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
            ).first()
        )
        if mark == seen:
            break
        seen = mark
        # large star: larger neighbours of a node go to its least neighbour or itself
        around = both(now)
        # (written first: a join of plain scans is one that a hot node can be split in)
        least = staged(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        big = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the least of them
        big = staged(big.where("a <> b").distinct(), "large-star")
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        now = staged(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "small-star")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # stars now: every non-root has one edge, to its root
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
