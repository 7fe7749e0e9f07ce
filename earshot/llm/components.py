"""Connected components by alternating large-star and small-star.

Each step is one partial aggregation (the smallest neighbour of a node) and one
join with it, so a node with very many links is split like any skewed join and
no neighbourhood is ever gathered in one place.  Rounds grow with the logarithm
of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.tables import keep, release


def _downward(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller, no loops."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.withColumnRenamed("m", "v"))


def _mark(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: longs), where the
    component is the smallest node that can be reached.

    Null ends, loops and repeated links add nothing; no links give no rows.
    """
    now = keep(_downward(edges), "links")
    mark = _mark(now)
    while mark[0]:
        # The small star's input need not be kept: it is read once per side.
        wide = keep(_downward(_large_star(now)), "large-star")
        next_ = keep(_downward(_small_star(wide)), "small-star")
        after = _mark(next_)
        release(now, wide)
        now, unchanged, mark = next_, after == mark, after
        if unchanged:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
