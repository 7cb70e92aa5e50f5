"""Connected components of a table of links, by alternating large and small stars.

Both steps take each vertex's smallest neighbour (a minimum, combined before the shuffle) and
join it back, so a vertex with very many links is never one group in a task. Every round is
written to the shared folder; the rounds end when the links no longer change, after about the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.llm.shared import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest vertex it knows."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """Vertices of the links (columns u, v) with the smallest vertex of their component.

    The result has the columns ``vertex`` and ``root``; roots are rows too. Links of a vertex to
    itself and repeated links make no difference.
    """
    edges = written(links.select("u", "v").where("u != v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        edges = written(_small_star(_large_star(edges)).where("u != v").distinct())
    # Now every edge leads from a vertex to the root of its star.
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(roots)


def roots_of(parents: DataFrame) -> DataFrame:
    """The same for links (u, v) with u < v that name one parent u for each v: by pointer jumping.

    Every round doubles the step to the root, and is one join.
    """
    steps = written(parents.select("v", "u"))
    while True:
        above = steps.select(F.col("v").alias("u"), F.col("u").alias("next"))
        longer = steps.join(above, "u", "left").select("v", F.coalesce("next", "u").alias("u"), F.col("next").isNotNull().alias("moved"))
        after = written(longer)
        steps = after.select("v", "u")
        if after.where("moved").isEmpty():
            break
    roots = steps.select(F.col("u").alias("vertex"), F.col("u").alias("root")).distinct()
    return steps.select(F.col("v").alias("vertex"), F.col("u").alias("root")).union(roots)
