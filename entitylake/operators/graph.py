"""Ancestors over any number of steps, and who is within some links of whom.

Both work in rounds over written tables: a round joins what the last one found with the links and
keeps what is new. Reached pairs and entities are rows of their own, so cycles end, diamonds
count once, and no path is kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.operators import predicates as P
from entitylake.session import written


# --- Types and their ancestors --------------------------------------------


#: Slices that the ancestors of one type are listed in, so no list holds all of very many.
SLICES = 4


def _doubled(direct: DataFrame, own: DataFrame) -> DataFrame:
    """All pairs, by joining known pairs with themselves until none is new."""
    known = written(own.unionByName(direct).distinct())
    count = known.count()
    while count:
        above = known.select(F.col("schema").alias("ancestor"), F.col("ancestor").alias("top"))
        doubled = written(known.join(above, "ancestor").select("schema", F.col("top").alias("ancestor")).distinct())
        more = doubled.count()
        if more == count:
            break
        known, count = doubled, more
    return known


def ancestor_closure(parents: DataFrame, child: str = "schema", parent: str = "parent") -> DataFrame:
    """``schema, ancestor`` for every type and all types above it, itself included.

    Types that nothing is below need no rounds: they have the ancestors of their parents. They are
    taken off, and again the types that are lowest then, as long as that takes off at least half of
    the steps. Pairs of the rest are doubled: a round joins all known pairs with themselves, so a
    chain of n steps takes log n rounds. The lowest types then get lists of their parents' ancestors,
    which meet at the type and are made distinct there; only lists are shuffled.
    """
    direct = parents.select(F.col(child).alias("schema"), F.col(parent).alias("ancestor"))
    names = direct.select(F.explode(F.array("schema", "ancestor")).alias("schema")).filter("schema IS NOT NULL").distinct()
    rest = direct.filter("schema IS NOT NULL AND ancestor IS NOT NULL AND schema <> ancestor")
    layers, steps = [], rest.count()
    while steps:
        above = rest.select(F.col("ancestor").alias("schema")).distinct().withColumn("inner", F.lit(True))
        marked = written(rest.join(above, "schema", "left").withColumn("inner", F.col("inner").isNotNull()))
        left = marked.filter("inner").count()
        if 2 * left > steps:
            rest = marked.drop("inner")
            break
        layers.append(marked.filter("NOT inner").drop("inner"))
        rest, steps = marked.filter("inner").drop("inner"), left
    pairs = rest
    if steps:
        inner = rest.select(F.explode(F.array("schema", "ancestor")).alias("schema")).distinct()
        pairs = _doubled(rest, inner.select("schema", F.col("schema").alias("ancestor")))
        pairs = pairs.filter("schema <> ancestor")
    for layer in reversed(layers):
        lists = pairs.groupBy(F.col("schema").alias("ancestor"), F.pmod(F.xxhash64("ancestor"), F.lit(SLICES)).alias("slice")).agg(
            F.collect_list("ancestor").alias("tops")
        )
        met = layer.join(lists.drop("slice"), "ancestor", "left").select(
            "schema", F.concat(F.array("ancestor"), F.coalesce("tops", F.array().cast("array<string>"))).alias("tops")
        )
        # Distinct pairs of a type lie where the type is: no further shuffle.
        grown = met.repartition("schema").select("schema", F.explode("tops").alias("ancestor")).distinct()
        last = layer is layers[0]
        pairs = pairs.unionByName(grown if last else written(grown))
    return pairs.unionByName(names.select("schema", F.col("schema").alias("ancestor")))


# --- Links between entities -----------------------------------------------


def entity_links(entities: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``source_id, role, target_id`` for all ids in the named properties, in one pass."""

    def named(key: str) -> Column:
        ids = F.coalesce(F.array_distinct(P.linked(key)), F.array().cast("array<string>"))
        return F.transform(ids, lambda target: F.struct(F.lit(key).alias("role"), target.alias("target_id")))

    pairs = F.flatten(F.array(*[named(key) for key in dict.fromkeys(keys)]))
    return entities.filter(F.col("id").isNotNull()).select(F.col("id").alias("source_id"), F.inline(pairs))


def within_hops(links: DataFrame, start: DataFrame, hops: int, both_ways: bool = True) -> DataFrame:
    """``id, hop, via, role`` of every entity within ``hops`` links of the start ids.

    ``hop`` is the least number of links, ``via`` the smallest id one hop before, and ``role`` the
    link's smallest name. Links are written once and read each round; a round joins the frontier
    with them, drops what was reached before, and writes the next frontier. Very many links of one
    entity are one key of that join, which the adaptive plan splits, and what they lead to is
    reduced before it is shuffled.
    """
    if hops < 0:
        raise ValueError(f"hops must be 0 or more, got {hops!r}")
    ways = links.select(F.col("source_id").alias("near"), "role", F.col("target_id").alias("far"))
    if both_ways:
        ways = ways.unionByName(links.select(F.col("target_id").alias("near"), "role", F.col("source_id").alias("far")))
    ways = written(ways.filter("near IS NOT NULL AND far IS NOT NULL AND near <> far"))
    none = F.lit(None).cast("string")
    first = start.select("id").filter("id IS NOT NULL").distinct()
    frontier = written(first.select("id", F.lit(0).alias("hop"), none.alias("via"), none.alias("role")))
    rounds = [frontier]
    for hop in range(1, hops + 1):
        reached = rounds[0].select("id")
        for earlier in rounds[1:]:
            reached = reached.unionByName(earlier.select("id"))
        met = frontier.select(F.col("id").alias("near")).join(ways, "near")
        nearest = met.groupBy("far").agg(F.min(F.struct("near", "role")).alias("step"))
        frontier = written(
            nearest.join(reached, nearest["far"] == reached["id"], "left_anti").select(
                F.col("far").alias("id"), F.lit(hop).alias("hop"), F.col("step.near").alias("via"), F.col("step.role").alias("role")
            )
        )
        if frontier.isEmpty():
            break
        rounds.append(frontier)
    found = rounds[0]
    for later in rounds[1:]:
        found = found.unionByName(later)
    return found
