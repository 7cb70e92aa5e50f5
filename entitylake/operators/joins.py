"""Fetching entities by id and following ids from one entity to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.functions import bounds as B
from entitylake.operators import predicates as P
from entitylake.operators.groups import first_in_slices


def get_entity(entities: DataFrame, entity_id: str) -> DataFrame:
    """One entity; the comparison reaches the scan."""
    return entities.filter(F.col("id") == B.required_id(entity_id))


def get_entities(entities: DataFrame, ids: DataFrame) -> DataFrame:
    """A batch of entities by a table of ids. The plan broadcasts the ids when their
    measured size allows and sorts both sides otherwise."""
    return entities.join(ids.select("id").distinct(), "id", "left_semi").select(*entities.columns)


def top_hit_ids(hits: DataFrame, count: int | None = None, search_key: str | None = None) -> DataFrame:
    """Own ids of the first hits in rank order, for one search or for each of many."""
    named = hits.filter(F.col("own_id").isNotNull())
    size = B.top_hits(count)
    if search_key is None:
        return named.orderBy("rank", "own_id").limit(size).select(F.col("own_id").alias("id"))
    if size == 0:
        return named.limit(0).select(search_key, F.col("own_id").alias("id"))
    ranked = named.select(search_key, "rank", F.col("own_id").alias("id"))
    return first_in_slices(ranked, search_key, [F.col("rank"), F.col("id")], size, slice_by="id").select(
        search_key, "rank", "id"
    )


def fetch_top_hits(entities: DataFrame, hits: DataFrame, count: int | None = None) -> DataFrame:
    """The first hits of a search as full entities; at most fifty ids are broadcast."""
    ids = top_hit_ids(hits, count).distinct()
    return entities.join(F.broadcast(ids), "id", "left_semi").select(*entities.columns)


def links(entities: DataFrame, key: str) -> DataFrame:
    """``source_id, role, target_id`` for each id in a property.

    Nested entities count by their id, not by the name that their property shows.
    """
    return entities.select(
        F.col("id").alias("source_id"),
        F.lit(key).alias("role"),
        F.explode(F.array_distinct(P.linked(key))).alias("target_id"),
    )


def pivot(sources: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Entities that the ``key`` property of the sources points to.

    Target ids are unique, so a target that very many sources name makes only the source
    side of one partition large, which the adaptive plan splits.
    """
    return links(sources, key).join(
        targets.select(
            F.col("id").alias("target_id"),
            F.col("schema").alias("target_schema"),
            F.col("props").alias("target_props"),
        ),
        "target_id",
    )


def referring(entities: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Links from entities whose ``key`` property names one of ``ids``."""
    wanted = ids.select(F.col("id").alias("target_id")).distinct()
    return links(entities, key).join(wanted, "target_id", "left_semi").select(
        "source_id", "role", "target_id"
    )
