"""Mixing sources to target weights by Efraimidis-Spirakis sampling, built-in functions only.

Every document gets an exponential key, -ln(u) / weight, with u from a hash of its id and text
and weight from its quality. A source takes whole epochs as long as its target allows, then the
documents with the smallest keys until the rest of its target is filled; the document that
crosses the target is taken if that comes nearer to it.

The prefix sum is cut by key ranges: sums per source and range tell the one range where a
source's target falls, and that range is cut again between its least and greatest key, until it
holds at most ``MOST_SORTED`` documents or one key. Only then a running sum is sorted. So however
large a source is, and however low its weights, no task sorts more than that of it, and the
decision per source is one key: documents are compared with it where they lie.

Defined results: a null text has size 0 and is never counted; a null source is a source of its
own, last in order; repeated rows have equal keys and are taken like other rows, one by one,
all or none of them at the cut; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylake.llm.rule_table import SYMBOLS, count_chars
from entitylake.llm.shared import SPACES, WORD, written

WEIGHTS = (3, 1, 2)
TOTAL_RATIO = 1.5
MAX_EPOCHS = 2
KEY_RANGES = 4096
LEAST_QUALITY = 0.05

#: Most documents of a source in a key range that one task sorts; larger ranges are cut again.
MOST_SORTED = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.05 to 1: the share of word characters left when each symbol spoils four."""
    whole = F.coalesce(text, F.lit(""))
    chars = F.length(F.translate(whole, SPACES, ""))
    clean = (chars - 4 * count_chars(whole, SYMBOLS)) / F.greatest(chars, F.lit(1)).cast("double")
    return F.greatest(F.lit(LEAST_QUALITY), clean)


def uniform(ident: Column, text: Column) -> Column:
    """A number in (0, 1) from the hash of id and text: reruns agree, whatever the partitions."""
    digest = F.md5(F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def targets(sizes: DataFrame, weights: Sequence[int], total_ratio: float, max_epochs: float) -> DataFrame:
    """Per source its target: the total shared by weight, no source above ``max_epochs`` times its size.

    What a capped source leaves is shared by weight among the others until none is above its
    cap. In order of cap per weight the capped sources come first, so running sums tell the
    final share. One row per source.
    """
    everything = Window.partitionBy()
    ordered = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    choice = F.array(*[F.lit(float(w)) for w in weights])
    shares = ordered.withColumn("weight", F.get(choice, (F.col("rank") - 1) % len(weights))).withColumns(
        {
            "limit": F.lit(float(max_epochs)) * F.col("source_size"),
            "budget": F.lit(float(total_ratio)) * F.sum("source_size").over(everything),
            "all_weights": F.sum("weight").over(everything),
        }
    )
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("limit").over(by_ratio), F.lit(0.0))) / (
        F.col("all_weights") - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))
    )
    open_level = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.col("level"))
    return (
        shares.withColumn("level", level)
        .withColumn("final", F.max(open_level).over(everything))
        .withColumn("target", F.least(F.col("limit"), F.coalesce(F.col("final") * F.col("weight"), F.col("limit"))))
        .select("source", "source_size", "target")
    )


def keyed(docs: DataFrame, ident: str, text: str, source: str) -> DataFrame:
    """Per document: source, id, size, key. Narrow rows."""
    body, number = F.col(f"`{text}`"), F.col(f"`{ident}`")
    return docs.select(
        F.col(f"`{source}`").alias("source"),
        number.alias("doc_id"),
        word_count(body).alias("size"),
        (-F.log(uniform(number, body)) / quality_weight(body)).alias("key"),
    )


def _sums(ranged: DataFrame) -> DataFrame:
    """Size, number, least and greatest key of the documents per source and range."""
    return ranged.groupBy("source", "part").agg(
        F.sum("size").alias("part_size"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )


def _crossing(parts: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source (plan: source, rest, before) the range where its target falls, with the sizes of those before."""
    running = Window.partitionBy("p.source").orderBy("p.part")
    summed = (
        parts.alias("p")
        .join(plan.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
        .select(
            "p.source", "s.rest", "p.low", "p.high", "p.n", "part_size",
            (F.col("s.before") + F.sum("part_size").over(running)).alias("upto"),
        )
    )
    begin = F.col("upto") - F.col("part_size")
    return written(
        summed.where((F.col("rest") > 0) & (F.col("upto") >= F.col("rest")) & (begin < F.col("rest"))).select(
            "source", "rest", begin.alias("before"), "low", "high", "n"
        )
    )


def _within(rows: DataFrame, crossing: DataFrame) -> DataFrame:
    """The rows in the crossing range of their source."""
    inside = F.col("d.source").eqNullSafe(F.col("c.source")) & F.col("d.key").between(F.col("c.low"), F.col("c.high"))
    return rows.alias("d").join(crossing.alias("c"), inside).select("c.*", "d.size", "d.key", "d.doc_id")


def _narrowed(rows: DataFrame, crossing: DataFrame) -> DataFrame:
    """Crossing ranges cut until each holds few documents or one key.

    The least and the greatest key of a range fall into different parts, so every round gets on.
    """
    large = (F.col("n") > MOST_SORTED) & (F.col("low") < F.col("high"))
    small = crossing.where(~large)
    while not (open_ := crossing.where(large)).isEmpty():
        place = (F.col("key") - F.col("low")) / (F.col("high") - F.col("low")) * KEY_RANGES
        ranged = _within(rows, open_).withColumn("part", F.least(F.floor(place), F.lit(KEY_RANGES - 1)).cast("int"))
        crossing = _crossing(_sums(ranged), open_)
        small = small.union(crossing.where(~large))
    return small


def cuts(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_ratio: float = TOTAL_RATIO,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """Per source: size, target, whole epochs, and what the rest still takes.

    That is all keys below ``low``, and from there on all up to ``last`` (key, id).
    """
    first = F.floor((1 - F.exp(-F.col("key"))) * KEY_RANGES).cast("int")
    parts = written(_sums(rows.withColumn("part", first)))
    sizes = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    plan = targets(sizes, weights, total_ratio, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-9))).otherwise(0)
    plan = written(
        plan.withColumn("epochs", whole.cast("long")).withColumn(
            "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))
        )
    )
    begun = plan.select("source", "rest", F.lit(0).cast("long").alias("before"))
    crossing = written(_narrowed(rows, _crossing(parts, begun)))
    # Repeated rows have equal keys: one row with their number.
    inside = (
        _within(rows, crossing)
        .groupBy("source", "rest", "before", "key", "doc_id", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("sizes", F.col("n") * F.col("size"))
    )
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("sizes").over(order) - F.col("sizes") + F.col("size")
    taken = inside.withColumn("upto", upto).where(F.col("upto") * 2 - F.col("size") < 2 * F.col("rest"))
    last = taken.groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    edges = crossing.alias("c").join(last.alias("l"), F.col("c.source").eqNullSafe(F.col("l.source")), "left")
    edges = edges.select(F.col("c.source").alias("source"), "c.low", "l.last")
    return written(
        plan.alias("s")
        .join(edges.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
        .select("s.source", "source_size", "target", "epochs", "e.low", "e.last")
    )


def copies() -> Column:
    """How often the mix takes a row ``d`` of source plan ``s``: its epochs, and once more below the cut."""
    key = F.struct(F.col("d.key").alias("key"), F.col("d.doc_id").alias("doc_id"))
    below = (F.col("d.key") < F.col("s.low")) | (key <= F.col("s.last"))
    return F.col("s.epochs") + F.when(below, 1).otherwise(0)


def mix(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total_ratio: float = TOTAL_RATIO,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """Per document: id, size, its source's size and target, and the words that the mix takes.

    The source plan has a row per source and is read back from a written table, so Spark
    broadcasts it when it is small and joins by shuffle when it is not.
    """
    rows = written(keyed(docs, ident, text, source))
    plan = cuts(rows, weights, total_ratio, max_epochs)
    return (
        rows.alias("d")
        .join(plan.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.doc_id", "d.size", "s.source_size", "s.target", (copies() * F.col("d.size")).alias("taken"))
    )


def mixed(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with the columns of the input.

    Texts are not shuffled while the source plan is small enough to broadcast: each row's key
    is computed again where it lies and compared with its source's cut.
    """
    plan = cuts(written(keyed(docs, ident, text, source)))
    held = docs.select(
        F.struct("*").alias("llm_row"),
        F.col(f"`{ident}`").alias("llm_id"),
        F.col(f"`{text}`").alias("llm_text"),
        F.col(f"`{source}`").alias("llm_source"),
    )
    rows = held.select(
        "llm_row",
        F.inline(F.array(F.struct(*_key_fields("llm_id", "llm_text", "llm_source")))),
    )
    return (
        rows.alias("d")
        .join(plan.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.llm_row", F.explode(F.array_repeat(F.lit(0), copies().cast("int"))).alias("llm_copy"))
        .select("`llm_row`.*")
    )


def _key_fields(ident: str, text: str, source: str) -> list[Column]:
    body, number = F.col(f"`{text}`"), F.col(f"`{ident}`")
    return [
        F.col(f"`{source}`").alias("source"),
        number.alias("doc_id"),
        (-F.log(uniform(number, body)) / quality_weight(body)).alias("key"),
    ]


#: The same for DuckDB: one sorted running sum per source.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT)::DOUBLE
      + 0.5) / 281474976710656.0::DOUBLE AS u,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS chars,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS symbols
  FROM documents),
docs AS (
  SELECT doc_id, source, size,
    -ln(u) / greatest(0.05::DOUBLE, (chars - 4 * symbols)::DOUBLE / greatest(chars, 1)::DOUBLE) AS key
  FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, ([3.0, 1.0, 2.0]::DOUBLE[])[(rank - 1) % 3 + 1] AS weight FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(most) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
  FROM weighed
  WINDOW below AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
planned AS (
  SELECT source, source_size, least(most, coalesce(
      max(CASE WHEN most > level * weight THEN level END) OVER () * weight, most)) AS target
  FROM levels),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END::BIGINT AS epochs FROM planned),
run AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.epochs,
    greatest(0.0, s.target - s.epochs * s.source_size) AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND 2 * upto - size < 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run
"""


def op10_weighted_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents at the production weights."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
