"""Logs of captured requests: shape bodies, hide credentials, cap length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from entitylake import constants as K
from entitylake.functions import display as D
from entitylake.functions import text as T
from entitylake.functions import urls as U
from entitylake.operators import shape as SH
from entitylake.session import shared_folder
from entitylake.sources import payloads as PL


def redact_headers(headers: Column) -> Column:
    """Mask the value of ``authorization`` in a map of headers."""
    return F.transform_values(
        headers,
        lambda name, value: F.when(
            F.lower(name) == "authorization",
            F.when(T.js_trim(value).rlike(K.API_KEY_PATTERN), K.API_KEY_MASK).otherwise(K.OTHER_MASK),
        ).otherwise(value),
    )


def cap_body(body: Column, console: bool = False) -> Column:
    """Cut a logged body and say how long it was."""
    cap = K.LOG_CONSOLE_BODY_CHARS if console else K.LOG_FILE_BODY_CHARS
    where = "truncated for console, " if console else "truncated, "
    rest = (
        f" chars total; see log file for up to {K.LOG_FILE_BODY_CHARS} chars]\n"
        if console
        else " chars total]\n"
    )
    note = F.concat(
        F.lit(f"\n{K.ELLIPSIS} [{where}"), F.length(body).cast("string"), F.lit(rest)
    )
    return F.when(F.length(body) > cap, F.concat(F.left(body, F.lit(cap)), note)).otherwise(body)


def response_kind() -> Column:
    """``search`` or ``entity`` for good JSON responses of these paths, else ``other``."""
    path = U.url_path(F.col("url"))
    usable = F.col("status").between(200, 299) & F.col("doc").isNotNull()
    return (
        F.when(usable & path.rlike(K.SEARCH_PATH_PATTERN), F.lit("search"))
        .when(usable & path.rlike(K.ENTITY_PATH_PATTERN), F.lit("entity"))
        .otherwise(F.lit("other"))
    )


def classify(responses: DataFrame) -> DataFrame:
    return PL.decode(responses, "body").withColumn("kind", response_kind()).drop("raw_text")


def _search_bodies(searches: DataFrame, head: tuple[str, ...], **options) -> DataFrame:
    """``head, records, raw``: the slim hits of each search response as a JSON list.

    One row for each row of the input (columns ``head``, ``body``, ``doc``). A response that
    occurs several times is shaped once and returned as often; what repeats is combined
    before the shuffle, so a group holds the hits of one page.
    """
    named = searches.withColumn("body_key", F.md5("body"))
    keyed = (*head, "body_key")
    hits = PL.scan_envelopes(named, keep=keyed, decoded=True)
    records = SH.to_json_records(
        SH.search_records(hits, keep=(*keyed, "rank"), **options), keep=(*keyed, "rank")
    )
    # One row per response without a hit counts its copies and keeps those without hits.
    none = F.lit(None).cast("string")
    rows = records.select(*keyed, "rank", "json", none.alias("raw"), F.lit(0).alias("copies")).unionByName(
        named.select(*keyed, F.lit(-1).alias("rank"), none.alias("json"), F.col("body").alias("raw"), F.lit(1).alias("copies"))
    )
    once = rows.groupBy(*keyed, "rank").agg(
        F.first("json").alias("json"), F.first("raw").alias("raw"), F.sum("copies").alias("copies")
    )
    hit = F.when(F.col("rank") >= 0, F.struct("rank", "json"))
    listed = F.transform(F.array_sort(F.collect_list(hit)), lambda h: h.getField("json"))
    grouped = once.groupBy(*keyed).agg(
        F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("records"),
        F.first("raw", ignorenulls=True).alias("raw"),
        F.sum("copies").cast("int").alias("copies"),
    )
    return grouped.select(
        *head, "records", "raw", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")
    ).drop("copy")


def search_output(responses: DataFrame, include_raw: bool = False, **options) -> DataFrame:
    """``response_id, url, json`` of each good search response: the list of its slim hits, or
    ``{results, raw}`` with the whole response beside it."""
    searches = classify(responses).filter(F.col("kind") == "search")
    shaped = _search_bodies(searches, ("response_id", "url"), **options)
    json = F.col("records")
    if include_raw:
        json = F.concat(F.lit('{"results":'), "records", F.lit(',"raw":'), "raw", F.lit("}"))
    return shaped.select("response_id", "url", json.alias("json"))


def shape_log(responses: DataFrame, console: bool = False) -> DataFrame:
    """``response_id, url, status, kind, body`` with slim bodies where they apply; one row for
    each row of the log, also where responses repeat or have no id.

    The log is read and decoded once: rows go to the shared folder by kind, with their decoded
    body, and each branch reads its own kind.
    """
    head = ("response_id", "url", "status", "kind")
    sorted_out = classify(responses).withColumn(
        "kind_dir", F.when((F.col("kind") == "entity") & ~D.is_object("doc"), F.lit("plain")).otherwise(F.col("kind"))
    )
    path = shared_folder(responses.sparkSession)
    sorted_out.write.partitionBy("kind_dir").parquet(path)
    stored = StructType([*sorted_out.schema.fields[:-1], StructField("kind_dir", StringType())])
    known = responses.sparkSession.read.schema(stored).parquet(path)
    searches = known.filter(F.col("kind_dir") == "search").drop("kind_dir")
    search_bodies = _search_bodies(searches, head).select(*head, F.col("records").alias("body"))
    entities = known.filter(F.col("kind_dir") == "entity")
    entity_bodies = SH.to_json_records(
        SH.entity_records(PL.scan_entities(entities, "body", keep=head, decoded=True), keep=head), keep=head
    ).withColumnRenamed("json", "body")
    others = known.filter(F.col("kind_dir").isin("other", "plain")).select(*head, "body")
    return (
        search_bodies.unionByName(entity_bodies)
        .unionByName(others)
        .withColumn("body", cap_body(F.col("body"), console))
    )
