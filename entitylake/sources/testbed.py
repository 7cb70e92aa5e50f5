"""The test tables as entities, and as captured payloads for the JSON readers.

Every entity is a plain projection of one table row, so a filter on ``schema`` removes
whole branches of the union and a filter on a column reaches the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake import schema as S

ORIGIN = "https://search.example.org"

# Each schema with the types it descends from, itself first.
ANCESTORS = {
    "Page": ["Page", "Document"],
    "Pages": ["Pages", "Document"],
    "Email": ["Email", "Document"],
    "Person": ["Person", "LegalEntity"],
    "Company": ["Company", "Organization", "LegalEntity"],
    "Contract": ["Contract", "Interval"],
    "Order": ["Order", "Interval"],
    "Event": ["Event", "Interval"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to the tasks of a shuffle. A narrow table is one small file, which a
    scan takes in one task, while the JSON made of its rows costs a thousand times their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def closure(spark: SparkSession) -> DataFrame:
    rows = [(schema, up) for schema, ups in ANCESTORS.items() for up in ups]
    return spark.createDataFrame(rows, S.CLOSURE)


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix + "."), key.cast("string"))


def _props(**values: Column) -> Column:
    return F.create_map(
        *[x for name, value in values.items() for x in (F.lit(name), F.array(value))]
    )


def _rows(
    df: DataFrame,
    schema: str,
    entity_id: Column,
    collection: Column,
    props: Column,
    body_keys: Column | None = None,
    **more: Column,
) -> DataFrame:
    keys = F.map_keys(props)
    columns = {
        "id": entity_id,
        "own_id": entity_id,
        "schema": F.lit(schema),
        "raw_schema": F.lit(schema),
        "schemata": F.array(*[F.lit(name) for name in ANCESTORS[schema]]),
        "dataset": collection,
        "collection_id": collection,
        "link": F.concat(F.lit(ORIGIN + "/entities/"), entity_id),
        "props": props,
        "present_keys": keys if body_keys is None else F.concat(keys, body_keys),
        **more,
    }
    return S.conform(df.select(*[value.alias(name) for name, value in columns.items()]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged files with text of their own, in one of three body fields."""
    df = table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 3
    text = F.array("text")
    return _rows(
        df,
        "Pages",
        _id("doc", F.col("doc_id")),
        F.col("source"),
        _props(
            fileName=F.concat(F.col("source"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(".txt")),
            languages=F.col("lang"),
            mimeType=F.lit("text/plain"),
        ),
        texts=S.texts(
            bodyText=F.when(kind == 0, text),
            indexText=F.when(kind == 1, text),
            rawText=F.when(kind == 2, text),
        ),
        body_keys=F.array(
            F.when(kind == 0, "bodyText").when(kind == 1, "indexText").otherwise("rawText")
        ),
    )


def _conversation_id(conv: Column) -> Column:
    return _id("conv", conv)


def conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged files without text: one per conversation."""
    df = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    entity_id = _conversation_id(F.col("conv_id"))
    return _rows(
        df,
        "Pages",
        entity_id,
        F.lit("conversations"),
        _props(title=F.concat(F.lit("Conversation "), F.col("conv_id").cast("string"))),
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of these files: one per turn."""
    df = table(spark, sf_dir, "conversations")
    parent = _conversation_id(F.col("conv_id"))
    turn = F.col("turn").cast("string")
    return _rows(
        df,
        "Page",
        F.concat(parent, F.lit("."), turn),
        F.lit("conversations"),
        _props(author=F.col("role"), document=parent, index=turn),
        texts=S.texts(bodyText=F.array("text")),
        document_ids=F.array(parent),
        page_index=F.col("turn").cast("double"),
        body_keys=F.array(F.lit("bodyText")),
    )


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    return _rows(
        df,
        "Email",
        _id("mail", F.col("page_id")),
        F.lit("mail"),
        _props(subject=F.regexp_extract("html", r"<title>([^<]*)</title>", 1)),
        texts=S.texts(bodyHtml=F.array("html")),
        link=F.col("url"),
        body_keys=F.array(F.lit("bodyHtml")),
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 rows at every scale; the planner sees the file size and broadcasts it itself.
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _rows(
        df,
        "Person",
        _id("person", F.col("c_custkey")),
        F.lit("registry"),
        _props(
            name=F.col("c_name"),
            countries=F.col("n_name"),
            topics=F.col("c_mktsegment"),
            balance=F.col("c_acctbal").cast("string"),
        ),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier").join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return _rows(
        df,
        "Company",
        _id("company", F.col("s_suppkey")),
        F.lit("registry"),
        _props(
            name=F.col("s_name"),
            countries=F.col("n_name"),
            balance=F.col("s_acctbal").cast("string"),
        ),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return _rows(
        df,
        "Order",
        _id("order", F.col("o_orderkey")),
        F.lit("trade"),
        _props(
            customer=_id("person", F.col("o_custkey")),
            date=F.col("o_orderdate").cast("date").cast("string"),
            status=F.col("o_orderstatus"),
            priority=F.col("o_orderpriority"),
            total=F.col("o_totalprice").cast("string"),
        ),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per order and supplier; a link between companies and orders."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return _rows(
        df,
        "Contract",
        F.concat_ws(
            ".", F.lit("contract"), F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")
        ),
        F.lit("trade"),
        _props(
            supplier=_id("company", F.col("l_suppkey")),
            order=_id("order", F.col("l_orderkey")),
        ),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return _rows(
        df,
        "Event",
        _id("event", F.col("event_id")),
        F.col("event_type"),
        _props(
            k=F.get_json_object("props", "$.k"),
            date=F.col("ts").cast("date").cast("string"),
            value=F.col("value").cast("string"),
        ),
    )


BUILDERS = (
    documents,
    conversation_files,
    conversation_pages,
    mails,
    people,
    companies,
    orders,
    contracts,
    events,
)


def entities(spark: SparkSession, sf_dir: str, *builders) -> DataFrame:
    """The whole corpus, or the parts named."""
    parts = [build(spark, sf_dir) for build in builders or BUILDERS]
    return reduce(DataFrame.unionAll, parts)


# --- Captured payloads ----------------------------------------------------


def raw_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People as nested JSON objects, one per row, some of them without an own id."""
    regions = table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    df = spread(table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")))
    key = F.col("c_custkey").cast("string")
    entity_id = _id("person", F.col("c_custkey"))
    url = F.concat(F.lit(ORIGIN + "/api/2/entities/"), entity_id)
    nation = F.struct(
        _id("nation", F.col("n_nationkey")).alias("id"),
        F.lit("Country").alias("schema"),
        F.col("n_name").alias("caption"),
        F.lit("not kept").alias("extra"),
    )
    region = F.struct(
        _id("region", F.col("r_regionkey")).alias("id"),
        F.lit("Region").alias("schema"),
        F.col("r_name").alias("caption"),
        F.lit(None).cast("string").alias("extra"),
    )
    body = F.struct(
        F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("  "), entity_id)).alias("id"),
        F.when(F.col("c_custkey") % 5 != 0, F.lit("Person")).alias("schema"),
        F.struct(F.lit("registry").alias("id")).alias("collection"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("score"),
        F.when(F.col("c_custkey") % 3 == 1, F.col("c_acctbal")).alias("_score"),
        F.struct(
            url.alias("self"), F.concat(F.lit(ORIGIN + "/entities/"), entity_id).alias("ui")
        ).alias("links"),
        F.struct(
            F.array(F.col("c_name"), F.lit("  "), F.upper("c_mktsegment")).alias("name"),
            F.array(nation).alias("country"),
            F.col("c_acctbal").alias("balance"),
            F.array(F.struct(F.col("c_mktsegment").alias("segment"))).alias("profile"),
            F.array(F.array(key, F.lit("x")), F.array(F.lit("y"))).alias("codes"),
            F.array(F.lit("done")).alias("processingStatus"),
            nation.alias("parent"),
            F.array(nation, region).alias("ancestors"),
            F.array(
                F.struct(
                    _id("region", F.col("r_regionkey")).alias("id"),
                    F.lit("Region").alias("schema"),
                    F.struct(F.array("r_name").alias("name")).alias("properties"),
                )
            ).alias("recipients"),
        ).alias("properties"),
    )
    return df.select(F.to_json(body).alias("raw"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of captured responses.

    Conversation turns give search responses of at most ten hits; mails give single
    entities, one in seven of them an error page or a JSON error.
    """
    turns = table(spark, sf_dir, "conversations").filter("turn IS NOT NULL")
    parent = _conversation_id(F.col("conv_id"))
    with_text = F.col("role") == "user"
    hit = F.struct(
        F.concat(parent, F.lit("."), F.col("turn").cast("string")).alias("id"),
        F.lit("Page").alias("schema"),
        F.lit("conversations").alias("collection_id"),
        F.when(~with_text, F.array(F.concat(F.lit("<em>"), F.col("text"), F.lit("</em>")))).alias(
            "highlight"
        ),
        F.struct(
            F.array(parent).alias("document"),
            F.array(F.col("turn").cast("string")).alias("index"),
            F.when(with_text, F.array("text")).alias("bodyText"),
        ).alias("properties"),
    )
    searches = (
        turns.groupBy("conv_id", F.floor(F.col("turn") / 10).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", hit.alias("hit")))).alias("hits"))
        .select(
            F.format_string(
                ORIGIN + "/api/2/search?q=*&document=conv.%d&offset=%d", "conv_id", F.col("page") * 10
            ).alias("url"),
            F.lit(200).alias("status"),
            F.to_json(
                F.struct(
                    F.lit("ok").alias("status"),
                    F.size("hits").alias("total"),
                    F.transform("hits", lambda h: h.getField("hit")).alias("results"),
                )
            ).alias("body"),
        )
    )
    mail = table(spark, sf_dir, "pages")
    entity_id = _id("mail", F.col("page_id"))
    remainder = F.col("page_id") % 7
    single = mail.select(
        F.concat(F.lit(ORIGIN + "/api/2/entities/"), entity_id).alias("url"),
        F.when(remainder == 0, 502).when(remainder == 1, 404).otherwise(200).alias("status"),
        F.when(remainder == 0, F.col("html"))
        .when(remainder == 1, F.lit('{"message":"not found"}'))
        .otherwise(
            F.to_json(
                F.struct(
                    entity_id.alias("id"),
                    F.lit("Email").alias("schema"),
                    F.lit("mail").alias("collection_id"),
                    F.struct(F.col("url").alias("ui")).alias("links"),
                    F.struct(F.array("html").alias("bodyHtml")).alias("properties"),
                )
            )
        )
        .alias("body"),
    )
    return searches.unionAll(single).select(F.col("url").alias("response_id"), "url", "status", "body")
