"""Shape captured entity responses as files arrive.

Only the stateless part of log shaping runs here: decoding, slim records and bodies
need one row at a time, so the stream keeps no state and needs no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from entitylake import schema as S
from entitylake.operators import shape as SH
from entitylake.sources import logs as L
from entitylake.sources import payloads as PL

_HEAD = ("response_id", "url", "status")


def read_responses(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Captured responses as a stream of Parquet files."""
    return (
        spark.readStream.schema(S.RESPONSES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def shape_entities(responses: DataFrame, **options) -> DataFrame:
    """Slim JSON records of the single-entity responses; works on streams and tables."""
    entities = L.classify(responses).filter(F.col("kind") == "entity")
    scanned = PL.scan_entities(entities, "body", keep=_HEAD)
    return SH.to_json_records(SH.entity_records(scanned, keep=_HEAD, **options), keep=_HEAD)


def shape_hits(responses: DataFrame, **options) -> DataFrame:
    """Slim JSON records of every hit in the search responses, with its rank."""
    searches = L.classify(responses).filter(F.col("kind") == "search")
    keep = (*_HEAD, "rank")
    scanned = PL.scan_envelopes(searches, keep=_HEAD)
    return SH.to_json_records(SH.search_records(scanned, keep=keep, **options), keep=keep)


def write_records(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until everything that has arrived is done. The checkpoint folder
    lets a restarted job go on where the last one stopped."""
    return (
        records.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
