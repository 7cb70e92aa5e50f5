"""Entity tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from entitylake import schema as S


def write_entities(entities: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet, one directory per schema.

    The schema is the filter nearly every query carries and has few values. Collections
    are too many and too uneven for directories; inside a file rows are sorted by them,
    and the row group statistics of ``collection_id`` skip what a filter does not want.
    Rebalancing by schema gives files of the advised size: it splits a schema that holds
    most of the table over many tasks and keeps small ones from many tiny files.
    """
    S.conform(entities).withColumn("schema_dir", F.col("schema")).hint(
        "rebalance", F.col("schema_dir")
    ).sortWithinPartitions("schema_dir", "collection_id", "id").write.mode(mode).partitionBy(
        "schema_dir"
    ).parquet(path)


def read_entities(spark: SparkSession, path: str, schemas: list[str] | None = None) -> DataFrame:
    """The table again. ``schema`` is read from the directories, so every condition on the
    type, however it is written, opens only the directories it wants; ``schemas`` is one."""
    stored = StructType([*S.ENTITIES.fields, StructField("schema_dir", StringType())])
    table = spark.read.schema(stored).parquet(path).withColumn("schema", F.col("schema_dir"))
    if schemas:
        table = table.filter(F.col("schema").isin(*schemas))
    return table.select(*S.COLUMNS)


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines of JSON: the ``json`` column as it is, or every column of the table."""
    if "json" in rows.columns:
        rows.select(F.col("json").alias("value")).write.mode(mode).text(path)
    else:
        rows.write.mode(mode).json(path)


def raw_rows(entities: DataFrame) -> DataFrame:
    """The unshaped entities, one JSON object per row."""
    return entities.select("raw")
