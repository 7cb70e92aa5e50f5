"""Entity tables that skip what a date, number or id condition does not want.

Values of properties live in a map, where Parquet has no statistics for one key. So the least and
greatest date or number of chosen keys become columns of their own when the table is written, and
rows are sorted along a space-filling curve over collection and dates: row groups then span few
collections and few days, and their statistics skip the others. Ids get Bloom filters in the
footers, so a lookup opens the row groups that may hold an id and no others.

Conditions made here imply the ones in ``operators.predicates``; they add the test on the columns
and select the same rows. They are for filters: where no value is of the kind they are NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from entitylake import schema as S
from entitylake.functions import bounds as B
from entitylake.operators import predicates as P

#: What a zone may hold, as Spark names the types.
KINDS = {"date": DateType(), "double": DoubleType()}
CURVE_BITS = 15
#: Rows of a row group that lookups skip or read, by way of the size of a group.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def _names(key: str) -> tuple[str, str]:
    return f"zone_{key}_low", f"zone_{key}_high"


def _checked(zones: Mapping[str, str]) -> dict[str, str]:
    unknown = {kind for kind in zones.values() if kind not in KINDS}
    if unknown:
        raise ValueError(f"zones hold {' or '.join(KINDS)}, not {sorted(unknown)}")
    return dict(zones)


def zone_columns(zones: Mapping[str, str]) -> dict[str, Column]:
    """Least and greatest value of each key, over the values that are of its kind; NULL for none."""
    found = {}
    for key, kind in _checked(zones).items():
        low, high = _names(key)
        found[low], found[high] = F.array_min(_cast(key, kind)), F.array_max(_cast(key, kind))
    return found


def _cast(key: str, kind: str) -> Column:
    return F.filter(F.transform(P.values(key), lambda v: v.try_cast(kind)), lambda v: v.isNotNull())


def curve(*coordinates: Column) -> Column:
    """Numbers of ``CURVE_BITS`` bits as one: their bits taken in turn, so neighbours stay near in all of them."""
    total = F.lit(0).cast("long")
    for bit in range(CURVE_BITS):
        for place, value in enumerate(coordinates):
            one = F.shiftright(value.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(one, bit * len(coordinates) + place))
    return total


def _coordinates(zones: Mapping[str, str]) -> list[Column]:
    """Collection by hash, and the day of the first date zone, from 1880 on; later and earlier days share the ends."""
    most = (1 << CURVE_BITS) - 1
    spread = F.pmod(F.xxhash64("collection_id"), F.lit(most + 1))
    days = [F.col(_names(key)[0]) for key, kind in zones.items() if kind == "date"]
    if not days:
        return [spread]
    day = F.coalesce(F.date_diff(days[0], F.lit("1880-01-01").cast("date")), F.lit(0)).cast("long")
    # A day is worth half a step: 179 years over the whole curve would waste the finest bits.
    return [spread, F.least(F.greatest(day / 2, F.lit(0)), F.lit(most)).cast("long")]


def placed(entities: DataFrame, zones: Mapping[str, str]) -> DataFrame:
    """Rows as they are written: each task's by schema and along the curve.

    Rows stay in the tasks they come from. Entity rows are wide, and a shuffle that only gathered a
    schema's rows would not bring neighbours on the curve together: files span all of it either way,
    their row groups do not.
    """
    rows = S.conform(entities).withColumns(zone_columns(zones)).withColumn("schema_dir", F.col("schema"))
    order = rows.withColumn("curve", curve(*_coordinates(_checked(zones))))
    return order.sortWithinPartitions("schema_dir", "curve", "id").drop("curve")


def write_zoned(
    entities: DataFrame,
    path: str,
    zones: Mapping[str, str],
    mode: str = "errorifexists",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """The entity table with zone columns, one directory per schema, along the curve, Bloom filters for ids."""
    (
        placed(entities, zones).write.mode(mode)
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .partitionBy("schema_dir")
        .parquet(path)
    )


def read_zoned(spark: SparkSession, path: str, zones: Mapping[str, str]) -> DataFrame:
    """The table with its zone columns behind the entity columns; the schema comes from the directories."""
    extra = [StructField(name, KINDS[kind]) for key, kind in _checked(zones).items() for name in _names(key)]
    stored = StructType([*S.ENTITIES.fields, *extra, StructField("schema_dir", StringType())])
    table = spark.read.schema(stored).parquet(path).withColumn("schema", F.col("schema_dir"))
    return table.select(*S.COLUMNS, *[field.name for field in extra])


def date_between(key: str, low: str, high: str) -> Column:
    """``predicates.prop_date_between`` over a zoned table."""
    first, last = F.lit(low).cast("date"), F.lit(P.period_end(high)).cast("date")
    return _within(key, first, last) & P.prop_date_between(key, low, high)


def date_cmp(key: str, op: str, date: str) -> Column:
    """``predicates.prop_date_cmp`` over a zoned table."""
    return _bounded(key, op, F.lit(date).cast("date")) & P.prop_date_cmp(key, op, date)


def num_cmp(key: str, op: str, number: float) -> Column:
    """``predicates.prop_num_cmp`` over a zoned table."""
    return _bounded(key, op, F.lit(float(number))) & P.prop_num_cmp(key, op, number)


def _within(key: str, first: Column, last: Column) -> Column:
    low, high = _names(key)
    return (F.col(low) <= last) & (F.col(high) >= first)


def _bounded(key: str, op: str, value: Column) -> Column:
    low, high = (F.col(name) for name in _names(key))
    tests = {">": high > value, ">=": high >= value, "<": low < value, "<=": low <= value, "=": (low <= value) & (high >= value)}
    return tests[op]


def lookup(entities: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Entities by a few ids: an equality per id, which the footers' Bloom filters answer."""
    wanted = list(dict.fromkeys(B.required_id(one) for one in ids))
    condition = F.lit(False)
    for one in wanted:
        condition = condition | (F.col("id") == one)
    return entities.filter(condition)
