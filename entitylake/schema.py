"""The entity table: fixed outer columns around an open set of properties.

``texts`` holds the string values of the large body fields in a struct of its own, so
that a scan reads only the body field it needs and searches over ``props`` read none.
``heavy_props`` repeats a body field only where its display values differ from its
string values (numbers or objects in a body field), which is nearly never. ``linked`` has
the ids of properties that hold nested entities, and ``highlight_json`` a highlight that is
not only strings; both are NULL for most entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake import constants as K

_TEXT, _FLAG = T.StringType(), T.BooleanType()
_TEXT_LIST = T.ArrayType(_TEXT)


def _struct(*names: str, of: T.DataType = _TEXT) -> T.StructType:
    return T.StructType([T.StructField(name, of) for name in names])


_REFERENCES = T.ArrayType(_struct("schema", "caption", "id"))
_VALUE_LISTS = T.MapType(_TEXT, _TEXT_LIST)

ENTITIES = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in {
            "id": _TEXT,
            "own_id": _TEXT,
            "schema": _TEXT,
            "raw_schema": _TEXT,
            "schemata": _TEXT_LIST,
            "dataset": _TEXT,
            "collection_id": _TEXT,
            "score": T.DoubleType(),
            "link": _TEXT,
            "props": _VALUE_LISTS,
            "texts": _struct(*K.HEAVY_FIELDS, of=_TEXT_LIST),
            "heavy_props": _VALUE_LISTS,
            "present_keys": _TEXT_LIST,
            "parent": _REFERENCES,
            "parent_is_object": _FLAG,
            "ancestors": _REFERENCES,
            "ancestors_is_object": _FLAG,
            "recipients": T.ArrayType(_struct("schema", "id", "name", "email")),
            "highlight": _TEXT_LIST,
            "highlight_is_array": _FLAG,
            "document_ids": _TEXT_LIST,
            "page_index": T.DoubleType(),
            "rank": T.IntegerType(),
            "raw": _TEXT,
            "linked": _VALUE_LISTS,
            "highlight_json": _TEXT,
        }.items()
    ]
)
RESPONSES = T.StructType(
    [
        T.StructField("response_id", _TEXT),
        T.StructField("url", _TEXT),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", _TEXT),
    ]
)
CLOSURE = _struct("schema", "ancestor")

COLUMNS = ENTITIES.fieldNames()


def conform(df: DataFrame) -> DataFrame:
    """Give a table every entity column, in order; missing ones are NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({field.name if field.name in present else 'NULL'} AS {field.dataType.simpleString()})"
            f" AS {field.name}"
            for field in ENTITIES.fields
        ]
    )


def texts(**values: Column) -> Column:
    """The ``texts`` struct with the given body fields set."""
    empty = F.lit(None).cast("array<string>")
    return F.struct(*[values.get(name, empty).alias(name) for name in K.HEAVY_FIELDS])
