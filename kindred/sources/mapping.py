"""Index mappings (JSON) as Spark schemas."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred import config

# Field types of a mapping and the Spark type each is stored as.
FIELD_TYPES = {
    "text": T.StringType(),
    "keyword": T.StringType(),
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "half_float": T.FloatType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
}


def default_mapping(source_key: str = config.SOURCE_KEY) -> dict:
    """One analysed text field with an untouched ``raw`` twin."""
    field = {"type": "text", "analyzer": "standard", "fields": {"raw": {"type": "keyword"}}}
    return {"mappings": {"properties": {source_key: field}}}


def link_mapping() -> dict:
    """Mapping of the nested link documents."""
    text = {"type": "text", "analyzer": "standard", "fields": {"raw": {"type": "keyword"}}}
    hit = {"keyword": text, "keyword_id": {"type": "integer"}, "score": {"type": "float"}}
    return {"mappings": {"properties": {"product_name": text, "keywords": {"type": "nested", "properties": hit}}}}


def schema_of(mapping: dict | str) -> T.StructType:
    """Spark schema of a mapping given as a dict or as JSON text."""
    parsed = json.loads(mapping) if isinstance(mapping, str) else mapping
    return _struct(parsed.get("mappings", parsed)["properties"])


def _struct(properties: dict) -> T.StructType:
    return T.StructType([T.StructField(name, _type(name, spec)) for name, spec in properties.items()])


def _type(name: str, spec: dict) -> T.DataType:
    kind = spec.get("type", "object")
    if kind in ("nested", "object"):
        if not spec.get("properties"):
            # an object of fields that are known only when documents arrive
            inner = T.MapType(T.StringType(), T.StringType())
        else:
            inner = _struct(spec["properties"])
        return T.ArrayType(inner) if kind == "nested" else inner
    if kind not in FIELD_TYPES:
        raise ValueError(f"field '{name}' has unknown type '{kind}'")
    return FIELD_TYPES[kind]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to ``schema`` by column name; fields it lacks become null,
    columns the schema does not know stay behind the known ones."""
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [F.col(name) for name in df.columns if name not in schema.fieldNames()]
    return df.select(*known, *extra)
