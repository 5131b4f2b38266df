"""The item record: its Spark type, its field sets, and the JSON Schema made from them."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ("item_id", "agency_id", "agency_name", "spider", "source_url", "canonical_url", "title", "published_at", "collected_at", "run_id")
OPTIONAL_TEXT = ("claim", "summary", "verdict", "rating", "author", "body", "language", "country", "source_type")
LISTS = ("topics", "tags", "entities")
URI_FIELDS = ("source_url", "canonical_url")

#: Order of the columns as stored.
FIELDS = (*REQUIRED, *OPTIONAL_TEXT[:-1], *LISTS, "source_type")

ITEM = T.StructType(
    [
        T.StructField(f, T.ArrayType(T.StringType(), False) if f in LISTS else T.StringType(), f not in REQUIRED)
        for f in FIELDS
    ]
)

COUNTERS = ("items_seen", "items_stored", "items_deduped", "items_invalid")
_COUNTS = [T.StructField(c, T.LongType()) for c in COUNTERS]
SPIDER_STATS = T.StructType([*(T.StructField(c, T.StringType()) for c in ("agency_id", "agency_name", "started_at", "finished_at")), *_COUNTS])
RUN = T.StructType(
    [
        *(T.StructField(c, T.StringType()) for c in ("run_id", "started_at", "finished_at")),
        T.StructField("spiders", T.MapType(T.StringType(), SPIDER_STATS)),
        T.StructField("totals", T.StructType(_COUNTS)),
    ]
)
SEEN = T.StructType([T.StructField(c, T.StringType()) for c in ("item_id", "canonical_url", "source_url", "seen_at")])


def required_fields(schema: T.StructType = ITEM) -> list[str]:
    return sorted(f.name for f in schema if not f.nullable)


def optional_fields(schema: T.StructType = ITEM) -> list[str]:
    return sorted(f.name for f in schema if f.nullable)


def json_schema(schema: T.StructType = ITEM, title: str = "FactCheckItem") -> dict:
    """Draft 2020-12 schema of a flat record of strings, nullable strings and string lists; closed."""
    properties: dict[str, dict] = {}
    for field in schema:
        if isinstance(field.dataType, T.ArrayType):
            kind: dict = {"type": "array", "items": {"type": "string"}}
        else:
            kind = {"type": ["string", "null"] if field.nullable else "string"}
        if field.name in URI_FIELDS:
            kind["format"] = "uri"
        properties[field.name] = kind
    return {
        "$schema": "https://json-schema.org/draft/2020-12/schema",
        "title": title,
        "type": "object",
        "properties": properties,
        "required": required_fields(schema),
        "additionalProperties": False,
    }


def write_json_schema(path: str) -> None:
    Path(path).write_text(json.dumps(json_schema(), ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def normalise(df: DataFrame, *kept: str) -> DataFrame:
    """Only the item's columns (and ``kept``), missing ones as nulls, null lists as empty ones."""
    out = [F.col(f"`{c}`") for c in kept]
    for field in ITEM:
        column = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        column = column.cast(field.dataType.simpleString())
        out.append((F.coalesce(column, F.array().cast("array<string>")) if field.name in LISTS else column).alias(field.name))
    return df.select(*out)
