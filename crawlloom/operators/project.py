"""Projections: text records, single fields, metadata rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlloom.functions.text import b64
from crawlloom.schema import TEXT_COLUMNS

# Field names a user can ask for and the columns they stand for.
FIELDS = {
    "id": "record_id",
    "uri": "uri",
    "mime": "content_type",
    "date": "date",
    "lang": "lang",
    "text": "text",
}


def to_text_record(df: DataFrame, **columns: Column) -> DataFrame:
    """The seven text-record columns; unnamed ones are taken as they are."""
    return df.select(
        *[F.coalesce(columns.get(c, F.col(c)), F.lit("")).alias(c) for c in TEXT_COLUMNS]
    )


def extract_field(df: DataFrame, field: str = "uri", base64: bool = False) -> DataFrame:
    """One field per record. An unknown field, ``offset`` included, is empty."""
    value = F.col(FIELDS[field]) if field in FIELDS else F.lit("")
    return df.select((b64(value) if base64 else value).alias("value"))
