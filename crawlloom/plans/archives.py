"""Reading record archives back: conversion, field extraction, heads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.operators.order import head_records, limit_records
from crawlloom.operators.project import extract_field
from crawlloom.sources.aligned import write_aligned
from crawlloom.sources.archive import read_record_archive, write_record_archive
from crawlloom.sources.files import file_system


def archive_to_aligned(
    spark: SparkSession,
    path: str,
    out: str,
    per_file: bool = True,
    n: int = -1,
    codec: str | None = None,
) -> None:
    """Convert archives to aligned files: a folder per input file without language
    lines, or everything together with them."""
    records = limit_records(read_record_archive(spark, path, codec, n), "file", "ordinal", n)
    if per_file:
        # by the path below ``path``: equal names in two folders stay apart
        root = file_system(path)[1].rstrip("/") + "/"
        below = F.substr("file", F.lit(len(root) + 1))
        name = F.when(F.startswith("file", F.lit(root)), below).otherwise(F.substring_index("file", "/", -1))
        named = records.withColumn("file", name)
        write_aligned(named, out, with_lang=False, partition="file")
    else:
        write_aligned(records, out)


def archive_extract(
    spark: SparkSession,
    path: str,
    field: str = "uri",
    base64: bool = False,
    n: int = -1,
    codec: str | None = None,
) -> DataFrame:
    """One field of every record, optionally in base64."""
    records = limit_records(read_record_archive(spark, path, codec, n), "file", "ordinal", n)
    return extract_field(records, field, base64)


def archive_head(
    spark: SparkSession, path: str, out: str, n: int = 10, codec: str | None = None
) -> None:
    """The first records of every archive, written as an archive."""
    records = head_records(read_record_archive(spark, path, codec, n), "file", "ordinal", n)
    write_record_archive(records, out, codec or "gz")
