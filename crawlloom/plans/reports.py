"""Crawl metadata and content-type counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.functions import content_type as C
from crawlloom.operators.langid.detect import detect_language, with_language
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.routing import http_responses
from crawlloom.operators.stats import mime_counts
from crawlloom.plans.corpus import KEYS, body_text
from crawlloom.plans.staging import stage
from crawlloom.sources.aligned import META_COLUMNS, write_metadata_tsv, write_mime_counts
from crawlloom.sources.warc import read_warc


def crawl_metadata(records: DataFrame, model: LangModel) -> DataFrame:
    """One row per parsed response, with the language even when it is doubtful.

    Responses that are not text, and texts that cannot be read, have language ''.
    """
    header = F.col("http_headers")["content-type"]
    typed = http_responses(records).filter("http_ok").withColumn(
        "content_type", C.clean_content_type(header)
    )
    text = body_text(
        F.when(C.is_text(F.col("content_type")), F.col("body")),
        F.col("content_type"),
        C.content_charset(header),
        F.col("content_type") == "text/plain",
    )
    staged = stage(typed.withColumn("text", text).drop("body", "http_headers"), KEYS, "metadata")
    readable = staged.filter(F.col("text").isNotNull())
    verdict = detect_language(readable, model, KEYS, colocated=True)
    named = with_language(staged, verdict, KEYS)
    lang = F.when(F.col("text").isNotNull(), F.col("lang")).otherwise("")
    return named.withColumn("lang", lang).select(*META_COLUMNS)


def write_crawl_metadata(spark: SparkSession, warc: str, out: str, model: LangModel) -> None:
    write_metadata_tsv(crawl_metadata(read_warc(spark, warc, bodies="text"), model), out)


def mime_histogram(records: DataFrame) -> DataFrame:
    return mime_counts(
        records,
        F.col("rec_content_type"),
        F.col("http_ok"),
        F.col("http_headers")["content-type"],
    )


def write_mime_histogram(spark: SparkSession, warc: str, out: str) -> None:
    """Headers only: payloads are passed over and never built."""
    write_mime_counts(mime_histogram(read_warc(spark, warc, with_body=False)), out)
