"""Run counters and content-type statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlloom.functions.content_type import clean_content_type, is_http_response, says_http_response


def run_counters(
    df: DataFrame,
    is_total: Column,
    is_text: Column,
    is_lang: Column,
    content_length: Column,
) -> DataFrame:
    """One row: records and bytes seen, taken for text, and accepted."""
    aggs = []
    for name, flag in (("total", is_total), ("text", is_text), ("lang", is_lang)):
        aggs.append(F.count_if(flag).alias(f"{name}_records"))
        aggs.append(
            F.coalesce(F.sum(F.when(flag, content_length)), F.lit(0)).alias(f"{name}_bytes")
        )
    return df.agg(*aggs)


def content_type_stats(
    df: DataFrame,
    rec_content_type: Column,
    uri_ok: Column,
    http_ok: Column,
    header: Column,
) -> DataFrame:
    """Share of every cleaned content type, most frequent first.

    All HTTP responses are in the denominator; a type is counted only for parsed
    responses that are not robots files.
    """
    responses = df.filter(is_http_response(rec_content_type))
    counted = (
        responses.filter(uri_ok & http_ok)
        .groupBy(clean_content_type(header).alias("content_type"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    total = responses.agg(F.count(F.lit(1)))
    return counted.withColumn("prevalence", F.col("records") / total.scalar()).orderBy(
        F.desc("records"), "content_type"
    )


def mime_counts(
    df: DataFrame, rec_content_type: Column, http_ok: Column, header: Column
) -> DataFrame:
    """Records per cleaned content type over all parsed HTTP responses."""
    return (
        df.filter(says_http_response(rec_content_type) & http_ok)
        .groupBy(clean_content_type(header).alias("content_type"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
