"""Record filters and content-type lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.functions.content_type import says_http_response
from crawlloom.schema import TEXT_TYPES, ZIP_RULES


def http_responses(df: DataFrame) -> DataFrame:
    return df.filter(says_http_response(F.col("rec_content_type")))


def type_dim(spark: SparkSession) -> DataFrame:
    """(content_type, kind, member_pattern) of every type the pipeline reads."""
    rows = [(t, "text", None) for t in TEXT_TYPES] + [(t, "zip", p) for t, _, p in ZIP_RULES]
    return spark.createDataFrame(rows, "content_type string, kind string, member_pattern string")


def classify_types(df: DataFrame) -> DataFrame:
    """Adds ``kind``: text, zip or other. The rule table has a fixed, tiny size."""
    rules = type_dim(df.sparkSession).select("content_type", "kind")
    return df.join(F.broadcast(rules), "content_type", "left").withColumn(
        "kind", F.coalesce("kind", F.lit("other"))
    )


def drop_unreadable(df: DataFrame, text: str = "text") -> DataFrame:
    """Leave out rows whose body could not be turned into text."""
    return df.filter(F.col(text).isNotNull())


def reliable_only(df: DataFrame) -> DataFrame:
    """Keep the rows whose language verdict is reliable."""
    return df.filter(F.coalesce("reliable", F.lit(False)))
