"""Markup cleaning of a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.functions.html import clean_text
from crawlloom.functions.text import clean_spaces
from crawlloom.session import spread


def strip_html(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Adds the clean text of every page."""
    return spread(pages).withColumn(out, clean_spaces(clean_text(F.col(html))))
