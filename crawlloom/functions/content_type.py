"""Content-type columns: cleaning, text and zip membership, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlloom.functions.columns import strip
from crawlloom.schema import CONTENT_TYPE_FIXES, TEXT_TYPES, ZIP_RULES


def says_http_response(rec_content_type: Column) -> Column:
    """The same as ``is_http_response`` but null for null: a form that filters can push to a reader."""
    return rec_content_type.contains("application/http") & rec_content_type.contains("response")


def is_http_response(rec_content_type: Column) -> Column:
    """The record itself says it holds an HTTP response (case-sensitive)."""
    return F.coalesce(says_http_response(rec_content_type), F.lit(False))


def not_robots(uri: Column) -> Column:
    return ~F.coalesce(uri.endswith("robots.txt"), F.lit(False))


def clean_content_type(header: Column) -> Column:
    """Lower-cased, trimmed type with known misspellings repaired; '' when absent."""
    kind = strip(F.substring_index(F.lower(F.coalesce(header, F.lit(""))), ";", 1))
    fixed = reduce(
        lambda acc, item: acc.when(kind == item[0], F.lit(item[1])),
        list(CONTENT_TYPE_FIXES.items())[1:],
        F.when(kind == next(iter(CONTENT_TYPE_FIXES)), F.lit(next(iter(CONTENT_TYPE_FIXES.values())))),
    )
    return fixed.otherwise(kind)


def content_charset(header: Column, reference: bool = False) -> Column:
    """Charset parameter of the header, '' when there is none.

    ``reference=True`` recognises it only directly after the semicolon.
    """
    parts = F.split(F.lower(F.coalesce(header, F.lit(""))), ";", 2)
    rest = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    if not reference:
        rest = strip(rest)
    return F.when(rest.startswith("charset="), F.substr(rest, F.lit(9))).otherwise(F.lit(""))


def is_text(content_type: Column) -> Column:
    return F.coalesce(content_type.isin(*TEXT_TYPES), F.lit(False))


def zip_type(content_type: Column, uri: Column) -> Column:
    """Canonical type of a zip-based document, null for everything else.

    The URI ending decides first, with or without a dot; then the type itself.
    """
    uri = F.coalesce(uri, F.lit(""))
    out = None
    for kind, endings, _ in ZIP_RULES:
        hit = reduce(lambda a, b: a | b, [uri.endswith(e) for e in endings])
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out.when(content_type.isin(*[r[0] for r in ZIP_RULES]), content_type)


def zip_member_pattern(kind: Column) -> Column:
    """Name pattern of the archive members that hold the text of ``kind``."""
    out = None
    for name, _, pattern in ZIP_RULES:
        hit = kind == name
        out = F.when(hit, F.lit(pattern)) if out is None else out.when(hit, F.lit(pattern))
    return out


def route(http_ok: Column, content_type: Column, uri: Column) -> Column:
    """'zip', 'text' or 'drop'. A record that is not valid HTTP goes on as text."""
    return (
        F.when(~http_ok, F.lit("text"))
        .when(zip_type(content_type, uri).isNotNull(), F.lit("zip"))
        .when(is_text(content_type), F.lit("text"))
        .otherwise(F.lit("drop"))
    )
