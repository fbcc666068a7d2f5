"""Scalar text columns that need nothing but built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlloom.functions.columns import SPACE_CHARS, SPACE_CLASS
from crawlloom.schema import ARCHIVE_HEADERS


def clean_spaces(text: Column, reference: bool = False) -> Column:
    """One space between words, no blank lines, every line ends in a newline.

    ``reference=True`` also treats the code point U+C2A0 as a space.
    """
    extra = r"\x{c2a0}" if reference else ""
    one = F.regexp_replace(text, rf"[ \t\r\p{{Zs}}{extra}]+", " ")
    # a white-space run that holds a line break is one line break; the added one
    # ends the last line, and an empty text is left with nothing but that
    inline = SPACE_CLASS[:-1] + "&&[^\n]]"
    lines = F.regexp_replace(
        F.concat(one, F.lit("\n")), rf"{inline}*+\n{SPACE_CLASS}*+", "\n"
    )
    return F.ltrim(lines, F.lit(SPACE_CHARS))


def fix_utf8(body: Column) -> Column:
    """Bytes or text as valid UTF-8, invalid sequences becoming U+FFFD."""
    return F.make_valid_utf8(body.cast("string"))


def strip_record_id(record_id: Column) -> Column:
    """``<urn:uuid:X>`` becomes ``X``."""
    return F.regexp_replace(F.regexp_replace(record_id, "^<urn:uuid:", ""), r">\z", "")


def strip_replacement_char(text: Column) -> Column:
    return F.translate(text, "�", "")


def b64(text: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line, whatever the session's line setting."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def render_record(
    source: Column,
    date: Column,
    record_id: Column,
    uri: Column,
    content_type: Column,
    lang: Column,
    text: Column,
) -> Column:
    """Header block, blank line, text and a final newline of one archive member."""
    values = {
        "uri": uri,
        "content_type": content_type,
        "lang": lang,
        "date": date,
        "record_id": F.concat(F.lit("<urn:uuid:"), F.coalesce(record_id, F.lit("")), F.lit(">")),
        "source": source,
    }
    lines = [
        F.concat(
            F.lit(name + ": "),
            byte_length(F.coalesce(text, F.lit(""))).cast("string")
            if column is None
            else F.coalesce(values[column], F.lit("")),
        )
        for name, column in ARCHIVE_HEADERS
    ]
    return F.concat_ws("\n", *lines, F.lit(""), F.coalesce(text, F.lit("")), F.lit(""))
