"""Text of zip-based office documents and e-books."""

from __future__ import annotations

import io
import re
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlloom.functions.content_type import zip_member_pattern


def _members(body: bytes, pattern: str) -> bytes | None:
    try:
        archive = zipfile.ZipFile(io.BytesIO(body))
    except (zipfile.BadZipFile, ValueError, OSError):
        return None
    out = []
    for info in archive.infolist():
        if re.search(pattern, info.filename):
            try:
                out.append(archive.read(info))
            except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, OSError):
                continue
    return b"".join(out)


@F.pandas_udf(T.BinaryType())
def _zip_text(body: pd.Series, pattern: pd.Series) -> pd.Series:
    return pd.Series(
        [None if b is None or p is None else _members(b, p) for b, p in zip(body, pattern)],
        dtype=object,
    )


def zip_text(body: Column, kind: Column) -> Column:
    """Matching members joined in directory order; null when ``body`` is no zip.

    The members of one document stay in its row, so nothing is shuffled.
    """
    return _zip_text(body, zip_member_pattern(kind))
