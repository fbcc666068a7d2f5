"""Small building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode defines it; the class is for Java regular expressions,
# the string for trim().
SPACE_CLASS = r"[\t-\r\x{85} \p{Z}]"
SPACE_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE_CHARS))
