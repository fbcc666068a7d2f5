"""A Bloom filter as a table: which keys were certainly never seen.

Blocked: a key has all its bits in one block of 512, so a probe is one lookup by block number
in a table that is small enough to broadcast. Its size is fixed by the number of blocks;
beyond about 50 keys a block more and more keys pass, and the exact join behind it has more
to do, with the same result. Two filters of one size are united by their bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of a filter: 72 bytes each, so 19 MB, good for some 13 million keys.
BLOCKS = 1 << 18
#: Bits a key sets in its block of eight words of 64.
BITS, WORDS = 6, 8


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """The bits of a key, word by word."""
    h = F.xxhash64(F.lit(7), key)
    places = [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)) for i in range(BITS)]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def word(j: int) -> Column:
        bits = [F.when(F.shiftright(p, 6) == j, F.call_function("shiftleft", one, p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(zero) for p in places]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return [word(j) for j in range(WORDS)]


def bloom_of(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0 .. w7): one row for each block that a key falls into; null keys are left out."""
    rows = keys.filter(F.col(key).isNotNull()).select(
        _block(F.col(key), blocks).alias("block"), *[m.alias(f"w{j}") for j, m in enumerate(_masks(F.col(key)))]
    )
    return unite(rows)


def unite(filters: DataFrame) -> DataFrame:
    """The rows of several filters of one size as one filter."""
    return filters.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)])


def maybe_seen(df: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``df`` with ``_maybe``: false for keys that are certainly not in the filter.

    The filter has ``blocks`` rows at most, which bounds what is broadcast.
    """
    side = F.broadcast(bloom.select(F.col("block").alias("_block"), *[F.col(f"w{j}").alias(f"_w{j}") for j in range(WORDS)]))
    probed = df.withColumns({"_of": _block(F.col(key), blocks), **{f"_m{j}": m for j, m in enumerate(_masks(F.col(key)))}})
    held = reduce(lambda a, b: a & b, [F.col(f"_w{j}").bitwiseAND(F.col(f"_m{j}")) == F.col(f"_m{j}") for j in range(WORDS)])
    probed = probed.join(side, F.col("_of") == F.col("_block"), "left")
    return probed.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(held & F.col(key).isNotNull(), F.lit(False)).alias("_maybe"))
