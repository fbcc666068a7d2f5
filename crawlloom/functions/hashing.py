"""Text hashes: the interoperable 32-bit one and two wider keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlloom.functions.columns import let

MASK = 0xFFFFFFFF
# Multipliers of 32-bit Murmur3 (public algorithm).
C1, C2, F1, F2 = 0xCC9E2D51, 0x1B873593, 0x85EBCA6B, 0xC2B2AE35
ADD = 0xE6546B64


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 32)


def _rotr(x: int, n: int) -> int:
    return ((x >> n) | (x << (32 - n))) & MASK


def _zero_seed() -> int:
    """The integer that Spark's ``hash`` maps to 0.

    ``hash(a, b)`` seeds b with the hash of a, so putting this value first turns
    the built-in's fixed seed 42 into seed 0. Every Murmur step can be inverted,
    which gives the value in closed form.
    """
    # the finaliser xors the length (4 bytes) and maps 0 to 0, so the state is 4
    k = 42 ^ _rotr((4 - ADD) * _inverse(5) & MASK, 13)
    x = _rotr(k * _inverse(C2) & MASK, 15) * _inverse(C1) & MASK
    return x - (1 << 32) if x >> 31 else x


ZERO_SEED = _zero_seed()


def _mul(c: Column, k: int) -> Column:
    """32-bit product without leaving the 64-bit range."""
    low = c.bitwiseAND(0xFFFF) * F.lit(k)
    high = (F.shiftright(c, 16) * F.lit(k)).bitwiseAND(0xFFFF)
    return (low + F.shiftleft(high, 16)).bitwiseAND(MASK)


def _xorshift(c: Column, *shifts: int) -> Column:
    for_xor = c
    for n in shifts:
        for_xor = for_xor.bitwiseXOR(F.shiftright(c, n))
    return for_xor


def _byte(data: Column, at: Column) -> Column:
    return F.coalesce(
        F.conv(F.hex(F.substr(data, at, F.lit(1))), 16, 10).cast("long"), F.lit(0)
    )


def murmur3_32(text: Column) -> Column:
    """Murmur3 x86 32-bit with seed 0 over the UTF-8 bytes, as an unsigned long.

    Spark's built-in follows the public algorithm on whole 4-byte blocks and
    differs in its seed and in the last one to three bytes. So the built-in hashes
    the block part, its finaliser is undone, and the tail is added the public way.
    """
    data = text.cast("binary")
    size = F.octet_length(data)

    def with_size(n: Column) -> Column:
        whole = n - n % 4
        blocks = F.substr(data, F.lit(1), whole)
        h = F.hash(F.lit(ZERO_SEED), blocks).cast("long").bitwiseAND(MASK)
        # undo the finaliser
        h = let(h, lambda x: _xorshift(x, 16))
        h = let(_mul(h, _inverse(F2)), lambda x: _xorshift(x, 13, 26))
        h = let(_mul(h, _inverse(F1)), lambda x: _xorshift(x, 16))
        state = h.bitwiseXOR(whole.cast("long"))
        # the bytes after the last whole block, little-endian
        tail = (
            _byte(data, whole + 1)
            + F.shiftleft(_byte(data, whole + 2), 8)
            + F.shiftleft(_byte(data, whole + 3), 16)
        )
        k = let(
            _mul(tail, C1),
            lambda x: F.shiftleft(x, 15).bitwiseOR(F.shiftright(x, 17)).bitwiseAND(MASK),
        )
        h = state.bitwiseXOR(let(k, lambda x: _mul(x, C2))).bitwiseXOR(n.cast("long"))
        # finalise with the true length
        h = let(h, lambda x: _xorshift(x, 16))
        h = let(let(h, lambda x: _mul(x, F1)), lambda x: _xorshift(x, 13))
        return let(let(h, lambda x: _mul(x, F2)), lambda x: _xorshift(x, 16))

    return F.when(text.isNotNull(), let(size, with_size))


def hash_key(text: Column, kind: str = "sha256") -> Column:
    """Deduplication key.

    ``sha256`` (default) never merges different texts; ``xxhash64`` and
    ``murmur32`` are smaller, and ``murmur32`` can be exchanged with other tools.
    """
    if kind == "sha256":
        return F.sha2(text.cast("binary"), 256)
    if kind == "xxhash64":
        return F.when(text.isNotNull(), F.xxhash64(text))
    if kind == "murmur32":
        return murmur3_32(text)
    raise ValueError(f"unknown hash kind {kind!r}")
