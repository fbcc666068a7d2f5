"""Words of Arrow text columns as 64-bit hashes, computed over whole buffers.

Used inside Arrow batches. Batches are cut into slices of a few MB of text, so the
working memory is a small multiple of a slice or of the longest text, if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
PIECE_BYTES = 2 << 20


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of bytes that end a word, from inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words are [^\x20\x09-\x0D]+.
BLANK = separators((0x20, 0x20), (0x09, 0x0D))
#: Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z have become a-z.
PUNCTUATION = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int, odd: bool = True) -> np.ndarray:
    out = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return out | np.uint64(1) if odd else out


_LETTER = constants(7, 256)
_LETTER[65:91] = _LETTER[97:123]
_STEP = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, byte offset of each row and the end)."""
    col = col.cast(pa.large_string()).fill_null("")
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < len(col):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        b = min(b, len(col))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_bounds(data: np.ndarray, ends: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word goes over the end of a row."""
    inside = ~sep[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = ends[(ends > 0) & (ends < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z; a polynomial modulo 2^64, then mixed."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE_BYTES, side="right")))
        a, b = int(start[i]), int(end[j - 1])
        up, down = _power_tables(max(b - a, PIECE_BYTES))
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_LETTER[data[a:b]] * up[: b - a], out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix64(out)
