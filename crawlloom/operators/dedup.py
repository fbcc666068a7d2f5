"""Exact deduplication within a run and across runs.

Copies of one text may be a large part of the input, so no step brings the rows of
one key together. Keys are reduced to their first position by an aggregate with
map-side combining, and the survivors are picked by a join on the position, which
is unique per row. The text takes part in that last join only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlloom.operators.bloom import BLOCKS, maybe_seen
from crawlloom.session import broadcast_if_small, materialize


def _position(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_positions(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, order columns) of the first row of every key."""
    first = df.groupBy(key).agg(F.min(_position(order)).alias("_first"))
    if len(order) == 1:
        return first.withColumnRenamed("_first", order[0])
    return first.select(key, "_first.*")


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key; ``order`` must identify a row."""
    order = list(order)
    return df.join(first_positions(df, key, order).select(*order), order, "left_semi")


def _without_seen(keys: DataFrame, key: str, seen: DataFrame, bloom: DataFrame | None, blocks: int) -> DataFrame:
    """Rows of ``keys``, one a key, whose key is not in ``seen``.

    With the filter, new keys pass it without a join. Those it cannot tell apart are few in a
    run of mostly new texts; then they are broadcast, and ``seen`` is scanned but not shuffled.
    """
    if bloom is None:
        return keys.join(seen.select(key), key, "left_anti")
    probed = materialize(maybe_seen(keys, key, bloom, blocks))
    unsure = probed.filter("_maybe").select(key)
    few = broadcast_if_small(unsure)
    known = seen.select(key) if few is None else seen.select(key).join(few, key, "left_semi").distinct()
    sure = probed.filter("not _maybe").drop("_maybe")
    return sure.union(probed.filter("_maybe").drop("_maybe").join(known, key, "left_anti").select(*sure.columns))


def dedup_unseen(
    df: DataFrame, key: str, order: Sequence[str], seen: DataFrame, bloom: DataFrame | None = None, blocks: int = BLOCKS
) -> DataFrame:
    """``dedup_first`` leaving out keys that earlier runs have accepted.

    The anti-join with ``seen`` runs on one row per key, so it cannot be skewed. ``bloom``
    is a filter over ``seen``, as ``bloom_of`` makes it with as many ``blocks``.
    """
    order = list(order)
    fresh = _without_seen(first_positions(df, key, order), key, seen, bloom, blocks)
    return df.join(fresh.select(*order), order, "left_semi")


def new_hashes(
    df: DataFrame, key: str, seen: DataFrame | None = None, bloom: DataFrame | None = None, blocks: int = BLOCKS
) -> DataFrame:
    """Distinct keys of this run that earlier runs have not accepted."""
    keys = df.select(key).distinct()
    return keys if seen is None else _without_seen(keys, key, seen, bloom, blocks)


def drop_seen(
    df: DataFrame, key: str, seen: DataFrame, bloom: DataFrame | None = None, blocks: int = BLOCKS
) -> DataFrame:
    """Drop the rows whose key is in ``seen``, keeping repeated new ones.

    One scan of each side. ``seen`` has one row a key after its aggregate; a key that
    very many rows of ``df`` share makes a skewed partition of the left side only,
    which adaptive execution splits. With ``bloom``, a filter over ``seen``, rows with a
    certainly new key are not shuffled; ``df`` is read once more for the others.
    """
    known = seen.select(key).distinct()
    if bloom is None:
        return df.join(known, key, "left_anti")
    probed = maybe_seen(df, key, bloom, blocks)
    columns = [key, *[c for c in df.columns if c != key]]
    sure = probed.filter("not _maybe").select(*columns)
    return sure.union(probed.filter("_maybe").join(known, key, "left_anti").select(*columns))
