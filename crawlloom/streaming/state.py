"""Incremental ingest with the accepted keys in the query's own state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_of_every_key(stream: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row by ``order`` of every key, in the batch in which the key turns up.

    One flag a key is kept in the state store, whose checkpoint brings it back after a
    restart. The rows of a key pass by in Arrow batches and the best so far is held, so a key
    with very many rows costs its task time, but no memory.
    """
    order = list(order)

    def pick(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for rows in batches:
            if not state.exists:
                rows = rows if best is None else pd.concat([best, rows])
                best = rows.sort_values(order, kind="stable").head(1)
        if best is not None:
            state.update((True,))
            yield best

    return stream.groupBy(key).applyInPandasWithState(
        pick, stream.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout
    )


def stateful_ingest(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    order: Sequence[str],
    key: str = "text_hash",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the new texts of a stream to ``out``; the accepted keys are state of this query.

    The same rows as ``incremental_ingest`` gives, without a table of keys to read in every
    batch and without one to share: the keys live and die with ``checkpoint``. On a
    cluster use the RocksDB state store, so that they need not fit in memory. ``prepare``
    turns the stream into rows with ``key`` and the columns of ``order`` by itself, without
    aggregates.
    """
    rows = prepare(stream) if prepare else stream
    return (
        first_of_every_key(rows, key, order)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
