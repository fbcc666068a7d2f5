"""Incremental ingest: each micro-batch against everything accepted before."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlloom.operators.bloom import BLOCKS, bloom_of, unite
from crawlloom.operators.dedup import dedup_unseen
from crawlloom.session import materialize


def _filter_before(spark: SparkSession, filters: str, batch_id: int, blocks: int) -> DataFrame | None:
    """The filter the batch before has left, if it is there."""
    path = f"{filters}/blocks={blocks}/batch_id={batch_id - 1}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def incremental_ingest(
    stream: DataFrame,
    out: str,
    hashes: str,
    checkpoint: str,
    order: Sequence[str],
    key: str = "text_hash",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    bloom_blocks: int = BLOCKS,
) -> StreamingQuery:
    """Append the new texts of a stream to ``out`` and their keys to ``hashes``.

    The accepted keys are a table, not state of the query, so they may outgrow
    memory and be shared by several queries. Every micro-batch writes folders of
    its own by overwriting them and looks at earlier batches only; one that is
    repeated after a failure therefore gives the same result. ``prepare`` turns a
    batch into rows with ``key`` and the columns of ``order``. ``trigger`` are the
    arguments of the query's trigger, by default all that is there now.

    Beside the keys, under ``hashes`` with ``-bloom`` behind its name, every batch leaves the
    Bloom filter over all keys so far: the one before it united with its own. A batch of
    new texts so passes without a shuffle of the accepted keys. A filter of another size
    than ``bloom_blocks``, or none, is made anew from the keys.
    """
    filters = f"{hashes.rstrip('/')}-bloom"

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # read twice below: cleaned and hashed once
        rows = materialize(prepare(batch) if prepare else batch)
        kind = rows.schema[key].dataType
        schema = T.StructType([T.StructField(key, kind), T.StructField("batch_id", T.LongType())])
        own = f"{hashes}/batch_id={batch_id}"
        # an empty folder of this batch makes the table readable from the start
        spark.createDataFrame([], T.StructType(schema.fields[:1])).write.mode(
            "overwrite"
        ).parquet(own)
        seen = spark.read.schema(schema).parquet(hashes).filter(F.col("batch_id") < batch_id)
        before = _filter_before(spark, filters, batch_id, bloom_blocks)
        if before is None:
            before = bloom_of(seen, key, bloom_blocks)
        accepted = f"{out}/batch_id={batch_id}"
        dedup_unseen(rows, key, order, seen, before, bloom_blocks).write.mode("overwrite").parquet(accepted)
        added = spark.read.parquet(accepted).select(key).distinct()
        added.write.mode("overwrite").parquet(own)
        both = unite(before.union(bloom_of(added, key, bloom_blocks)))
        both.coalesce(1).write.mode("overwrite").parquet(f"{filters}/blocks={bloom_blocks}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
