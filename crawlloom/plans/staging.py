"""Intermediate tables, written once and laid out for the steps that follow."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from crawlloom.session import by_keys, scratch_path, shuffle_partitions


def stage(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Write ``df`` bucketed by ``keys`` to the shared folder and read it back.

    Later aggregates and joins by the keys need no shuffle, an executor that is
    lost costs only its own tasks, and what is expensive in ``df`` is done once.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (
        by_keys(df, keys)
        .write.format("parquet")
        .bucketBy(shuffle_partitions(spark), *keys)
        .option("path", scratch_path(spark, label))
        .saveAsTable(name)
    )
    return spark.table(name)
