"""Operators that depend on the order of records within a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Ordinals per block of carry_forward(): one task sorts one block of one file.
BLOCK = 100_000


def carry_forward(
    df: DataFrame,
    file: str,
    ordinal: str,
    is_marker: Column,
    value: Column,
    out: str,
    block: int = BLOCK,
) -> DataFrame:
    """Value of the latest marker row at or before each row of the same file.

    A file may be a large part of the input, so a window over whole files is
    avoided: files are cut into blocks of ``block`` ordinals, the last marker of
    each block is carried over the (few) blocks, and a window fills in each block.
    """
    marked = df.withColumn("_block", F.floor(F.col(ordinal) / F.lit(block))).withColumn(
        "_mark", F.when(is_marker, F.struct(value.alias("value")))
    )
    before = W.partitionBy(file).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        marked.groupBy(file, "_block")
        .agg(F.max_by("_mark", F.when(is_marker, F.col(ordinal))).alias("_last"))
        .select(file, "_block", F.last("_last", ignorenulls=True).over(before).alias("_in"))
    )
    within = (
        W.partitionBy(file, "_block").orderBy(ordinal).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        marked.join(carried, [file, "_block"])
        .withColumn("_here", F.last("_mark", ignorenulls=True).over(within))
        .withColumn(out, F.coalesce("_here", "_in")["value"])
        .drop("_block", "_mark", "_in", "_here")
    )


def limit_records(df: DataFrame, file: str, ordinal: str, n: int = -1) -> DataFrame:
    """First ``n`` records of every file, all of them when ``n`` is -1.

    Spark keeps only the first ``n`` of each map task before the shuffle.
    """
    if n < 0:
        return df
    rank = F.row_number().over(W.partitionBy(file).orderBy(ordinal))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def head_records(df: DataFrame, file: str, ordinal: str, n: int = 10) -> DataFrame:
    """First ``n`` records of every archive, ready to be written again."""
    return limit_records(df, file, ordinal, n)
