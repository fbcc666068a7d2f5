"""Helpers the operators share: staged tables, row keys, ASCII-only text rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlloom.session import scratch_path, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: \x20 and \x09-\x0D, the characters that end a word or pad a line.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files, in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Intermediate tables in the folder all executors share.

    A written table cuts the lineage: a lost executor costs its running tasks only.
    ``drop`` removes what no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, label), {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, self.paths.pop(name))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow frame with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` is many times faster than ``translate`` and says the same unless another
    upper-case or title-case letter is there.
    """
    other = col.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(other, F.translate(col, UPPER, LOWER)).otherwise(F.lower(col))


def held(col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a row without id counts as 0."""
    return F.coalesce(F.crc32(col.cast("string")), F.lit(0)) % parts


def bounded_blocks(rows: DataFrame, size: str, most: int, row: str = "_row") -> tuple[DataFrame, list[tuple[int, int]]]:
    """``rows`` with (_bucket, _piece), and the blocks these name: each of ``most`` in size and one row at most.

    Rows are dealt to buckets by a hash of ``row``, and cut at running sums inside a bucket.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(row), F.lit(total // most + 1)))
    before = F.coalesce(F.sum(size).over(Window.partitionBy("_bucket").orderBy(row).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = dealt.withColumn("_piece", F.floor(before / most))
    blocks = dealt.select("_bucket", "_piece").distinct().collect()
    return dealt, sorted((r["_bucket"], r["_piece"]) for r in blocks)
