"""Lists of text hashes, one decimal number per line."""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from crawlloom.functions.hashing import MASK
from crawlloom.sources.files import Split, open_split, plan_splits


class XzLinesReader(DataSourceReader):
    """Lines of xz files, which Spark's text source cannot decompress."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Split]:
        return plan_splits(self.path, divisible=False)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        with open_split(self.path, partition) as file, lzma.open(file) as lines:
            while batch := lines.readlines(1 << 20):
                text = [x.decode("utf-8", "replace").rstrip("\n") for x in batch]
                yield pa.RecordBatch.from_pydict({"value": text})


class XzLinesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xz_lines"

    def schema(self):
        return "value string"

    def reader(self, schema) -> XzLinesReader:
        return XzLinesReader(self.options["path"])


def parse_hashes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct 32-bit hashes; a line that is not a number is left out."""
    number = F.trim(F.col(column)).try_cast("bigint")
    return (
        lines.select(number.bitwiseAND(MASK).alias("text_hash"))
        .filter(F.col("text_hash").isNotNull())
        .distinct()
    )


def read_hashes(spark: SparkSession, path: str, xz: bool = False) -> DataFrame:
    if not xz:
        return parse_hashes(spark.read.text(path))
    spark.dataSource.register(XzLinesDataSource)
    return parse_hashes(spark.read.format("xz_lines").load(path))


def write_hashes(df: DataFrame, path: str) -> None:
    """Append the hashes this run has accepted."""
    df.select(F.col("text_hash").cast("string").alias("value")).write.mode("append").text(path)
