"""Record archives: one compressed member per text record."""

from __future__ import annotations

import gzip
import itertools
import logging
import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from crawlloom.functions.text import render_record, strip_record_id, strip_replacement_char
from crawlloom.schema import ARCHIVE_HEADERS, TEXT_COLUMNS, TEXT_RECORD
from crawlloom.sources.files import (
    DAMAGE,
    ORDINAL_ROOM,
    SPLIT_BYTES,
    XZ_PRESET,
    ManifestCommitter,
    Ranges,
    Split,
    Written,
    codec_of,
    members,
    open_split,
    packed,
    plan_splits,
    read_headers,
)

log = logging.getLogger(__name__)

ARCHIVE_RECORD = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("ordinal", T.LongType()), *TEXT_RECORD]
)
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20
# The default of gzip itself; the highest level takes a multiple of its time for about a percent.
GZIP_LEVEL = 6


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.codec = options.get("codec")
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.first = int(options.get("first", -1))
        self.arrow = to_arrow_schema(ARCHIVE_RECORD)

    def partitions(self) -> list[Ranges]:
        return packed(plan_splits(self.path, self.split_bytes))

    def _rows(self, split: Split) -> Iterator[dict]:
        skipped = 0
        with open_split(self.path, split) as file:
            codec = self.codec or codec_of(split.path)
            for offset, stream in members(file, split, codec):
                try:
                    found = read_headers(stream, skip_blank=True)
                    body = stream.read()
                except DAMAGE as e:
                    log.warning("skipping a damaged member of %s at byte %d: %s", split.path, offset, e)
                    skipped += 1
                    continue
                if found is None:
                    log.warning("skipping a member of %s at byte %d without headers", split.path, offset)
                    skipped += 1
                    continue
                headers = {k.lower(): v for k, v in reversed(found)}
                if headers.get("content-length", "").isdigit():
                    body = body[: int(headers["content-length"])]
                row = {"file": split.path, "ordinal": offset * ORDINAL_ROOM}
                for name, column in ARCHIVE_HEADERS:
                    if column:
                        row[column] = headers.get(name.lower(), "")
                row["text"] = body.decode("utf-8", "replace")
                yield row
        if skipped:
            log.warning("%d members of %s were skipped", skipped, split.path)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        most = self.first if self.first >= 0 else None
        for row in itertools.chain.from_iterable(itertools.islice(self._rows(s), most) for s in partition.ranges):
            rows.append(row)
            size += len(row["text"])
            if len(rows) == BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, self.arrow)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.arrow)


class ArchiveWriter(DataSourceArrowWriter):
    """Writes column ``record``, one member per row, to one file per task and folder."""

    def __init__(self, options: dict[str, str]):
        self.codec = options.get("codec", "gz")
        self.committer = ManifestCommitter(options["path"])

    def _compress(self, record: bytes) -> bytes:
        return lzma.compress(record, preset=XZ_PRESET) if self.codec == "xz" else gzip.compress(record, GZIP_LEVEL)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task, written, open_files = TaskContext.get(), Written(), {}
        own = self.committer.name(task.partitionId(), task.taskAttemptId(), self.codec)
        with self.committer.or_nothing(written):
            for batch in iterator:
                folders = batch.column("folder").to_pylist()
                for folder, record in zip(folders, batch.column("record").to_pylist()):
                    if folder not in open_files:
                        open_files[folder] = self.committer.start(f"{folder}{own}", written)
                    open_files[folder].write(self._compress(record.encode("utf-8")))
            for out in open_files.values():
                out.close()
        return written

    def commit(self, messages) -> None:
        self.committer.commit(messages)

    def abort(self, messages) -> None:
        self.committer.abort(messages)


class ArchiveDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_archive"

    def schema(self):
        return ARCHIVE_RECORD

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("a record archive can only be appended to")
        return ArchiveWriter(self.options)


def read_record_archive(
    spark: SparkSession, path: str, codec: str | None = None, first: int = -1
) -> DataFrame:
    """(file, ordinal, text record columns) of every member, in any number of files.

    U+FFFD is removed from every field and the record id is unwrapped. With ``first``
    no split is read beyond that many records; a file has at least its first ones.
    """
    spark.dataSource.register(ArchiveDataSource)
    reader = spark.read.format("record_archive")
    if codec:
        reader = reader.option("codec", codec)
    df = reader.option("first", str(first)).load(path)
    return df.select(
        "file", "ordinal", *[strip_replacement_char(F.col(c)).alias(c) for c in TEXT_COLUMNS]
    ).withColumn("record_id", strip_record_id(F.col("record_id")))


def write_record_archive(
    df: DataFrame, path: str, codec: str = "gz", by_lang: bool = False
) -> None:
    """Append text records to an archive folder, optionally one folder per language.

    By language, rows are first brought together per language by a rebalancing
    shuffle, which splits a language that is too large for one task.
    """
    df.sparkSession.dataSource.register(ArchiveDataSource)
    record = render_record(*[F.col(c) for c in TEXT_COLUMNS])
    folder = F.concat(F.lit("lang="), "lang", F.lit("/")) if by_lang else F.lit("")
    out = df.hint("rebalance", "lang") if by_lang else df
    out.select(folder.alias("folder"), record.alias("record")).write.format(
        "record_archive"
    ).option("codec", codec).mode("append").save(path)
