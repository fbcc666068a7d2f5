"""Line-aligned column files and the tab-separated reports."""

from __future__ import annotations

import contextlib
import gzip
import itertools
import lzma
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from crawlloom.functions.text import b64
from crawlloom.sources.files import XZ_PRESET, ManifestCommitter, Split, Written, codec_of, file_system, paths_of, plan_splits

META_COLUMNS = ["filename", "record_id", "uri", "date", "content_length", "content_type", "lang"]


class AlignedWriter(DataSourceArrowWriter):
    """One file per column and task; line n of each belongs to the same record."""

    def __init__(self, options: dict[str, str], columns: Sequence[str]):
        self.codec = options.get("codec", "xz")
        self.columns = [c for c in columns if c != "folder"]
        self.committer = ManifestCommitter(options["path"])

    def _open(self, folder: str, column: str, own: str, written: Written):
        raw = self.committer.start(f"{folder}{column}/{own}", written)
        if self.codec == "xz":
            return raw, lzma.LZMAFile(raw, "wb", preset=XZ_PRESET)
        return raw, gzip.GzipFile(f"{column}.gz", "wb", 9, raw)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task, written, files = TaskContext.get(), Written(), {}
        own = self.committer.name(task.partitionId(), task.taskAttemptId(), self.codec)
        with self.committer.or_nothing(written):
            for batch in iterator:
                folders = batch.column("folder")
                for folder in folders.unique().to_pylist():
                    rows = batch.filter(pc.equal(folders, folder))
                    for column in self.columns:
                        if (folder, column) not in files:
                            files[folder, column] = self._open(folder, column, own, written)
                        lines = rows.column(column).to_pylist()
                        files[folder, column][1].write("".join(f"{x}\n" for x in lines).encode("utf-8"))
            for raw, packed in files.values():
                packed.close()
                raw.close()
        return written

    def commit(self, messages) -> None:
        self.committer.commit(messages)

    def abort(self, messages) -> None:
        self.committer.abort(messages)


#: Columns of aligned files, and the one whose files name the parts.
COLUMNS, LEAD = ["mime", "lang", "url", "plain_text"], "url"


class AlignedReader(DataSourceReader):
    """Records of aligned files: the parts of all columns are read in step."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def partitions(self) -> list[Split]:
        marker = f"/{LEAD}/"
        splits = plan_splits(self.path, divisible=False)
        return [s for s in splits if marker in s.path and s.path.rsplit("/", 2)[1] == LEAD]

    def _lines(self, opened: contextlib.ExitStack, lead: str, column: str) -> Iterator[bytes] | None:
        folder, part = lead.rsplit("/", 2)[0], lead.rsplit("/", 1)[1]
        fs = file_system(paths_of(self.path)[0])[0]
        path = f"{folder}/{column}/{part}"
        if fs.get_file_info(path).type != pafs.FileType.File:
            return None
        raw = opened.enter_context(fs.open_input_file(path))
        return opened.enter_context(lzma.open(raw) if codec_of(path) == "xz" else gzip.open(raw))

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        folder = partition.path.rsplit("/", 2)[0]
        with contextlib.ExitStack() as opened:
            lines = {c: self._lines(opened, partition.path, c) for c in COLUMNS}
            missing = [c for c in COLUMNS if lines[c] is None and c != "lang"]
            if missing:
                raise FileNotFoundError(f"{partition.path}: no {missing[0]} beside it")
            there, at = [c for c in COLUMNS if lines[c] is not None], 0
            rows = zip(*[lines[c] for c in there], strict=True)  # columns of different length are an error
            while batch := list(itertools.islice(rows, BATCH_LINES)):
                columns = dict(zip(there, zip(*batch, strict=True), strict=True))
                out = {"folder": [folder] * len(batch), "part": [partition.path.rsplit("/", 1)[1]] * len(batch), "line": list(range(at, at + len(batch)))}
                for c in COLUMNS:
                    out[c] = [x.decode("utf-8", "replace").rstrip("\n") for x in columns[c]] if c in columns else [None] * len(batch)
                at += len(batch)
                yield pa.RecordBatch.from_pydict(out, schema=to_arrow_schema(ALIGNED_LINES))


BATCH_LINES = 500
ALIGNED_LINES = T.StructType(
    [T.StructField("folder", T.StringType()), T.StructField("part", T.StringType()), T.StructField("line", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in COLUMNS]
)


class AlignedDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "aligned_text"

    def schema(self):
        return ALIGNED_LINES

    def reader(self, schema) -> AlignedReader:
        return AlignedReader(self.options)

    def writer(self, schema, overwrite: bool) -> AlignedWriter:
        if overwrite:
            raise ValueError("aligned files can only be appended to")
        return AlignedWriter(self.options, schema.names)


def read_aligned(spark: SparkSession, path: str) -> DataFrame:
    """(folder, part, line, content_type, lang, uri, text) of aligned files, whatever wrote them.

    ``folder`` holds the column folders; ``lang`` comes from its own file, else from the
    folder of a language, else it is null. Files that are in no manifest are left out.
    """
    spark.dataSource.register(AlignedDataSource)
    rows = spark.read.format("aligned_text").load(path)
    by_folder = F.regexp_extract("folder", "(?:^|/)lang=([^/]*)$", 1)
    return rows.select(
        "folder", "part", "line", F.col("mime").alias("content_type"),
        F.coalesce("lang", F.nullif(by_folder, F.lit(""))).alias("lang"), F.col("url").alias("uri"),
        F.unbase64("plain_text").cast("string").alias("text"),
    )


def aligned_columns(df: DataFrame, with_lang: bool = True, *extra: Column) -> DataFrame:
    """The lines of the aligned files: mime, lang (optional), url, plain_text."""
    columns = [F.col("content_type").alias("mime")]
    if with_lang:
        columns.append(F.col("lang"))
    columns += [F.col("uri").alias("url"), b64(F.col("text")).alias("plain_text")]
    return df.select(*extra, *columns)


def write_aligned(
    df: DataFrame,
    path: str,
    with_lang: bool = True,
    codec: str = "xz",
    partition: str | None = None,
) -> None:
    """Append text records as aligned column files, in one pass over the data.

    The parts of every column have the same names and line counts, so the parts
    joined in name order are aligned as well. ``partition`` names a column that
    becomes one folder per value; a value too frequent for one task is split.
    """
    df.sparkSession.dataSource.register(AlignedDataSource)
    folder = F.lit("")
    if partition:
        df = df.hint("rebalance", partition)
        folder = F.concat(F.lit(f"{partition}="), F.col(partition), F.lit("/"))
    lines = aligned_columns(df, with_lang, folder.alias("folder"))
    lines.write.format("aligned_text").option("codec", codec).mode("append").save(path)


def write_aligned_by_lang(df: DataFrame, path: str) -> None:
    """Aligned files below one folder per language; an empty language is an error."""
    checked = df.withColumn(
        "lang",
        F.when(F.length("lang") > 0, F.col("lang")).otherwise(
            F.raise_error(F.lit("invalid empty language"))
        ),
    )
    write_aligned(checked, path, with_lang=False, codec="gz", partition="lang")


def write_metadata_tsv(df: DataFrame, path: str) -> None:
    """Seven tab-separated columns per response, unquoted."""
    line = F.concat_ws(
        "\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in META_COLUMNS]
    )
    df.select(line.alias("value")).write.mode("append").text(path)


def write_mime_counts(df: DataFrame, path: str) -> None:
    """``count TAB type`` per line."""
    line = F.concat_ws("\t", F.col("records").cast("string"), "content_type")
    df.select(line.alias("value")).write.mode("append").text(path)
