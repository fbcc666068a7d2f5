"""Dropping lines that many documents share, by levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.llm.shared import ascii_lower, BLANKS, cut, delete_folder, Scratch
from crawlloom.session import scratch_path, shuffle_partitions

MIN_DOCS, MIN_CHARS, BATCHES, FANOUT = 10, 1, 4, 2


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(text: Column, min_chars: int) -> Column:
    """The hash of each line's key in order, null for keys that are too short."""
    keys = F.transform(F.transform(_lines(text), lambda x: F.btrim(x, F.lit(BLANKS))), ascii_lower)
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.xxhash64(k)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Document counts of line hashes in sorted runs that are merged level by level.

    Runs are bucketed and sorted by hash, so a batch meets them in a merge join without
    a shuffle of the runs. ``fanout`` runs of a level are compacted into one of the next.
    Keys that reach ``min_docs`` in a compaction move to the settled run; a later batch
    merge-anti-joins the settled runs and adds only the rest as its own run, so a line
    that is known to be frequent costs nothing more.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = shuffle_partitions(spark)
        # below the folder all executors share, wherever the warehouse is
        self.root = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.repartition(self.buckets, "key").sortWithinPartitions("key")
            .write.format("parquet").bucketBy(self.buckets, "key").sortBy("key")
            .option("path", f"{self.root}/{name}").saveAsTable(name)
        )
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """Counts of all runs: two runs at a time, merged where their sorted buckets meet."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(F.col("key").alias("key2"), F.col("docs").alias("docs2"))
            zero = F.lit(0).cast("long")
            out = out.join(other, F.col("key") == F.col("key2"), "full").select(
                F.coalesce("key", "key2").alias("key"),
                (F.coalesce("docs", zero) + F.coalesce("docs2", zero)).alias("docs"),
            )
        return out

    def add(self, counts: DataFrame) -> None:
        """Add a batch of (key, docs), at most one row a key."""
        for name in self.settled:
            counts = counts.join(self.spark.table(name), "key", "left_anti")
        self.levels[0].append(self._write(counts.select("key", "docs")))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self._compact(level)

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        merged = self._write(self._merged(names))
        frequent = F.col("docs") >= self.min_docs
        self.settled.append(self._write(self.spark.table(merged).filter(frequent)))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self._write(self.spark.table(merged).filter(~frequent)))
        self._discard([*names, merged])
        self.levels[level] = []

    def frequent(self) -> DataFrame:
        """Keys in at least ``min_docs`` documents of all batches so far."""
        pending = [n for level in self.levels for n in level]
        parts = [self._merged(pending).filter(F.col("docs") >= self.min_docs)] if pending else []
        parts += [self.spark.table(n) for n in self.settled]
        out = parts[0].select("key")
        for part in parts[1:]:
            out = out.union(part.select("key"))
        return out

    def _discard(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(self.spark, f"{self.root}/{name}")

    def discard(self) -> None:
        self._discard([n for level in self.levels for n in level] + self.settled)


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with ``text`` less its common lines, plus ``n_lines`` and ``n_dropped``.

    Keys (``line_key``) of at least ``min_chars`` characters found in ``min_docs`` or
    more rows lose all their lines. Keys are compared by 64-bit hash: over a corpus the
    expected number of wrongly dropped lines is frequent keys x lines / 2^64.

    Null and empty texts are one empty line and come back as "". Rows repeated under one
    id, or without id, each count as a document and each come back. A line repeated in
    one document counts once. An empty table gives an empty table. Other columns, also
    ones named as this function's own, are kept untouched, except ``n_lines`` and
    ``n_dropped``, which are replaced.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    scratch = Scratch(spark, "lines")
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    hashed = scratch.put(
        "hashes",
        docs.select(
            F.col(id_col).alias("_id"), row.alias("_row"), line_hashes(F.col(text_col), min_chars).alias("keys")
        ),
    )
    counts = (
        hashed.select(
            F.pmod(F.xxhash64("_id"), F.lit(batches)).alias("batch"),
            F.explode(F.array_distinct("keys")).alias("key"),
        )
        .filter("key is not null").groupBy("batch", "key").agg(F.count(F.lit(1)).alias("docs"))
    )
    counts = cut(counts)
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for batch in range(batches):
            runs.add(counts.filter(F.col("batch") == batch))
        frequent = cut(runs.frequent())
    finally:
        runs.discard()

    at = hashed.select("_id", "_row", F.posexplode("keys").alias("pos", "key"))
    hit = (
        at.join(frequent, "key").groupBy(F.col("_id").alias("_id2"), F.col("_row").alias("_row2"))
        .agg(F.collect_set("pos").alias("hit"))
    )
    # the document is one column here, so its names cannot meet those of the join
    whole = docs.select(F.struct(*rest).alias("_doc"), row.alias("_row"))
    doc_id, doc_text = F.col("_doc")[id_col], F.col("_doc")[text_col]
    whole = whole.join(hit, doc_id.eqNullSafe(F.col("_id2")) & (F.col("_row") == F.col("_row2")), "left")
    hits = F.coalesce(F.col("hit"), F.array().cast("array<int>"))

    def without_hits(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), hits)
        return F.array_join(F.transform(kept, lambda p: F.get(lines, p)), "\n")

    # the one-element array makes the lines a variable, split once and not for each line
    cleaned = F.get(F.transform(F.array(_lines(doc_text)), without_hits), F.lit(0))
    text = F.when(F.size(hits) == 0, F.coalesce(doc_text, F.lit(""))).otherwise(cleaned)
    joined = F.replace(F.coalesce(doc_text, F.lit("")), F.lit("\n"), F.lit(""))
    n_lines = F.octet_length(F.coalesce(doc_text, F.lit(""))) - F.octet_length(joined) + 1
    return whole.select(
        *[text.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in rest],
        n_lines.cast("long").alias("n_lines"), F.size(hits).cast("long").alias("n_dropped"),
    )
