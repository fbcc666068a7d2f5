"""Secret scans over content-addressed texts with an incremental ledger."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES_VERSION = 1
#: (kind, pattern, group whose length counts, least length), in the order that breaks ties.
RULES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    # runs of these characters are maximal, so a least length in the pattern drops the same matches
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
    ("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"), 0, 0),
)
KINDS = [r[0] for r in RULES]


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in the order of the rules."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(RULES):
        for m in pattern.finditer(text or ""):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def blob_id(text: Column) -> Column:
    """The address of a text: SHA-256 of its UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
FOUND = "blob binary, rules int, spans array<struct<kind:string,start:bigint,end:bigint>>"


def _scan(batches, version: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find_spans(text.as_py())] for text in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([version] * len(found), type=pa.int32()), pa.array(found, type=SPANS)],
            names=["blob", "rules", "spans"],
        )


class Ledger:
    """What has been scanned: one row for each (blob, rules version), with its spans.

    A Parquet table in a shared folder that is only appended to, so an ingest that fails
    midway has written nothing and is run again as it is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self, version: int = RULES_VERSION) -> DataFrame:
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], FOUND)
        return self.spark.read.schema(FOUND).parquet(self.path).filter(F.col("rules") == version)

    def ingest(
        self, versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", version: int = RULES_VERSION
    ) -> None:
        """Scan each text the ledger does not hold under this version of the rules, once.

        Copies are told apart by a narrow table of (blob, first id); only one row a blob
        is taken to the scan, so texts are shuffled by row and a blob with very many
        copies is no hot key.
        """
        rows = versions.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), blob_id(F.col(text_col)).alias("blob"))
        todo = rows.groupBy("blob").agg(F.min("id").alias("first"))
        todo = todo.join(self.rows(version).select("blob"), "blob", "left_anti")
        todo = todo.withColumnRenamed("blob", "b")
        named = rows.join(todo, (rows["blob"] == F.col("b")) & (rows["id"] == F.col("first"))).select("blob", "text")
        # of copies that have no id at all one is kept before the shuffle
        nameless = rows.filter("id is null").join(todo.filter("first is null"), rows["blob"] == F.col("b"), "left_semi")
        once = named.union(nameless.select("blob", "text").dropDuplicates(["blob"]))
        found = once.mapInArrow(lambda it: _scan(it, version), FOUND)
        # rows repeated under one id are scanned as often and written once
        found.dropDuplicates(["blob"]).write.mode("append").parquet(self.path)


def findings(
    versions: DataFrame, ledger: Ledger, id_col: str = "doc_id", text_col: str = "text", version: int = RULES_VERSION
) -> DataFrame:
    """(id, blob, spans) for every row of ``versions``: what the ledger knows of its text.

    Null and empty texts are one blob without spans. Rows repeated under one id, or
    without id, each come back. A text that was not ingested has null spans. An empty
    table gives an empty table. Other columns are not looked at.
    """
    rows = versions.select(F.col(id_col), blob_id(F.col(text_col)).alias("blob"))
    return rows.join(ledger.rows(version).select("blob", "spans"), "blob", "left")


def span_list(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
