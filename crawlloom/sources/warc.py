"""Crawl archives as a Spark data source."""

from __future__ import annotations

import contextlib
import itertools
import logging
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    IsNotNull,
    IsNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema

from crawlloom.schema import CONTENT_TYPE_FIXES, TEXT_TYPES, WARC_RECORD, ZIP_RULES
from crawlloom.sources.files import (
    DAMAGE,
    ORDINAL_ROOM,
    SPLIT_BYTES,
    Ranges,
    Split,
    codec_of,
    member_at,
    members,
    open_split,
    packed,
    plan_splits,
    read_headers,
)
from crawlloom.sources.framing import Records, Scout

log = logging.getLogger(__name__)

BATCH_BYTES, BATCH_ROWS = 8 << 20, 1000
BODIES = ("all", "text", "none")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_STATUS = re.compile(rb"HTTP/\d+\.\d+ (\d{3})(?: .*)?\Z")


def _unchunk(body: bytes) -> bytes | None:
    """The chunks put together, or None when one is broken or the last is missing."""
    out, pos = [], 0
    while True:
        eol = body.find(b"\n", pos)
        size = body[pos:eol].split(b";")[0].strip() if eol >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        size = int(size, 16)
        if size == 0:
            return b"".join(out)
        chunk = body[eol + 1 : eol + 1 + size]
        pos = eol + 1 + size
        mark = body[pos : pos + 2]
        if len(chunk) < size or not (mark == b"\r\n" or mark[:1] == b"\n"):
            return None
        out.append(chunk)
        pos += 2 if mark == b"\r\n" else 1


class _Lines:
    """Line reader over bytes that knows where it is."""

    def __init__(self, data: bytes):
        self.data, self.pos = data, 0

    def readline(self) -> bytes:
        end = self.data.find(b"\n", self.pos) + 1 or len(self.data)
        line, self.pos = self.data[self.pos : end], end
        return line


def parse_http(payload: bytes) -> tuple[int, dict[str, str], bytes | None] | None:
    """(status, headers by lower-case name, body), or None when it is not HTTP.

    The body is None when it is shorter than announced or a chunk is broken.
    """
    lines = _Lines(payload)
    status = _STATUS.match(lines.readline().rstrip(b"\r\n"))
    if status is None:
        return None
    found = read_headers(lines)
    if found is None:
        return None
    headers: dict[str, str] = {}
    for name, value in found:
        headers.setdefault(name.lower(), value)
    body = payload[lines.pos :]
    if headers.get("transfer-encoding", "").lower() == "chunked":
        body = _unchunk(body)
    elif headers.get("content-length", "").isdigit():
        size = int(headers["content-length"])
        body = body[:size] if len(body) >= size else None
    return int(status[1]), headers, body


# Headers a filter can look at before the payload is read, by the column they become.
_BEFORE_PAYLOAD = {
    "warc_type": "warc-type", "rec_content_type": "content-type", "record_id": "warc-record-id",
    "uri": "warc-target-uri", "date": "warc-date", "warc_filename": "warc-filename",
}


def _test(condition: Filter) -> Callable[[dict[str, str]], bool | None] | None:
    """A filter as a function of the record's headers that may answer null; None when it has to stay with Spark."""
    if isinstance(condition, Not):
        inner = _test(condition.child)
        if inner is None:
            return None

        def negated(h):
            found = inner(h)
            return None if found is None else not found

        return negated
    column = getattr(condition, "attribute", ())
    name = _BEFORE_PAYLOAD.get(column[0]) if len(column) == 1 else None
    if name is None:
        return None
    if isinstance(condition, IsNull):
        return lambda h: name not in h
    if isinstance(condition, IsNotNull):
        return lambda h: name in h
    value = getattr(condition, "value", None)
    if isinstance(condition, EqualNullSafe):
        return lambda h: h.get(name) == value
    if isinstance(condition, In):
        some, unknown = {v for v in condition.value if v is not None}, None in condition.value
        return lambda h: None if name not in h else True if h[name] in some else None if unknown else False
    rules = {
        EqualTo: lambda x: x == value, StringContains: lambda x: value in x,
        StringStartsWith: lambda x: x.startswith(value), StringEndsWith: lambda x: x.endswith(value),
    }
    rule = rules.get(type(condition))
    if rule is None or not isinstance(value, str):
        return None
    return lambda h: rule(h[name]) if name in h else None


def _is_response(fields: dict[str, str]) -> bool:
    kind = fields.get("content-type", "")
    return "application/http" in kind and "response" in kind


def holds_text(content_type: str, uri: str) -> bool:
    """Whether a body of this type is read as text, also from inside a zip-based document."""
    kind = content_type.split(";")[0].strip().lower()
    kind = CONTENT_TYPE_FIXES.get(kind, kind)
    return kind in TEXT_TYPES or any(kind == name or uri.endswith(tuple(ends)) for name, ends, _ in ZIP_RULES)


def _until_damage(read: Callable[[int], bytes], damage: list[Exception]) -> Callable[[int], bytes]:
    """``read`` that ends where the data are damaged, and says so."""

    def careful(n: int) -> bytes:
        try:
            return b"" if damage else read(n)
        except DAMAGE as e:
            damage.append(e)
            return b""

    return careful


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.bodies = options.get("bodies", "all")
        if self.bodies not in BODIES:
            raise ValueError(f"bodies must be one of {BODIES}, not {self.bodies!r}")
        self.arrow = to_arrow_schema(WARC_RECORD)
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on record headers are decided before a payload is built."""
        for condition in filters:
            if _test(condition) is None:
                yield condition
            else:
                self.conditions.append(condition)

    def partitions(self) -> list[Ranges]:
        return packed(plan_splits(self.path, self.split_bytes))

    def _wanted(self):
        """What ``Records`` asks about a record's payload."""
        tests = [_test(c) for c in self.conditions]

        def wanted(fields: dict[str, str]):
            if not all(t(fields) for t in tests):
                return None
            if not _is_response(fields):
                return 0
            if self.bodies == "all":
                return lambda head: True
            return lambda head: needs_body(head, parse_http(head), fields.get("warc-target-uri", ""))

        def needs_body(head: bytes, parsed, uri: str) -> bool:
            if parsed is None:  # its headers go beyond the first bytes, or it is no HTTP
                return self.bodies == "text" or len(head) == Records.HEAD
            return self.bodies == "text" and holds_text(parsed[1].get("content-type", ""), uri)

        return wanted

    def _row(self, path: str, ordinal: int, fields: dict[str, str], payload: bytes) -> dict:
        response = _is_response(fields)
        parsed = parse_http(payload) if response else None
        row = {
            "filename": path,
            "ordinal": ordinal,
            "warc_type": fields.get("warc-type"),
            "rec_content_type": fields.get("content-type"),
            "record_id": fields.get("warc-record-id"),
            "uri": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"),
            "warc_filename": fields.get("warc-filename"),
            "content_length": int(fields["content-length"]),
            "http_ok": parsed is not None,
            "http_status": parsed and parsed[0],
            "http_headers": parsed and list(parsed[1].items()),
            "body": None,
        }
        if response and self.bodies != "none":
            if parsed is None:
                row["body"] = payload
            elif self.bodies == "all" or holds_text(parsed[1].get("content-type", ""), row["uri"] or ""):
                row["body"] = parsed[2]
        return row

    def _rows(self, split: Split) -> Iterator[dict]:
        codec, skipped = codec_of(split.path), 0
        with contextlib.ExitStack() as opened:
            file = opened.enter_context(open_split(self.path, split))

            def again(offset: int):
                second = opened.enter_context(open_split(self.path, split))
                return member_at(second, offset, codec) if codec else second.read

            streams = members(file, split, codec) if codec else [(0, file)]
            for offset, stream in streams:
                damage: list[Exception] = []
                records = Records(
                    _until_damage(stream.read1 if codec else stream.read, damage),
                    Scout(lambda at=offset: _until_damage(again(at), [])), self._wanted(),
                )
                for n, fields, payload in records:
                    yield self._row(split.path, offset * ORDINAL_ROOM + n, fields, payload)
                for e in damage[:1]:
                    log.warning("skipping a damaged record in %s: %s", split.path, e)
                skipped += max(records.skipped, len(damage[:1]))
        if skipped:
            log.warning("%d records of %s were skipped", skipped, split.path)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in itertools.chain.from_iterable(map(self._rows, partition.ranges)):
            rows.append(row)
            size += len(row["body"] or b"") + 500
            if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(rows, self.arrow)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.arrow)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``.

    ``ordinal`` grows with the position in the file. Options: ``bodies`` (``all``, ``text``
    for those alone that are read as text, ``none`` for header-only jobs) and
    ``split_bytes``. Payloads of other bodies, and of records that a pushed filter on a record
    header leaves out, are passed over and never built.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return WARC_RECORD

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(
    spark: SparkSession, path: str, with_body: bool = True, split_bytes: int = SPLIT_BYTES, bodies: str | None = None
) -> DataFrame:
    """Records of archives. ``with_body=False`` is short for ``bodies="none"``.

    Filters on headers of the record reach the reader when
    ``spark.sql.python.filterPushdown.enabled`` is on. It is turned on here unless the
    application's configuration names it.
    """
    if spark.sparkContext.getConf().get(PUSHDOWN) is None:
        spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("bodies", bodies or ("all" if with_body else "none"))
    return reader.option("split_bytes", str(split_bytes)).load(path)


FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _read_files(batches, split_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            reader = WarcReader({"path": row["path"], "split_bytes": split_bytes})
            yield from reader.read(Ranges([Split(row["path"], row["start"], row["stop"])]))


def stream_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files of a folder, each file once, whatever its name and age.

    Spark's own file source lists the files and keeps those it has seen in the
    query's checkpoint; their contents are not read through it. Large compressed files
    are dealt out in splits.
    """
    files = (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("recursiveFileLookup", "true").option("maxFileAge", "36500d").load(path)
    )
    step = F.when(F.col("path").rlike(r"\.(gz|xz)$"), F.lit(split_bytes)).otherwise(F.greatest("length", F.lit(1)))
    splits = files.filter("length > 0").select(
        F.regexp_replace("path", r"^file:/+", "/").alias("path"), "length", step.alias("step"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step.cast("long"))).alias("start"),
    )
    splits = splits.select("path", "start", F.least(F.col("start") + F.col("step"), "length").alias("stop"))
    # files are listed by few tasks and read by many
    return splits.repartition("path", "start").mapInArrow(lambda it: _read_files(it, split_bytes), WARC_RECORD)
