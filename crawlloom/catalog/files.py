"""Checked queries that go through files: archives, sinks, whole pipelines."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlloom.catalog.language import _verdict_sql, model
from crawlloom.catalog.text import (
    HEADER,
    URI,
    _decode_sql,
    _spaces_sql,
    _strip_sql,
    hashed,
    table,
    table_stream,
    text_records,
)
from crawlloom.functions.text import clean_spaces
from crawlloom.plans.archives import archive_extract, archive_to_aligned
from crawlloom.plans.corpus import build_corpus, write_texts
from crawlloom.plans.reports import crawl_metadata, mime_histogram, write_crawl_metadata, write_mime_histogram
from crawlloom.schema import TEXT_TYPES
from crawlloom.session import scratch_path
from crawlloom.sources.aligned import META_COLUMNS, read_aligned, write_aligned_by_lang
from crawlloom.sources.archive import ArchiveDataSource, read_record_archive, write_record_archive
from crawlloom.sources.files import ORDINAL_ROOM, committed_files
from crawlloom.sources.hashes import parse_hashes, read_hashes, write_hashes
from crawlloom.sources.warc import read_warc
from crawlloom.sources.zips import zip_text
from crawlloom.streaming.ingest import incremental_ingest
from crawlloom.streaming.state import stateful_ingest

_written: dict[tuple, str] = {}
EOL = "\r\n"
# Estimated bytes of pages for a crawl archive; a few archives at least.
ARCHIVE_BYTES = 16 << 20
# the pages are all in UTF-8
UTF8_HEADER = HEADER.replace("iso-8859-1", "utf-8")


def _once(spark, sf, label, write) -> str:
    """Path of something written from the tables, made once per session."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def warc_archive(spark, sf) -> str:
    """All pages as crawl archives: compressed records, a source header per file."""

    def write(path):
        spark.dataSource.register(ArchiveDataSource)
        pages = table(spark, sf, "pages").select(
            "page_id", "html", F.expr(UTF8_HEADER).alias("header"), F.expr(URI).alias("uri")
        )
        # every 17th answer is not HTTP
        status = F.when(F.col("page_id") % 17 == 0, "broken").otherwise("HTTP/1.1 200 OK")
        payload = F.concat(
            status, F.lit(EOL + "Content-Type: "), F.trim("header"), F.lit(EOL * 2), "html"
        )
        record = F.concat(
            F.lit(f"WARC/1.0{EOL}WARC-Type: response{EOL}WARC-Target-URI: "),
            "uri",
            F.lit(f"{EOL}WARC-Date: 2020-01-01T00:00:00Z{EOL}WARC-Record-ID: <urn:uuid:"),
            F.col("page_id").cast("string"),
            F.lit(f">{EOL}Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
            F.octet_length("payload").cast("string"),
            F.lit(EOL * 2),
            "payload",
            F.lit(EOL * 2),
        )
        info = (
            f"WARC/1.0{EOL}WARC-Type: warcinfo{EOL}WARC-Filename: crawl.warc.gz{EOL}"
            f"Content-Type: application/warc-fields{EOL}Content-Length: 0{EOL * 3}"
        )
        # in page order, and the first record of every file names the crawl; as many files as the pages ask for
        pages_bytes = int(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        rows = (
            pages.withColumn("payload", payload)
            .withColumn("record", record)
            .repartitionByRange(max(4, pages_bytes // ARCHIVE_BYTES), "page_id")
            .sortWithinPartitions("page_id")
        )
        first = F.monotonically_increasing_id() % (1 << 33) == 0
        rows = rows.select(F.lit("").alias("folder"), F.when(first, F.concat(F.lit(info), "record")).otherwise(F.col("record")).alias("record"))
        rows.write.format("record_archive").mode("append").save(path)

    return _once(spark, sf, "warc", write)


def warc_records(spark, sf):
    return read_warc(spark, warc_archive(spark, sf)).filter("warc_type = 'response'").select(
        "record_id", "uri", "date", "http_ok", F.coalesce("http_status", F.lit(0)).alias("http_status"), F.octet_length("body").cast("long").alias("body_bytes")
    )


def _damaged(spark, sf, form: str) -> str:
    """Pages as crawl archives of one form, some of them malformed."""

    def write(path):
        spark.dataSource.register(ArchiveDataSource)
        kind = F.col("page_id") % 7
        head = F.when(kind == 2, f"Content-Length: 99999999{EOL}").when(kind == 3, f"Transfer-Encoding: chunked{EOL}").otherwise("")
        payload = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html{EOL}"), head, F.lit(EOL), "html")
        record = F.concat(
            F.when(kind == 1, EOL * 2).otherwise(""),
            F.lit(f"WARC/1.0{EOL}WARC-Type: response{EOL}WARC-Record-ID: <urn:uuid:"), F.col("page_id").cast("string"),
            F.lit(f">{EOL}Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
            # no number, one far beyond the record, or one that ends inside it
            F.when(kind == 0, F.when(F.col("page_id") % 3 == 0, "x").when(F.col("page_id") % 3 == 1, "9999").otherwise("30")).otherwise(""),
            F.when((kind == 0) & (F.col("page_id") % 3 == 2), "").otherwise(F.octet_length("payload").cast("string")),
            F.lit(EOL * 2), "payload", F.lit(EOL * 2),
        )
        pages = table(spark, sf, "pages").select("page_id", "html").withColumn("payload", payload)
        rows = pages.repartition(2, "page_id").select(record.alias("value"))
        if form == "members":
            members = rows.select(F.lit("").alias("folder"), F.col("value").alias("record"))
            members.write.format("record_archive").mode("append").save(path)
        else:  # one file of plain records, or one compressed member with all of them
            rows.write.option("compression", "gzip" if form == "member" else "none").text(path)

    return _once(spark, sf, f"damaged-{form}", write)


def warc_damaged(spark, sf):
    """Malformed records are left out alone, broken bodies are null, in any form of archive."""
    out = None
    for form in ("plain", "member", "members"):
        rows = read_warc(spark, _damaged(spark, sf, form)).select(
            F.lit(form).alias("form"), "record_id", F.coalesce(F.octet_length("body"), F.lit(-1)).cast("long").alias("body_bytes")
        )
        out = rows if out is None else out.union(rows)
    return out


def warc_split_records(spark, sf):
    """The same archives read in small byte ranges: no record lost or doubled."""
    whole = read_warc(spark, warc_archive(spark, sf), with_body=False)
    split = read_warc(spark, warc_archive(spark, sf), with_body=False, split_bytes=10_000)
    both = whole.select("filename", "ordinal", F.lit(1).alias("w"), F.lit(0).alias("s")).unionByName(
        split.select("filename", "ordinal", F.lit(0).alias("w"), F.lit(1).alias("s"))
    )
    each = both.groupBy("filename", "ordinal").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    return each.groupBy("w", "s").agg((F.count_if(F.col("ordinal") % ORDINAL_ROOM == 0)).alias("members"))


def warc_mime_histogram(spark, sf):
    return mime_histogram(read_warc(spark, warc_archive(spark, sf), with_body=False))


def warc_metadata(spark, sf):
    rows = crawl_metadata(read_warc(spark, warc_archive(spark, sf), bodies="text"), model(spark, sf))
    return rows.select("record_id", "uri", "date", "content_length", "content_type", "lang")


def _corpus(spark, sf):
    return build_corpus(read_warc(spark, warc_archive(spark, sf), bodies="text"), model(spark, sf))


def corpus(spark, sf):
    return _corpus(spark, sf).texts


def corpus_counters(spark, sf):
    return _corpus(spark, sf).counters


def archive_roundtrip(spark, sf):
    path = _once(spark, sf, "archive", lambda p: write_record_archive(text_records(spark, sf), p))
    return read_record_archive(spark, path).drop("file", "ordinal")


def archive_xz_by_lang(spark, sf):
    path = _once(
        spark, sf, "archive_xz",
        lambda p: write_record_archive(text_records(spark, sf), p, codec="xz", by_lang=True),
    )
    folder = F.regexp_extract("file", "lang=([^/]*)/", 1)
    return read_record_archive(spark, path).groupBy(folder.alias("folder"), "lang").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("text")).alias("bytes")
    )


def archive_fields(spark, sf):
    path = _once(spark, sf, "archive", lambda p: write_record_archive(text_records(spark, sf), p))
    return archive_extract(spark, path, "text", base64=True)


def aligned_by_lang_lines(spark, sf):
    """Lines written per language and column, read back by Spark."""
    path = _once(spark, sf, "by_lang", lambda p: write_aligned_by_lang(text_records(spark, sf), p))
    parts = []
    for column in ("mime", "url", "plain_text"):
        lines = spark.read.text([f for f in committed_files(path) if f.split("/")[-2] == column])
        folder = F.regexp_extract(F.input_file_name(), "lang=([^/]*)/", 1)
        parts.append(lines.select(folder.alias("lang"), F.lit(column).alias("part"), "value"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.groupBy("lang", "part").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("value").alias("distinct_lines")
    )


def archive_conversion(spark, sf):
    """Archive to aligned files; every file keeps its records."""
    archive = _once(spark, sf, "archive", lambda p: write_record_archive(text_records(spark, sf), p))
    path = _once(spark, sf, "converted", lambda p: archive_to_aligned(spark, archive, p, per_file=False))
    from crawlloom.sources.hashes import XzLinesDataSource

    spark.dataSource.register(XzLinesDataSource)
    lines = spark.read.format("xz_lines").load(f"{path}/url")
    return lines.select(F.col("value").alias("url"))


def archive_conversion_per_file(spark, sf):
    """The same with a folder for each input file; its records stay together and in step."""
    archive = _once(spark, sf, "archive", lambda p: write_record_archive(text_records(spark, sf), p))
    path = _once(spark, sf, "converted_each", lambda p: archive_to_aligned(spark, archive, p, per_file=True))
    rows = read_aligned(spark, path)
    files = F.count_distinct(F.regexp_extract("folder", "file=([^/]*)$", 1)) == read_record_archive(spark, archive).select("file").distinct().count()
    return rows.groupBy("uri", "content_type", "lang", F.sha2("text", 256).alias("text_hash")).agg(F.count(F.lit(1)).alias("records")).crossJoin(
        F.broadcast(rows.agg(files.alias("all_files")))
    )


def output_forms(spark, sf):
    """The corpus in each of the five forms of the main job, written and read back."""
    texts = _corpus(spark, sf).texts
    paths = {
        form: _once(spark, sf, f"form-{form}", lambda p, form=form: write_texts(texts, p, form))
        for form in ("aligned", "aligned_by_lang", "archive", "archive_by_lang", "archive_by_lang_xz")
    }
    out = None
    for form, path in paths.items():
        rows = read_aligned(spark, path) if form.startswith("aligned") else read_record_archive(spark, path)
        rows = rows.select(F.lit(form).alias("form"), "uri", "content_type", "lang", F.sha2("text", 256).alias("text_hash"))
        out = rows if out is None else out.union(rows)
    return out


def metadata_file(spark, sf):
    """The metadata report, written from the archives and read back."""
    path = _once(
        spark, sf, "metadata-tsv",
        lambda p: write_crawl_metadata(spark, warc_archive(spark, sf), p, model(spark, sf)),
    )
    parts = F.split("value", "\t")
    columns = [F.get(parts, F.lit(n)).alias(c) for n, c in enumerate(META_COLUMNS) if c != "filename"]
    return spark.read.text(path).select(*columns, F.size(parts).alias("columns"))


def mime_counts_file(spark, sf):
    """The content-type counts, written from the archives and read back."""
    path = _once(spark, sf, "mime-counts", lambda p: write_mime_histogram(spark, warc_archive(spark, sf), p))
    return spark.read.text(path).select("value")


def hash_files(spark, sf):
    keys = hashed(spark, sf, "murmur32").select("text_hash").distinct()
    path = _once(spark, sf, "hashes", lambda p: write_hashes(keys, p))
    return read_hashes(spark, path).join(keys, "text_hash").agg(F.count(F.lit(1)).alias("hashes"))


def hash_lines(spark, sf):
    """Numbers as text, some of them unusable, some beyond 32 bits."""
    lines = table(spark, sf, "events").select(
        F.expr(
            "CASE event_id % 4 WHEN 0 THEN concat(' ', user_id) WHEN 1 THEN concat('x', user_id) "
            "WHEN 2 THEN cast(4294967296 + event_id AS STRING) ELSE concat('-', user_id) END"
        ).alias("value")
    )
    return parse_hashes(lines)


@F.pandas_udf(T.BinaryType())
def _as_docx(text: pd.Series) -> pd.Series:
    def pack(t: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", "<Types/>")
            z.writestr("word/document.xml", t)
        return out.getvalue()

    return text.map(pack)


def zip_texts(spark, sf):
    kind = F.lit("application/vnd.openxmlformats-officedocument.wordprocessingml.document")
    packed = table(spark, sf, "documents").select("doc_id", _as_docx("text").alias("body"))
    return packed.select("doc_id", zip_text(F.col("body"), kind).cast("string").alias("text"))


def incremental_stream(spark, sf):
    """Documents through the streaming ingest, in their own order."""
    stream = table_stream(spark, sf, "documents")
    base = scratch_path(spark, "ingest")

    def prepare(batch):
        tidy = batch.select("doc_id", clean_spaces(F.col("text")).alias("text"))
        return tidy.withColumn("text_hash", F.sha2("text", 256))

    query = incremental_ingest(
        stream, f"{base}/out", f"{base}/hashes", f"{base}/checkpoint", ["doc_id"], prepare=prepare
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("doc_id", "text_hash")


def incremental_state(spark, sf):
    """Documents through the ingest that keeps its keys as state."""
    stream = table_stream(spark, sf, "documents")
    base = scratch_path(spark, "ingest-state")

    def prepare(rows):
        tidy = rows.select("doc_id", clean_spaces(F.col("text")).alias("text"))
        return tidy.select("doc_id", F.sha2("text", 256).alias("text_hash"))

    stateful_ingest(stream, f"{base}/out", f"{base}/checkpoint", ["doc_id"], prepare=prepare).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("doc_id", "text_hash")


_PAGES = f"""WITH r AS (SELECT page_id, html, trim({UTF8_HEADER}) AS header, {URI} AS uri, page_id % 17 <> 0 AS ok FROM pages),
  p AS (SELECT *, CASE WHEN ok THEN strlen(html) ELSE strlen(html) + strlen(header) + 26 END AS body_bytes,
    strlen(html) + strlen(header) + 20 + CASE WHEN ok THEN 15 ELSE 6 END AS content_length FROM r),
  t AS (SELECT *, trim(split_part(lower(header), ';', 1)) AS t0 FROM p),
  k AS (SELECT *, CASE WHEN t0 IN ('txt', 'text', 'text/plan') THEN 'text/plain' ELSE t0 END AS content_type FROM t)
"""

_TYPES = ", ".join(f"'{t}'" for t in TEXT_TYPES)
_TEXT_PAGES = f"""{_PAGES}, q AS (SELECT *, CASE WHEN ok AND content_type = 'text/plain' THEN {_decode_sql("html")} ELSE {_strip_sql(True)} END AS raw
    FROM k WHERE NOT ends_with(uri, 'robots.txt') AND (NOT ok OR (content_type IN ({_TYPES})
      AND NOT ends_with(uri, 'docx') AND NOT ends_with(uri, 'xslx') AND NOT ends_with(uri, 'odt'))))"""
_PAGE_VERDICT = _TEXT_PAGES + ", " + _verdict_sql("SELECT page_id AS id, '' AS gold, raw AS text FROM q")[5:]
_ACCEPTED = f"""{_PAGE_VERDICT}, ac AS (SELECT q.*, s3.lang, {_spaces_sql("raw")} AS tidy FROM q JOIN s3 ON s3.id = page_id
    WHERE reliable QUALIFY row_number() OVER (PARTITION BY {_spaces_sql("raw")} ORDER BY page_id) = 1)"""

_METADATA = f"""{_PAGES}, q AS (SELECT *, CASE WHEN content_type = 'text/plain' THEN {_decode_sql("html")} ELSE {_strip_sql(True)} END AS raw
          FROM k WHERE ok AND content_type IN ({_TYPES})),
        {_verdict_sql("SELECT page_id AS id, '' AS gold, raw AS text FROM q")[5:]}
        SELECT '<urn:uuid:' || k.page_id || '>' AS record_id, k.uri, '2020-01-01T00:00:00Z' AS date, k.content_length, k.content_type,
          CASE WHEN q.page_id IS NULL THEN '' ELSE coalesce(s3.lang, 'un') END AS lang/* more */
        FROM k LEFT JOIN q USING (page_id) LEFT JOIN s3 ON s3.id = k.page_id WHERE k.ok"""

ENTRIES = {
    "warc_damaged": (
        warc_damaged,
        """SELECT form, '<urn:uuid:' || page_id || '>' AS record_id,
          CASE WHEN page_id % 7 IN (2, 3) THEN -1 ELSE strlen(html) END AS body_bytes
        FROM pages, (VALUES ('plain'), ('member'), ('members')) f(form) WHERE page_id % 7 <> 0""",
    ),
    "warc_records": (
        warc_records,
        _PAGES
        + """SELECT '<urn:uuid:' || page_id || '>' AS record_id, uri, '2020-01-01T00:00:00Z' AS date, ok AS http_ok,
        CASE WHEN ok THEN 200 ELSE 0 END AS http_status, body_bytes FROM k""",
    ),
    "warc_split_records": (
        warc_split_records,
        "SELECT 1::BIGINT AS w, 1::BIGINT AS s, count(*) AS members FROM pages",
    ),
    "warc_mime_histogram": (
        warc_mime_histogram,
        _PAGES + "SELECT content_type, count(*) AS records FROM k WHERE ok GROUP BY 1",
    ),
    "warc_metadata": (warc_metadata, _METADATA),
    "corpus": (
        corpus,
        f"""{_ACCEPTED} SELECT 'crawl.warc.gz' AS source, '2020-01-01T00:00:00Z' AS date, page_id::VARCHAR AS record_id, uri,
        CASE WHEN ok THEN content_type ELSE 'application/http; msgtype=response' END AS content_type, lang, tidy AS text FROM ac""",
    ),
    "corpus_counters": (
        corpus_counters,
        f"""{_ACCEPTED} SELECT (SELECT count(*) FROM k) AS total_records, (SELECT sum(content_length) FROM k)::BIGINT AS total_bytes,
        (SELECT count(*) FROM q) AS text_records, (SELECT sum(content_length) FROM q)::BIGINT AS text_bytes,
        (SELECT count(*) FROM ac) AS lang_records, (SELECT sum(content_length) FROM ac)::BIGINT AS lang_bytes""",
    ),
    "archive_roundtrip": (
        archive_roundtrip,
        """SELECT source, '2020-01-01' AS date, doc_id::VARCHAR AS record_id,
        'http://' || source || '/' || doc_id AS uri, 'text/html' AS content_type, lang, text FROM documents""",
    ),
    "archive_xz_by_lang": (
        archive_xz_by_lang,
        "SELECT lang AS folder, lang, count(*) AS records, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY lang",
    ),
    "archive_fields": (archive_fields, "SELECT to_base64(encode(text)) AS value FROM documents"),
    "archive_conversion": (
        archive_conversion,
        "SELECT 'http://' || source || '/' || doc_id AS url FROM documents",
    ),
    "archive_conversion_per_file": (
        archive_conversion_per_file,
        """SELECT 'http://' || source || '/' || doc_id AS uri, 'text/html' AS content_type, NULL::VARCHAR AS lang, sha256(text) AS text_hash,
        1::BIGINT AS records, true AS all_files FROM documents""",
    ),
    "output_forms": (
        output_forms,
        f"""{_ACCEPTED} SELECT form, uri, CASE WHEN ok THEN content_type ELSE 'application/http; msgtype=response' END AS content_type, lang,
          sha256(tidy) AS text_hash
        FROM ac, (VALUES ('aligned'), ('aligned_by_lang'), ('archive'), ('archive_by_lang'), ('archive_by_lang_xz')) f(form)""",
    ),
    "metadata_file": (metadata_file, _METADATA.replace("/* more */", ", 7 AS columns").replace("k.content_length,", "k.content_length::VARCHAR AS content_length,")),
    "mime_counts_file": (
        mime_counts_file,
        _PAGES + "SELECT count(*) || chr(9) || content_type AS value FROM k WHERE ok GROUP BY content_type",
    ),
    "aligned_by_lang_lines": (
        aligned_by_lang_lines,
        """SELECT lang, 'mime' AS part, count(*) AS records, 1::BIGINT AS distinct_lines FROM documents GROUP BY lang
        UNION ALL SELECT lang, 'url', count(*), count(*) FROM documents GROUP BY lang
        UNION ALL SELECT lang, 'plain_text', count(*), count(DISTINCT text) FROM documents GROUP BY lang""",
    ),
    "hash_files": (hash_files, "SELECT count(DISTINCT text) AS hashes FROM documents"),
    "hash_lines": (
        hash_lines,
        """SELECT DISTINCT CASE event_id % 4 WHEN 0 THEN user_id WHEN 2 THEN event_id ELSE 4294967296 - user_id END
        & 4294967295 AS text_hash FROM events WHERE event_id % 4 <> 1""",
    ),
    "zip_texts": (zip_texts, "SELECT doc_id, text FROM documents"),
    "incremental_state": (
        incremental_state,
        f"""SELECT min(doc_id) AS doc_id, sha256({_spaces_sql("text")}) AS text_hash FROM documents GROUP BY text_hash""",
    ),
    "incremental_stream": (
        incremental_stream,
        f"""SELECT min(doc_id) AS doc_id, sha256({_spaces_sql("text")}) AS text_hash FROM documents GROUP BY text_hash""",
    ),
}
