"""Checked queries over pages and documents: types, text, hashes, dedup, order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.functions import content_type as C
from crawlloom.functions import html as H
from crawlloom.functions import text as X
from crawlloom.functions.hashing import hash_key, murmur3_32
from crawlloom.operators import dedup, order, project, routing, stats
from crawlloom.operators.bloom import BLOCKS, bloom_of
from crawlloom.operators.langid.dims import language_name
from crawlloom.operators.langid.hints import host_tld, html_lang_tags
from crawlloom.operators.langid.refine import valid_utf8_bytes
from crawlloom.plans.strip import strip_html
from crawlloom.session import spread
from crawlloom.sources.aligned import META_COLUMNS, aligned_columns

# Pages have no headers; these stand in for them, the same text for both engines.
HEADER = (
    "CASE page_id % 7 WHEN 0 THEN 'text/html; charset=UTF-8' WHEN 1 THEN ' TEXT ' "
    "WHEN 2 THEN 'text/plan;charset=iso-8859-1' WHEN 3 THEN 'Application/XHTML+XML;x=y' "
    "WHEN 4 THEN 'image/png' WHEN 5 THEN 'application/epub+zip' ELSE 'text/html;charset=utf-8' END"
)
URI = (
    "CASE page_id % 9 WHEN 0 THEN concat(url, '/robots.txt') WHEN 1 THEN concat(url, '/a.docx') "
    "WHEN 2 THEN concat(url, '/b.xslx') WHEN 3 THEN concat(url, '.odt') ELSE url END"
)
REC_TYPE = (
    "CASE page_id % 11 WHEN 0 THEN 'application/http; msgtype=request' "
    "WHEN 1 THEN 'application/warc-fields' ELSE 'application/http; msgtype=response' END"
)
HTTP_OK = "page_id % 13 <> 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same as a stream, whether the table is one file or a folder of part files.

    The name is given as a pattern: a stream takes any other path for a folder.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as responses with stand-in headers."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.octet_length("html").cast("long").alias("content_length"),
        F.expr(HEADER).alias("header"),
        F.expr(URI).alias("uri"),
        F.expr(REC_TYPE).alias("rec_content_type"),
        F.expr(HTTP_OK).alias("http_ok"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text records."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.lit("2020-01-01").alias("date"),
        F.concat(F.lit("<urn:uuid:"), F.col("doc_id").cast("string"), F.lit(">")).alias("record_id"),
        F.concat(F.lit("http://"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("uri"),
        F.lit("text/html").alias("content_type"),
        "lang",
        "text",
    )


def hashed(spark: SparkSession, sf_dir: str, kind: str = "sha256") -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.withColumn("text_hash", hash_key(F.col("text"), kind))


def seen_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of an earlier run: the documents that carry a label."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return hashed(spark, sf_dir).join(labels, "doc_id", "left_semi").select("text_hash").distinct()


def content_type_clean(spark, sf):
    return records(spark, sf).select(
        "page_id",
        C.clean_content_type(F.col("header")).alias("content_type"),
        C.content_charset(F.col("header")).alias("charset"),
        C.content_charset(F.col("header"), reference=True).alias("charset_strict"),
    )


def content_type_prevalence(spark, sf):
    return stats.content_type_stats(
        records(spark, sf),
        F.col("rec_content_type"),
        C.not_robots(F.col("uri")),
        F.col("http_ok"),
        F.col("header"),
    )


def mime_histogram(spark, sf):
    return stats.mime_counts(
        records(spark, sf), F.col("rec_content_type"), F.col("http_ok"), F.col("header")
    )


def text_route(spark, sf):
    r = routing.http_responses(records(spark, sf)).filter(C.not_robots(F.col("uri")))
    kind = C.clean_content_type(F.col("header"))
    return r.select(
        "page_id",
        "uri",
        C.zip_type(kind, F.col("uri")).alias("zip_type"),
        C.is_text(kind).alias("is_text"),
        C.route(F.col("http_ok"), kind, F.col("uri")).alias("route"),
    )


def type_kinds(spark, sf):
    typed = records(spark, sf).select(
        "content_length", C.clean_content_type(F.col("header")).alias("content_type")
    )
    return (
        routing.classify_types(typed)
        .groupBy("kind", "content_type")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("content_length").alias("bytes"))
    )


def run_counters(spark, sf):
    kind = C.clean_content_type(F.col("header"))
    route = C.route(F.col("http_ok"), kind, F.col("uri"))
    total = C.is_http_response(F.col("rec_content_type"))
    text = total & C.not_robots(F.col("uri")) & (route != "drop")
    return stats.run_counters(
        records(spark, sf), total, text, text & (F.col("content_length") > 2000), F.col("content_length")
    )


def html_strip(spark, sf):
    once = H.unescape_native(H.strip_markup_native(F.col("html")))
    return spread(table(spark, sf, "pages")).select("page_id", X.clean_spaces(once).alias("text"))


def html_exact(spark, sf):
    return strip_html(table(spark, sf, "pages").select("page_id", "html")).select("page_id", "text")


def html_unescape(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.html_unescape(F.col("url")).alias("url"),
                                            H.html_unescape(F.col("html")).alias("html"))


def nfkc(spark, sf):
    return table(spark, sf, "documents").select("doc_id", H.nfkc(F.col("text")).alias("text"))


def recode_utf8(spark, sf):
    body = F.encode(F.col("html"), "UTF-8")
    return table(spark, sf, "pages").select(
        "page_id", H.recode(body, F.lit("utf-8")).alias("html"), valid_utf8_bytes(body).alias("valid_bytes")
    )


def _one_byte(html):
    """Characters without a byte of their own in a western charset as references."""
    return F.array_join(
        F.transform(
            F.split(html, ""),
            lambda c: F.when((F.ascii(c) > 255) | F.ascii(c).between(128, 159), F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c),
        ),
        "",
    )


def recode_latin1(spark, sf):
    """Whole pages written with one byte a character and read back by their charset."""
    body = F.encode(_one_byte(F.col("html")), "ISO-8859-1")
    return spread(table(spark, sf, "pages")).select(
        "page_id",
        H.recode(body, F.lit("iso-8859-1")).alias("html"),
        F.octet_length(X.fix_utf8(F.encode(F.col("html"), "UTF-8"))).cast("long").alias("fixed_bytes"),
    )


# Beginnings of pages by page_id: what looks like a declaration and is none, and two that are.
DECLARATIONS = {
    0: """<script charset="iso-8859-1">var m = "<meta charset=koi8-r>";</script>""",
    1: """<p>Write charset=latin1 – café</p>""",
    2: """<!-- <meta charset=iso-8859-1> -->""",
    3: """<meta charset="iso-8859-1">""",
    4: """<META content='text/html; charset = "ISO-8859-1"' Http-Equiv="Content-Type"/>""",
    5: """<meta name=x content="charset=koi8-r"><p title='<meta charset=koi8-r>' lang=fr>""",
    6: """<meta charset=no-such-charset><title><meta charset=koi8-r></title>""",
}
DECLARED = "CASE page_id % 7 " + " ".join("WHEN {} THEN '{}'".format(k, v.replace("'", "''")) for k, v in DECLARATIONS.items()) + " END"


def recode_declared(spark, sf):
    """Pages without a charset in their header, read by what their own tags declare."""
    start, western = F.expr(DECLARED.replace("''", "\\'")), (F.col("page_id") % 7).isin(3, 4)
    body = F.when(western, F.encode(F.concat(start, _one_byte(F.col("html"))), "ISO-8859-1")).otherwise(
        F.encode(F.concat(start, F.col("html")), "UTF-8")
    )
    return spread(table(spark, sf, "pages")).select("page_id", H.recode(body, F.lit("")).alias("html"))


def clean_spaces(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", X.clean_spaces(F.col("text")).alias("text"))


def strip_ids(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        X.strip_record_id(F.col("record_id")).alias("record_id"),
        X.strip_replacement_char(F.concat(F.lit("�"), "text", F.lit("�"))).alias("text"),
        X.byte_length(F.col("text")).cast("long").alias("bytes"),
    )


def exact_dedup_first(spark, sf):
    return dedup.dedup_first(hashed(spark, sf), "text_hash", ["doc_id"]).select("doc_id", "text")


def drop_seen_hashes(spark, sf):
    return dedup.drop_seen(hashed(spark, sf), "text_hash", seen_hashes(spark, sf)).select("doc_id", "text")


def drop_seen_filtered(spark, sf):
    """The same through a Bloom filter over the hashes, and a far too small one."""
    seen, out = seen_hashes(spark, sf), None
    for blocks in (2, BLOCKS):
        bloom = bloom_of(seen, "text_hash", blocks)
        rows = dedup.drop_seen(hashed(spark, sf), "text_hash", seen, bloom, blocks).select(F.lit(blocks).alias("blocks"), "doc_id", "text_hash")
        out = rows if out is None else out.union(rows)
    return out


def dedup_unseen(spark, sf):
    out = dedup.dedup_unseen(hashed(spark, sf), "text_hash", ["doc_id"], seen_hashes(spark, sf))
    return out.select("doc_id", "text_hash")


def new_hashes(spark, sf):
    return dedup.new_hashes(hashed(spark, sf), "text_hash", seen_hashes(spark, sf))


def hash_keys(spark, sf):
    return hashed(spark, sf).select("doc_id", "text_hash")


def murmur_groups(spark, sf):
    """How many texts occur how often, counted by hash."""
    docs = spread(table(spark, sf, "documents").select("text")).select(
        murmur3_32(F.col("text")).alias("h")
    )
    sizes = docs.groupBy("h").agg(F.count(F.lit(1)).alias("copies"))
    return sizes.groupBy("copies").agg(F.count(F.lit(1)).alias("texts"))


def xxhash_groups(spark, sf):
    sizes = hashed(spark, sf, "xxhash64").groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies"))
    return sizes.groupBy("copies").agg(F.count(F.lit(1)).alias("texts"))


def carry_filename(spark, sf):
    log = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return order.carry_forward(
        log, "user_id", "event_id", F.col("event_type") == "signup", F.col("props"), "filename", 500
    ).select("event_id", "user_id", "filename")


def head_records(spark, sf):
    return order.head_records(documents(spark, sf), "source", "doc_id", 10).select("doc_id", "source", "uri")


def limit_records(spark, sf):
    docs = table(spark, sf, "events").select("event_id", "event_type")
    return order.limit_records(docs, "event_type", "event_id", 25)


def field_extract(spark, sf):
    return project.extract_field(documents(spark, sf), "uri")


def field_extract_b64(spark, sf):
    return project.extract_field(documents(spark, sf), "text", base64=True)


def text_records(spark, sf):
    return project.to_text_record(
        documents(spark, sf), record_id=X.strip_record_id(F.col("record_id"))
    )


def record_render(spark, sf):
    columns = ["source", "date", "record_id", "uri", "content_type", "lang", "text"]
    rendered = text_records(spark, sf).select(X.render_record(*[F.col(c) for c in columns]).alias("record"))
    return rendered


def aligned_lines(spark, sf):
    return aligned_columns(documents(spark, sf))


def metadata_rows(spark, sf):
    rows = routing.http_responses(records(spark, sf)).filter("http_ok").select(
        F.lit("a.warc.gz").alias("filename"),
        F.col("page_id").cast("string").alias("record_id"),
        "uri",
        F.lit("2020-01-01").alias("date"),
        "content_length",
        C.clean_content_type(F.col("header")).alias("content_type"),
        F.lit("").alias("lang"),
    )
    return rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in META_COLUMNS]).alias("line"))


def html_lang_tag_list(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", html_lang_tags(F.col("html")).alias("tags"), host_tld(F.col("url")).alias("tld")
    )


def language_names(spark, sf):
    codes = table(spark, sf, "documents").select(
        "doc_id",
        F.expr(
            "CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN concat(lang, '-Latn') "
            "WHEN 2 THEN concat(lang, '-Latn-XX') ELSE 'un' END"
        ).alias("code"),
    )
    return language_name(codes)


_RECORDS = f"""WITH r AS (
  SELECT page_id, url, strlen(html) AS content_length, {HEADER} AS header, {URI} AS uri,
         {REC_TYPE} AS rec_content_type, ({HTTP_OK}) AS http_ok FROM pages),
t AS (SELECT *, trim(split_part(lower(header), ';', 1)) AS t0,
      CASE WHEN contains(header, ';') THEN substr(lower(header), strpos(header, ';') + 1) ELSE '' END AS rest
      FROM r),
k AS (SELECT *, CASE WHEN t0 IN ('txt', 'text', 'text/plan') THEN 'text/plain' ELSE t0 END AS content_type,
      contains(rec_content_type, 'application/http') AND contains(rec_content_type, 'response') AS is_http,
      NOT ends_with(uri, 'robots.txt') AS not_robots FROM t),
ty AS (SELECT *, content_type IN ('text/plain', 'text/html', 'text/vnd.wap.wml', 'application/xml',
        'application/atom+xml', 'application/opensearchdescription+xml', 'application/rss+xml',
        'application/xhtml+xml') AS is_text,
      CASE WHEN ends_with(uri, 'odt') THEN 'application/vnd.oasis.opendocument.text'
           WHEN ends_with(uri, 'docx') THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
           WHEN ends_with(uri, 'xslx') THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
           WHEN content_type = 'application/epub+zip' THEN content_type END AS zip_type FROM k),
x AS (SELECT *, CASE WHEN NOT http_ok THEN 'text' WHEN zip_type IS NOT NULL THEN 'zip'
      WHEN is_text THEN 'text' ELSE 'drop' END AS route FROM ty)
"""

_DECODE = "replace(replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '&nbsp;', ' ')"


def _decode_sql(text: str) -> str:
    """Character references decoded once; an ampersand may be cut off at the end."""
    return _DECODE.format(f"regexp_replace({text}, '&amp;?', '&', 'g')")


def _strip_sql(decode_bare: bool) -> str:
    steps = [
        (r"(?is)<!--.*?-->", ""),
        (r"(?is)<!doctype[^>]*>", ""),
        (r"(?is)(<script\b[^>]*>).*?(</script)", r"\1\2"),
        (r"(?is)(<style\b[^>]*>).*?(</style)", r"\1\2"),
        (r"</?[a-zA-Z][^>]*$", ""),
        (r"\n", " "),
        (r"(?i)</(p|div|li|dd|th|td|h[1-9])\b[^>]*>|<br\b[^>]*/>", "\n"),
        (r"</[^>]*>", " "),
        (r"(?i)<(ul|ol|dl|tr)\b[^>]*>", "\n"),
        (r"<[^>]*>", ""),
    ]
    out = "html"
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    if decode_bare:
        out = f"regexp_replace({out}, '&amp;?', '&', 'g')"
        out = _DECODE.format(_DECODE.format(out))
        return f"regexp_replace({out}, '&amp;?', '&', 'g')"
    return _DECODE.format(out)


def _spaces_sql(text: str) -> str:
    w = r"[\t-\r\x{85}\x{a0}\p{Z}]"
    one = f"regexp_replace({text}, '[ \\t\\r\\p{{Zs}}]+', ' ', 'g')"
    lines = f"list_transform(string_split({one}, '\n'), lambda l: regexp_replace(l, '^{w}+|{w}+$', '', 'g'))"
    return f"coalesce(list_aggregate(list_transform(list_filter({lines}, lambda l: l <> ''), lambda l: l || '\n'), 'string_agg', ''), '')"


_SEEN = "SELECT text FROM documents JOIN labels USING (doc_id)"

_ONE_BYTE = """array_to_string(list_transform(string_split(html, ''), lambda c:
  CASE WHEN unicode(c) > 255 OR unicode(c) BETWEEN 128 AND 159 THEN '&#' || unicode(c) || ';' ELSE c END), '')"""

ENTRIES = {
    "content_type_clean": (
        content_type_clean,
        _RECORDS
        + """SELECT page_id, content_type,
        CASE WHEN starts_with(trim(rest), 'charset=') THEN substr(trim(rest), 9) ELSE '' END AS charset,
        CASE WHEN starts_with(rest, 'charset=') THEN substr(rest, 9) ELSE '' END AS charset_strict FROM x""",
    ),
    "content_type_prevalence": (
        content_type_prevalence,
        _RECORDS
        + """SELECT content_type, count(*) AS records,
        count(*)::DOUBLE / (SELECT count(*) FROM x WHERE is_http) AS prevalence
        FROM x WHERE is_http AND not_robots AND http_ok GROUP BY content_type""",
    ),
    "mime_histogram": (
        mime_histogram,
        _RECORDS
        + "SELECT content_type, count(*) AS records FROM x WHERE is_http AND http_ok GROUP BY 1",
    ),
    "text_route": (
        text_route,
        _RECORDS + "SELECT page_id, uri, zip_type, is_text, route FROM x WHERE is_http AND not_robots",
    ),
    "type_kinds": (
        type_kinds,
        _RECORDS
        + """SELECT CASE WHEN is_text THEN 'text' WHEN content_type = 'application/epub+zip' THEN 'zip'
        ELSE 'other' END AS kind, content_type, count(*) AS records,
        sum(content_length)::BIGINT AS bytes FROM x GROUP BY 1, 2""",
    ),
    "run_counters": (
        run_counters,
        _RECORDS
        + """, f AS (SELECT content_length AS n, is_http AS a, is_http AND not_robots AND route <> 'drop' AS b,
        is_http AND not_robots AND route <> 'drop' AND content_length > 2000 AS c FROM x)
        SELECT count(*) FILTER (a) AS total_records, sum(n) FILTER (a)::BIGINT AS total_bytes,
        count(*) FILTER (b) AS text_records, sum(n) FILTER (b)::BIGINT AS text_bytes,
        count(*) FILTER (c) AS lang_records, sum(n) FILTER (c)::BIGINT AS lang_bytes FROM f""",
    ),
    "html_strip": (
        html_strip,
        f"SELECT page_id, {_spaces_sql(_strip_sql(False))} AS text FROM pages",
    ),
    "html_exact": (
        html_exact,
        f"SELECT page_id, {_spaces_sql(_strip_sql(True))} AS text FROM pages",
    ),
    "html_unescape": (
        html_unescape,
        f"SELECT page_id, url, {_decode_sql('html')} AS html FROM pages",
    ),
    "nfkc": (nfkc, "SELECT doc_id, nfc_normalize(text) AS text FROM documents"),
    "recode_utf8": (
        recode_utf8,
        "SELECT page_id, html, strlen(html)::INTEGER AS valid_bytes FROM pages",
    ),
    "recode_latin1": (
        recode_latin1,
        f"SELECT page_id, {_ONE_BYTE} AS html, strlen(html) AS fixed_bytes FROM pages",
    ),
    "recode_declared": (
        recode_declared,
        f"SELECT page_id, {DECLARED} || CASE WHEN page_id % 7 IN (3, 4) THEN {_ONE_BYTE} ELSE html END AS html FROM pages",
    ),
    "clean_spaces": (
        clean_spaces,
        f"SELECT doc_id, {_spaces_sql('text')} AS text FROM documents",
    ),
    "strip_ids": (
        strip_ids,
        "SELECT doc_id, doc_id::VARCHAR AS record_id, text, strlen(text) AS bytes FROM documents",
    ),
    "exact_dedup_first": (
        exact_dedup_first,
        "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text",
    ),
    "drop_seen_hashes": (
        drop_seen_hashes,
        f"SELECT doc_id, text FROM documents WHERE text NOT IN ({_SEEN})",
    ),
    "drop_seen_filtered": (
        drop_seen_filtered,
        f"""SELECT blocks, doc_id, sha256(text) AS text_hash FROM documents, (VALUES (2), ({BLOCKS})) b(blocks)
        WHERE text NOT IN ({_SEEN})""",
    ),
    "dedup_unseen": (
        dedup_unseen,
        f"""SELECT min(doc_id) AS doc_id, sha256(text) AS text_hash FROM documents
        WHERE text NOT IN ({_SEEN}) GROUP BY text""",
    ),
    "new_hashes": (
        new_hashes,
        f"SELECT DISTINCT sha256(text) AS text_hash FROM documents WHERE text NOT IN ({_SEEN})",
    ),
    "hash_keys": (hash_keys, "SELECT doc_id, sha256(text) AS text_hash FROM documents"),
    "murmur_groups": (
        murmur_groups,
        """SELECT copies, count(*) AS texts FROM
        (SELECT count(*) AS copies FROM documents GROUP BY text) GROUP BY copies""",
    ),
    "xxhash_groups": (
        xxhash_groups,
        """SELECT copies, count(*) AS texts FROM
        (SELECT count(*) AS copies FROM documents GROUP BY text) GROUP BY copies""",
    ),
    "carry_filename": (
        carry_filename,
        """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN props END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS filename FROM events""",
    ),
    "head_records": (
        head_records,
        """SELECT doc_id, source, 'http://' || source || '/' || doc_id AS uri FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10""",
    ),
    "limit_records": (
        limit_records,
        """SELECT event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 25""",
    ),
    "field_extract": (
        field_extract,
        "SELECT 'http://' || source || '/' || doc_id AS value FROM documents",
    ),
    "field_extract_b64": (
        field_extract_b64,
        "SELECT to_base64(encode(text)) AS value FROM documents",
    ),
    "text_records": (
        text_records,
        """SELECT source, '2020-01-01' AS date, doc_id::VARCHAR AS record_id,
        'http://' || source || '/' || doc_id AS uri, 'text/html' AS content_type, lang, text FROM documents""",
    ),
    "record_render": (
        record_render,
        """SELECT 'Content-Location: http://' || source || '/' || doc_id || '\nContent-Type: text/html'
        || '\nContent-Language: ' || lang || '\nContent-Length: ' || strlen(text) || '\nDate: 2020-01-01'
        || '\nX-WARC-Record-ID: <urn:uuid:' || doc_id || '>\nX-WARC-Filename: ' || source
        || '\n\n' || text || '\n' AS record FROM documents""",
    ),
    "aligned_lines": (
        aligned_lines,
        """SELECT 'text/html' AS mime, lang, 'http://' || source || '/' || doc_id AS url,
        to_base64(encode(text)) AS plain_text FROM documents""",
    ),
    "metadata_rows": (
        metadata_rows,
        _RECORDS
        + """SELECT 'a.warc.gz\t' || page_id || '\t' || uri || '\t2020-01-01\t' || content_length || '\t'
        || content_type || '\t' AS line FROM x WHERE is_http AND http_ok""",
    ),
    "html_lang_tags": (
        html_lang_tag_list,
        """SELECT page_id, lower(array_to_string(list_distinct(regexp_extract_all(html,
        '<[a-zA-Z][^<>&]*[\\s:]lang\\s*=\\s*["'']?([a-zA-Z_-]+)', 1)), ',')) AS tags,
        regexp_extract(url, '^[a-z]+://[^/]*[.]([^./:?#]+)', 1) AS tld FROM pages""",
    ),
    "language_names": (
        language_names,
        """WITH c AS (SELECT doc_id, lang, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN lang || '-Latn'
        WHEN 2 THEN lang || '-Latn-XX' ELSE 'un' END AS code FROM documents)
        SELECT doc_id, code, CASE WHEN code = 'un' THEN 'UNKNOWN_LANGUAGE' WHEN lang = 'en' THEN 'ENGLISH'
        WHEN lang = 'fr' THEN 'FRENCH' WHEN lang = 'de' THEN 'GERMAN' WHEN lang = 'es' THEN 'SPANISH' END AS name
        FROM c""",
    ),
}

CORPUS_BY_TAG = (
    _RECORDS
    + f""", c AS (SELECT page_id, {_spaces_sql(_strip_sql(True))} AS text,
    lower(regexp_extract(html, '<html lang="([a-z]+)"', 1)) AS tag FROM pages),
    w AS (SELECT c.* FROM c JOIN x USING (page_id) WHERE not_robots AND is_text
    QUALIFY row_number() OVER (PARTITION BY c.text ORDER BY page_id) = 1)
    SELECT tag, count(*) AS texts, sum(strlen(text))::BIGINT AS bytes FROM w GROUP BY tag"""
)
