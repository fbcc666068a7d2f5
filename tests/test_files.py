import base64
import glob
import gzip
import io
import lzma
import os
import random
import time
import tracemalloc
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from crawlloom.functions.hashing import murmur3_32
from crawlloom.operators.langid.model import train
from crawlloom.plans.archives import archive_extract, archive_head, archive_to_aligned
from crawlloom.plans.corpus import build_corpus, preprocess
from crawlloom.plans.reports import crawl_metadata, mime_histogram, write_crawl_metadata, write_mime_histogram
from crawlloom.schema import TEXT_COLUMNS
from crawlloom.sources import warc as W
from crawlloom.sources.aligned import read_aligned, write_aligned, write_aligned_by_lang
from crawlloom.sources.archive import read_record_archive, write_record_archive
from crawlloom.sources.files import committed_files
from crawlloom.sources.hashes import read_hashes, write_hashes

from crawlloom.sources.warc import parse_http, read_warc, stream_warc
from crawlloom.sources.zips import zip_text
from crawlloom.streaming.ingest import incremental_ingest
from crawlloom.streaming.state import stateful_ingest

HTTP = "application/http; msgtype=response"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").collect()
    return [r.html for r in rows]


def record(kind, uri, payload, content_type=HTTP, extra=""):
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uri[-8:]}>\r\nWARC-Target-URI: {uri}\r\n"
        f"WARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: {content_type}\r\n{extra}Content-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


def info(name):
    return record("warcinfo", "", b"", "application/warc-fields", f"WARC-Filename: {name}\r\n")


def http(body, content_type="text/html"):
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\n\r\n".encode() + body


def docx(text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", text)
        z.writestr("word/other.xml", "no")
    return out.getvalue()


@pytest.fixture(scope="module")
def crawl(tmp_path_factory, pages):
    """Two archives with everything the pipeline has to tell apart."""
    path = tmp_path_factory.mktemp("crawl")
    body = [p.encode() for p in pages]
    a = [
        info("A.warc.gz"),
        record("response", "http://x/00000000", http(body[0], "TEXT/html; charset=utf-8")),
        record("response", "http://x/00000001", http(body[1], "application/xhtml+xml;charset=utf-8")),
        record("request", "http://x/00000002", b"GET / HTTP/1.1\r\n\r\n", "application/http; msgtype=request"),
        record("response", "http://x/robots.txt", http(b"User-agent: *", "text/plain")),
        record("response", "http://x/00000003", b"HTTQ broken\r\n\r\n" + body[2]),
        record("response", "http://x/00000004", http(b"\x89PNG", "image/png")),
        record("response", "http://x/000.docx", http(docx(pages[3]), "application/zip")),
        record("response", "http://x/bad.docx", http(b"no zip", "application/zip")),
        record("response", "http://x/00000005", http(b"banana", "text/plan")),
        record("response", "http://x/00000006", http(body[1])),
    ]
    b = [
        info("B1.warc.gz"),
        record("response", "http://x/00000007", http(body[0])),
        info("B2.warc.gz"),
        record("response", "http://x/00000008", http(body[4])),
    ]
    members = [gzip.compress(r) for r in a]
    # a damaged member between two good ones is skipped
    members.insert(2, members[1][:200])
    (path / "a.warc.gz").write_bytes(b"".join(members))
    # several records in one member
    (path / "b.warc.gz").write_bytes(gzip.compress(b"".join(b)))
    return str(path)


def test_http_parsing():
    assert parse_http(b"HTTP/1.1 404 Not Found\r\nA: b\r\nA: c\r\n\r\nx") == (404, {"a": "b"}, b"x")
    assert parse_http(b"HTTP/1.0 200\nContent-Length: 2\n\nxyz") == (200, {"content-length": "2"}, b"xy")
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x\r\nde\r\n0\r\n\r\n"
    assert parse_http(chunked)[2] == b"abcde"
    for bad in (b"", b"HTTQ/1.1 200 OK\r\n\r\n", b"HTTP/1.1 OK\r\n\r\n", b"HTTP/1.1 200 OK\r\nnocolon\r\n\r\n"):
        assert parse_http(bad) is None


def test_warc_reading_in_any_split(spark, crawl):
    whole = read_warc(spark, crawl)
    assert whole.count() == 15
    for split in (50, 1000, 10**9):
        part = read_warc(spark, crawl, split_bytes=split)
        assert part.count() == 15
        assert part.drop("http_headers").exceptAll(whole.drop("http_headers")).count() == 0
    b = whole.filter("filename like '%b.warc.gz'").orderBy("ordinal").collect()
    assert [r.warc_type for r in b] == ["warcinfo", "response", "warcinfo", "response"]
    assert read_warc(spark, crawl, with_body=False).filter("body is not null").count() == 0
    with pytest.raises(PySparkException):
        read_warc(spark, crawl + "/none").count()


def test_plain_warc(spark, folder):
    with open(f"{folder}/c.warc", "wb") as f:
        f.write(info("C") + record("response", "http://x/00000009", http(b"hi")))
    rows = read_warc(spark, folder, split_bytes=10).orderBy("ordinal").collect()
    assert [r.warc_type for r in rows] == ["warcinfo", "response"] and bytes(rows[1].body) == b"hi"


def test_corpus(spark, crawl, model, pages):
    run = build_corpus(read_warc(spark, crawl, split_bytes=2000), model)
    texts = {r.uri: r for r in run.texts.collect()}
    # first copies only, in file order; the plain word is too short to be reliable
    assert set(texts) == {
        "http://x/00000000", "http://x/00000001", "http://x/00000003", "http://x/000.docx", "http://x/00000008",
    }
    assert texts["http://x/00000000"].source == "A.warc.gz"
    assert texts["http://x/00000008"].source == "B2.warc.gz"
    assert texts["http://x/00000003"].content_type == HTTP
    assert texts["http://x/000.docx"].content_type == "application/zip"
    assert texts["http://x/00000001"].record_id == "00000001"
    c = run.counters.first()
    # broken, zip, banana and both copies are text; robots, image and the bad zip are not
    assert (c.total_records, c.text_records, c.lang_records) == (11, 8, 5)
    types = {r.content_type: r.records for r in run.content_types.collect()}
    assert types == {"text/html": 4, "application/xhtml+xml": 1, "image/png": 1, "application/zip": 2, "text/plain": 1}
    share = run.content_types.filter("content_type = 'text/html'").first().prevalence
    assert share == pytest.approx(4 / 11)
    assert run.hashes.count() == 5


def test_text_is_not_shuffled_after_staging(spark, crawl, model):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = build_corpus(read_warc(spark, crawl), model)
        plan = run.texts._jdf.queryExecution().sparkPlan().toString()
        plan = run.texts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and ",text#" in x]
    assert scans
    for at in scans:
        level = depth(lines[at])
        for x in reversed(lines[:at]):
            if depth(x) < level:
                level = depth(x)
                assert "Exchange" not in x


def test_runs_chained_by_hashes(spark, crawl, model, folder):
    run = preprocess(spark, crawl, f"{folder}/one", model, hashes_out=f"{folder}/hashes", refine=True)
    assert run.counters.first().lang_records == 5
    seen = read_hashes(spark, f"{folder}/hashes")
    expected = run.texts.select(murmur3_32(F.col("text")).alias("text_hash"))
    assert seen.exceptAll(expected).count() == 0 and seen.count() == 5
    again = preprocess(spark, crawl, f"{folder}/two", model, form="archive", seen=seen)
    assert again.counters.first().lang_records == 0


def test_metadata_and_mime(spark, crawl, model, folder):
    rows = {r.uri: r for r in crawl_metadata(read_warc(spark, crawl), model).collect()}
    # parsed responses only; robots stay, zips and images have no language
    assert len(rows) == 10 and "http://x/00000003" not in rows
    assert rows["http://x/00000004"].lang == "" and rows["http://x/000.docx"].lang == ""
    assert rows["http://x/00000000"].lang in ("en", "fr", "de", "es")
    assert rows["http://x/00000000"].record_id == "<urn:uuid:00000000>"
    write_crawl_metadata(spark, crawl, f"{folder}/meta", model)
    lines = [r.value.split("\t") for r in spark.read.text(f"{folder}/meta").collect()]
    assert len(lines) == 10 and {len(x) for x in lines} == {7}
    counts = {r.content_type: r.records for r in mime_histogram(read_warc(spark, crawl, False)).collect()}
    assert counts["text/plain"] == 2  # robots included
    write_mime_histogram(spark, crawl, f"{folder}/mime")
    assert "2\ttext/plain" in [r.value for r in spark.read.text(f"{folder}/mime").collect()]


def texts(spark, n=40):
    rows = [
        (f"s{i % 3}", "2020", f"id{i}", f"http://x/{i}", "text/html", ["en", "fr"][i % 2], f"line é {i}\nmore\n" * (i % 5))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TEXT_COLUMNS))


@pytest.mark.parametrize("codec", ["gz", "xz"])
def test_archive_roundtrip(spark, folder, codec):
    df = texts(spark)
    write_record_archive(df, f"{folder}/a", codec)
    write_record_archive(df.limit(3), f"{folder}/a", codec)  # appended
    back = read_record_archive(spark, f"{folder}/a").drop("file", "ordinal")
    assert back.count() == 43 and back.distinct().exceptAll(df).count() == 0
    write_record_archive(df, f"{folder}/l", codec, by_lang=True)
    assert visible(f"{folder}/l") == ["lang=en", "lang=fr"]
    only = read_record_archive(spark, f"{folder}/l/lang=fr")
    assert only.count() == 20 and only.filter("lang <> 'fr'").count() == 0


def test_foreign_archive(spark, folder):
    def member(uri, text, length=None):
        body = text.encode()
        return (
            f"Content-Location: {uri}\nContent-Type: text/html\nContent-Language: en\n"
            f"Content-Length: {len(body) if length is None else length}\nDate: d\n"
            f"X-WARC-Record-ID: <urn:uuid:r>\nX-WARC-Filename: f\n\n{text}\n"
        ).encode()

    items = [member("u1", "a�b"), member("u2", ""), member("u3", "abcdef", 3)]
    with open(f"{folder}/x.gz", "wb") as f:
        f.write(b"".join(gzip.compress(m) for m in items))
    with open(f"{folder}/x.xz", "wb") as f:
        f.write(b"".join(lzma.compress(m) for m in items))
    rows = read_record_archive(spark, folder).orderBy("file", "ordinal").collect()
    assert [r.text for r in rows] == ["ab", "", "abc"] * 2
    assert {r.record_id for r in rows} == {"r"}
    assert [r[0] for r in archive_extract(spark, f"{folder}/x.gz", "uri", n=2).collect()] == ["u1", "u2"]
    assert sorted(r[0] for r in archive_extract(spark, folder, "text", base64=True).collect())[-1] == base64.b64encode(b"abc").decode()
    archive_head(spark, folder, f"{folder}/head", 1)
    assert read_record_archive(spark, f"{folder}/head").count() == 2
    archive_to_aligned(spark, f"{folder}/x.gz", f"{folder}/per")
    assert visible(f"{folder}/per") == ["file=x.gz"]


def lines_of(path, opener):
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in opener(f, "rt").read().splitlines()]


def test_aligned_files(spark, folder):
    df = texts(spark).repartition(3)
    write_aligned(df, f"{folder}/x")
    columns = {c: lines_of(f"{folder}/x/{c}", lzma.open) for c in ("mime", "lang", "url", "plain_text")}
    got = set(zip(columns["lang"], columns["url"], (base64.b64decode(t).decode() for t in columns["plain_text"])))
    assert got == {(r.lang, r.uri, r.text) for r in df.collect()} and columns["mime"] == ["text/html"] * 40
    write_aligned_by_lang(df, f"{folder}/l")
    urls = lines_of(f"{folder}/l/lang=en/url", gzip.open)
    assert sorted(urls) == sorted(r.uri for r in df.filter("lang = 'en'").collect())
    assert not os.path.exists(f"{folder}/l/lang=en/lang") and not glob.glob(f"{folder}/*/_temp*")
    with pytest.raises(PySparkException):
        write_aligned_by_lang(df.withColumn("lang", F.lit("")), f"{folder}/e")
    assert not os.path.exists(f"{folder}/e") or committed_files(f"{folder}/e") == []
    # read back in step, whatever the form
    for path, lang in ((f"{folder}/x", True), (f"{folder}/l", True)):
        rows = read_aligned(spark, path)
        want = {(r.uri, r.content_type, r.lang, r.text) for r in df.collect()}
        assert {(r.uri, r.content_type, r.lang, r.text) for r in rows.collect()} == want and rows.count() == 40
        assert rows.groupBy("folder", "part").agg((F.max("line") + 1 == F.count("*")).alias("ok")).filter("not ok").count() == 0
    # files that are not in step are an error, not a shift
    part = sorted(glob.glob(f"{folder}/x/url/part-*"))[0]
    with lzma.open(part) as f:
        less = f.read().split(b"\n", 1)[1]
    with lzma.open(part, "wb") as f:
        f.write(less)
    with pytest.raises(PySparkException):
        read_aligned(spark, f"{folder}/x").collect()


def visible(path):
    return sorted(n for n in os.listdir(path) if n[0] not in "_.")


@pytest.mark.parametrize("write", [write_record_archive, lambda df, path: write_aligned(df, path, codec="gz")])
def test_output_counts_once_it_is_committed(spark, folder, write):
    """Failing and repeated tasks, a failed job, a job that was killed, a second job."""
    df = texts(spark).repartition(3).cache()
    df.count()
    read = read_record_archive if write is write_record_archive else read_aligned

    def rows(n=1):
        found = [(r.uri, r.text) for r in read(spark, f"{folder}/o").collect()]
        assert sorted(found) == sorted([(r.uri, r.text) for r in df.collect()] * n)

    # one task fails at the end of its rows: what it has written does not count
    bad = df.withColumn("uri", F.when((F.col("uri") == df.agg(F.max("uri")).first()[0]), F.raise_error(F.lit("lost"))).otherwise(F.col("uri")))
    with pytest.raises(PySparkException):
        write(bad, f"{folder}/o")
    assert not os.path.exists(f"{folder}/o") or committed_files(f"{folder}/o") == []
    write(df, f"{folder}/o")
    rows()
    assert len(os.listdir(f"{folder}/o/_manifests")) == len([f for f in os.listdir(f"{folder}/o/_manifests") if not f.startswith(".")])
    # an attempt that was killed leaves files under names of its own, complete or cut off
    for f in committed_files(f"{folder}/o"):
        twin = f.replace("-", "-", 1)
        stem, codec = twin.rsplit(".", 1)
        with open(f"{stem}9.{codec}", "wb") as out, open(f, "rb") as src:
            out.write(src.read()[:-7])
    rows()
    # a job that dies before its list is renamed
    with open(f"{folder}/o/_manifests/_new-dead", "w") as f:
        f.writelines(f"{os.path.relpath(x, f'{folder}/o')}\n" for x in glob.glob(f"{folder}/o/**/part-*9.*", recursive=True))
    rows()
    write(df, f"{folder}/o")
    rows(2)


def test_several_paths_and_patterns(spark, crawl):
    whole = read_warc(spark, crawl).select("filename", "ordinal").collect()
    for path in (f"{crawl}/a.warc.gz\n{crawl}/b.warc.gz", f"{crawl}/*.warc.gz", f"{crawl}/?.warc.gz", f"{crawl}/a*\n{crawl}/b.*"):
        assert sorted(read_warc(spark, path).select("filename", "ordinal").collect()) == sorted(whole)
    with pytest.raises(PySparkException):
        read_warc(spark, f"{crawl}/c*").count()


def test_hash_lists(spark, folder):
    body = "12\nabc\n4294967297\n-1\n\n 7 \n12\n99"
    with open(f"{folder}/h.txt", "w") as f:
        f.write(body)
    with lzma.open(f"{folder}/h.xz", "wt") as f:
        f.write(body)
    want = {12, 1, 4294967295, 7, 99}
    assert {r[0] for r in read_hashes(spark, f"{folder}/h.txt").collect()} == want
    assert {r[0] for r in read_hashes(spark, f"{folder}/h.xz", xz=True).collect()} == want
    write_hashes(read_hashes(spark, f"{folder}/h.txt"), f"{folder}/out")
    assert {r[0] for r in read_hashes(spark, f"{folder}/out").collect()} == want


def test_zip_rules(spark):
    def zipped(*members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in members:
                z.writestr(name, data)
        return out.getvalue()

    office = "application/vnd.openxmlformats-officedocument."
    rows = [
        ("application/vnd.oasis.opendocument.text", zipped(("content.xml", "a"), ("x/content.xml", "b"))),
        (office + "presentationml.presentation", zipped(("ppt/slides/slide1.xml", "1"), ("ppt/slides/slide2.xml", "2"))),
        (office + "spreadsheetml.sheet", zipped(("xl/sharedStrings.xml", "s"))),
        ("application/epub+zip", zipped(("a.html", "h"), ("b.css", "c"), ("c.xml", "x"))),
        ("application/epub+zip", b"no zip"),
        ("text/html", zipped(("a", "b"))),
    ]
    df = spark.createDataFrame([(i, t, bytearray(b)) for i, (t, b) in enumerate(rows)], "i int, t string, b binary")
    got = df.select("i", zip_text(F.col("b"), F.col("t")).cast("string").alias("o")).orderBy("i").collect()
    assert [r.o for r in got] == ["a", "12", "s", "hx", None, None]


def test_incremental_ingest(spark, folder):
    schema = "i long, text string"
    prepare = lambda b: b.withColumn("text_hash", F.sha2("text", 256))

    def ingest():
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = incremental_ingest(
            stream, f"{folder}/out", f"{folder}/hashes", f"{folder}/checkpoint", ["i"], prepare=prepare
        )
        query.awaitTermination()
        return sorted(r.i for r in spark.read.parquet(f"{folder}/out").collect())

    spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], schema).write.parquet(f"{folder}/in")
    assert ingest() == [1, 2]
    spark.createDataFrame([(4, "b"), (5, "c"), (6, "c")], schema).write.mode("append").parquet(f"{folder}/in")
    assert ingest() == [1, 2, 5]
    assert ingest() == [1, 2, 5]


def test_both_forms_of_ingest_agree_over_restarts(spark, folder):
    """Batches of a few files, the queries stopped and started again in between, one batch repeated."""
    rng = random.Random(5)
    schema, prepare = "i long, text string", lambda b: b.withColumn("text_hash", F.sha2("text", 256))
    texts, first = [f"t{k}" for k in range(40)] + [None], {}

    def put(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/n={n}")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")

    def run(blocks):
        table = incremental_ingest(stream(), f"{folder}/a", f"{folder}/keys", f"{folder}/ca", ["i"], prepare=prepare, bloom_blocks=blocks)
        table.awaitTermination()
        state = stateful_ingest(stream(), f"{folder}/b", f"{folder}/cb", ["i"], prepare=prepare)
        state.awaitTermination()
        both = [sorted((r.i, r.text) for r in spark.read.parquet(p).filter("text is not null").collect()) for p in (f"{folder}/a", f"{folder}/b")]
        assert both[0] == both[1]
        return both[0]

    for n, blocks in enumerate((8, 8, 64)):  # a filter of another size is made anew from the keys
        rows = [(100 * n + k, rng.choice(texts)) for k in range(60)] + [(100 * n + 60 + k, "t1") for k in range(30)]
        put(n, rows)
        for i, t in rows:
            if t is not None:
                first.setdefault(t, i)
        assert run(blocks) == sorted((i, t) for t, i in first.items())
    assert run(64) == sorted((i, t) for t, i in first.items())
    # the last batch once more, as after a failure between its output and its checkpoint
    last = max(int(f) for f in os.listdir(f"{folder}/ca/commits") if f.isdigit())
    os.remove(f"{folder}/ca/commits/{last}")
    crc = f"{folder}/ca/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert run(64) == sorted((i, t) for t, i in first.items())


def test_warc_stream(spark, crawl, folder):
    query = (
        stream_warc(spark, crawl).select("filename", "ordinal").writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/c").option("path", f"{folder}/o")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = read_warc(spark, crawl).select("filename", "ordinal")
    assert spark.read.parquet(f"{folder}/o").exceptAll(batch).count() == 0
    assert spark.read.parquet(f"{folder}/o").count() == 15


def test_stream_takes_late_files_once(spark, folder):
    def put(name, n):
        with open(f"{folder}/in/{name}", "wb") as f:
            f.write(b"".join(gzip.compress(record("response", f"http://{name}/{i:08d}", http(b"x"))) for i in range(n)))
        # an old date, as of a file that was moved here
        os.utime(f"{folder}/in/{name}", (1_000_000_000, 1_000_000_000))

    def run():
        query = (
            stream_warc(spark, f"{folder}/in", split_bytes=300).select("uri").writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/c").option("path", f"{folder}/o")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(r.uri for r in spark.read.parquet(f"{folder}/o").collect())

    os.makedirs(f"{folder}/in")
    put("m.warc.gz", 5)
    first = run()
    assert len(first) == 5
    put("a.warc.gz", 3)
    put("z.warc.gz", 2)
    both = run()
    assert len(both) == len(set(both)) == 10 and run() == both


DAMAGED = [
    (record("response", "http://x/10000000", http(b"one")), True),
    (record("response", "http://x/10000001", http(b"two")).replace(b"Content-Length: ", b"Content-Length: x"), False),
    (b"\r\n\r\n" + record("response", "http://x/10000002", http(b"three")), True),
    (record("response", "http://x/10000003", http(b"four")).replace(b"Content-Length: ", b"Content-Length: 9"), False),
    (record("response", "http://x/10000004", http(b"five")), True),
    (record("response", "http://x/10000005", http(b"six six six")).replace(b"Content-Length: 5", b"Content-Length: 2"), False),
    (b"WARC/1.0\r\nWARC-Type: resp", False),
    (record("response", "http://x/10000006", http(b"seven")), True),
]


@pytest.mark.parametrize("form", ["plain", "one member", "members", "xz"])
def test_malformed_records_are_skipped_alone(spark, folder, form):
    parts = [r if r.endswith(b"\n") else r + b"\r\n" for r, _ in DAMAGED]
    if form == "plain":
        name, data = "d.warc", b"".join(parts)
    elif form == "one member":
        name, data = "d.warc.gz", gzip.compress(b"".join(parts))
    elif form == "members":
        name, data = "d.warc.gz", b"".join(gzip.compress(p) for p in parts)
    else:
        name, data = "d.warc.xz", b"".join(lzma.compress(p) for p in parts)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)
    for split in (10**9, 120):
        got = sorted(r.uri for r in read_warc(spark, folder, split_bytes=split).collect())
        assert got == [f"http://x/1000000{i}" for i in (0, 2, 4, 6)]


@pytest.mark.parametrize("length", [b"99999999", b"9999999", b"300", b"5000000"])
@pytest.mark.parametrize("form", ["plain", "one member", "xz"])
def test_wrong_lengths_cost_one_record_each(folder, form, length):
    """Every fifth record announces another length, too short or far beyond the next records."""
    rng, parts, want = random.Random(2), [], []
    for i in range(60):
        body = rng.randbytes(rng.choice([0, 50, 3000])) + b"\r\nWARC/1.0 is a format\nWARC/x\r\n" * (i % 2)
        one = record("response", f"http://x/{i:08d}", http(body))
        if i % 5 == 2:
            size = one.split(b"Content-Length: ")[1].split(b"\r")[0]
            one = one.replace(b"Content-Length: " + size, b"Content-Length: " + length, 1)
        else:
            want.append((f"http://x/{i:08d}", body))
        parts.append(one)
    big = record("response", "http://x/big", http(b"\nWARC/1.0\r\nContent-Length: 1\r\n\r\n" + rng.randbytes(6 << 20)))
    data = b"".join(parts[:30]) + big + b"".join(parts[30:])
    name = {"plain": "a.warc", "one member": "a.warc.gz", "xz": "a.warc.xz"}[form]
    with open(f"{folder}/{name}", "wb") as f:
        f.write({"plain": bytes, "one member": lambda d: gzip.compress(d, 1), "xz": lambda d: lzma.compress(d, preset=0)}[form](data))
    reader = W.WarcReader({"path": f"{folder}/{name}"})
    rows = [r for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist()]
    assert [(r["uri"], r["body"]) for r in rows if r["uri"] != "http://x/big"] == want
    # the large record holds something like a record, and its own length is right
    assert [len(r["body"]) for r in rows if r["uri"] == "http://x/big"] == [(6 << 20) + 32]
    assert [r["ordinal"] for r in rows] == list(range(len(rows)))


def test_a_wrong_length_costs_no_memory_and_little_time(folder):
    rng = random.Random(3)
    bodies = [b"\n".join(rng.randbytes(3000).hex().encode()[k : k + 60] for k in range(0, 6000, 60)) for _ in range(20)]
    good = b"".join(record("response", f"http://x/{i:08d}", http(bodies[i % 20])) for i in range(5000))
    bad = good.replace(b"Content-Length: 6", b"Content-Length: 99996", 1)
    assert len(good) > 30 << 20
    for name, pack in (("a.warc", bytes), ("a.warc.gz", lambda d: gzip.compress(d, 1))):
        seconds, peak = [], []
        for data in (good, bad):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(pack(data))
            reader = W.WarcReader({"path": f"{folder}/{name}", "bodies": "none"})
            started, rows = time.process_time(), sum(b.num_rows for s in reader.partitions() for b in reader.read(s))
            seconds.append(time.process_time() - started)
            tracemalloc.start()
            for s in reader.partitions():
                for b in reader.read(s):
                    pass
            peak.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            assert rows == 5000 - (data is bad)
        assert seconds[1] < 2 * seconds[0] + 0.5, (name, seconds)
        assert peak[1] < peak[0] + (12 << 20), (name, peak)


def test_filters_reach_the_reader(spark, folder, model):
    kinds = ["text/html; charset=utf-8", "image/png", "video/mp4", "TEXT/PLAN", "application/zip"]
    rows = [info("A")]
    for i in range(100):
        uri = f"http://x/{i:03d}" + (".docx" if i % 10 == 4 else ".html")
        rows.append(record("response" if i % 7 else "request", uri, http(b"x" * 10_000, kinds[i % 5]), HTTP if i % 7 else "application/http; msgtype=request"))
    with open(f"{folder}/a.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(r) for r in rows[:50]) + gzip.compress(b"".join(rows[50:])))
    every = {(r.ordinal, r.uri): r for r in read_warc(spark, folder).collect()}
    assert len(every) == 101
    conditions = [
        F.col("warc_type") == "response", F.col("uri").endswith("html"), ~F.col("uri").contains("01"), F.col("uri").startswith("http://x/05"),
        F.col("uri").isin("http://x/001.html", "http://x/004.docx", "none"), ~F.col("uri").isin("http://x/001.html"), F.col("warc_filename").isNull(),
        F.col("warc_filename").isNotNull(), F.col("warc_filename").eqNullSafe("A"), F.col("warc_type") != "response",
        F.col("rec_content_type").contains("application/http") & F.col("rec_content_type").contains("response"),
    ]
    local = spark.createDataFrame(list(every.values()), read_warc(spark, folder).schema)
    for condition in conditions:
        found = read_warc(spark, folder).filter(condition)
        assert {(r.ordinal, r.uri): r for r in found.collect()} == {(r.ordinal, r.uri): r for r in local.filter(condition).collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan warc" in plan and "Filter " not in plan, plan  # nothing is left for Spark to test

    def built(bodies, *filters):
        reader = W.WarcReader({"path": folder, "bodies": bodies})
        assert not list(reader.pushFilters(list(filters)))
        return sum(len(r["body"] or b"") for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist())

    responses = sum(len(r.body or b"") for r in every.values())
    assert built("all") == responses and built("none") == 0
    assert built("all", EqualTo(("uri",), "http://x/001.html")) == 10_000
    texts = sum(len(r.body or b"") for (_, uri), r in every.items() if r.body and (r.http_headers["content-type"][:4].lower() == "text" or uri.endswith("docx")))
    assert built("text") == texts < responses
    # the corpus reads text bodies only, and has the same texts and counts
    whole, part = (build_corpus(read_warc(spark, folder, bodies=b), model) for b in ("all", "text"))
    assert whole.counters.collect() == part.counters.collect() and sorted(whole.content_types.collect()) == sorted(part.content_types.collect())


def test_broken_bodies_are_no_text():
    short = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nabc"
    assert parse_http(short) == (200, {"content-length": "9"}, None)
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    for bad in (b"3\r\nab", b"3\r\nabc\r\n", b"x\r\nabc\r\n0\r\n\r\n", b"2\r\nabc\r\n0\r\n\r\n", b""):
        assert parse_http(chunked + bad)[2] is None
    assert parse_http(chunked + b"0\r\n\r\n")[2] == b""


def test_archive_is_read_once(folder, monkeypatch):
    rng = random.Random(1)
    one = [gzip.compress(record("response", f"http://x/{i:08d}", http(rng.randbytes(1500)))) for i in range(2000)]
    path = f"{folder}/big.warc.gz"
    with open(path, "wb") as f:
        f.write(b"".join(one))
    read = [0]

    class Counted:
        def __init__(self, file):
            self.file = file

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            out = self.file.read(n)
            read[0] += len(out)
            return out

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

    monkeypatch.setattr(W, "open_split", lambda source, split: Counted(open(split.path, "rb")))
    reader = W.WarcReader({"path": path})
    assert sum(b.num_rows for s in reader.partitions() for b in reader.read(s)) == 2000
    assert read[0] <= 1.2 * os.path.getsize(path)


def test_archive_members_of_any_header_order(spark, folder):
    member = b"\r\nContent-Type: text/html\r\nContent-Location: http://a\r\nContent-Length: 2\r\n\r\nhi"
    with open(f"{folder}/a.gz", "wb") as f:
        f.write(gzip.compress(member) + gzip.compress(member.lstrip()))
    assert [r.text for r in read_record_archive(spark, folder).collect()] == ["hi", "hi"]
