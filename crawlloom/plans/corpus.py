"""Crawl archives to a clean, language-tagged, deduplicated corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.functions import content_type as C
from crawlloom.functions import html as H
from crawlloom.functions.hashing import hash_key
from crawlloom.functions.text import clean_spaces, strip_record_id
from crawlloom.operators.dedup import dedup_unseen, first_positions
from crawlloom.operators.langid.detect import detect_language, with_language
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.langid.refine import refine_pass
from crawlloom.operators.order import carry_forward
from crawlloom.operators.project import to_text_record
from crawlloom.operators.routing import drop_unreadable, reliable_only
from crawlloom.operators.stats import content_type_stats, run_counters
from crawlloom.plans.staging import stage
from crawlloom.session import materialize
from crawlloom.sources.aligned import write_aligned, write_aligned_by_lang
from crawlloom.sources.archive import write_record_archive
from crawlloom.sources.files import ORDINAL_ROOM
from crawlloom.sources.hashes import write_hashes
from crawlloom.sources.warc import read_warc
from crawlloom.sources.zips import zip_text

KEYS = ["filename", "ordinal"]
# Compressed bytes of a file whose records one task of the carry-forward sorts.
CARRY_BYTES = 64 << 20


def body_text(
    body: Column, content_type: Column, charset: Column, plain: Column
) -> Column:
    """Clean text of a body; bodies known to be plain are not searched for markup."""
    decoded = H.recode(body, charset)
    return F.coalesce(
        H.clean_plain(F.when(plain, decoded)), H.clean_text(F.when(~plain, decoded))
    )


def clean_records(records: DataFrame, reference: bool = False) -> DataFrame:
    """Adds header, content_type, route and text to WARC records.

    ``text`` is null for records that are not wanted or could not be read.
    ``reference=True`` treats plain text like markup, which leaves nothing of a
    text without tags, and reads the charset more strictly.
    """
    header = F.col("http_headers")["content-type"]
    wanted = C.is_http_response(F.col("rec_content_type")) & C.not_robots(F.col("uri"))
    typed = records.withColumns(
        {
            "header": header,
            "content_type": F.when(F.col("http_ok"), C.clean_content_type(header)).otherwise(
                F.coalesce("rec_content_type", F.lit(""))
            ),
        }
    ).withColumn(
        "route",
        F.when(wanted, C.route(F.col("http_ok"), F.col("content_type"), F.col("uri"))).otherwise("drop"),
    )
    unzipped = zip_text(
        F.when(F.col("route") == "zip", F.col("body")), C.zip_type(F.col("content_type"), F.col("uri"))
    )
    with_body = typed.withColumn(
        "body", F.when(F.col("route") == "zip", unzipped).when(F.col("route") == "text", F.col("body"))
    ).withColumn(
        # a body that should be a zip and is not never counts as text
        "route", F.when((F.col("route") == "zip") & F.col("body").isNull(), "drop").otherwise(F.col("route"))
    )
    plain = F.lit(False) if reference else F.col("content_type") == "text/plain"
    charset = F.when(F.col("route") == "text", C.content_charset(header, reference))
    return with_body.withColumn(
        "text", body_text(F.col("body"), F.col("content_type"), charset, plain)
    ).drop("body", "http_headers")


@dataclass
class CorpusRun:
    """Accepted text records and what is known about the run."""

    texts: DataFrame
    counters: DataFrame
    content_types: DataFrame
    hashes: DataFrame


def build_corpus(
    records: DataFrame,
    model: LangModel,
    seen: DataFrame | None = None,
    dedup: bool = True,
    hash_kind: str = "sha256",
    refine: bool = False,
    reference: bool = False,
) -> CorpusRun:
    """The whole run over WARC records.

    The text is shuffled once, into the staged table. Language verdicts, survivors
    of deduplication and sources are narrow tables joined to it by its bucket keys.
    """
    staged = stage(clean_records(records, reference), KEYS, "records")
    readable = drop_unreadable(staged)
    detect = refine_pass if refine else detect_language
    verdict = materialize(detect(readable, model, KEYS, colocated=True))

    spoken = reliable_only(with_language(readable, verdict, KEYS))
    tidy = spoken.withColumn("text", clean_spaces(F.col("text"), reference))
    hashed = tidy.withColumn("text_hash", hash_key(F.col("text"), hash_kind))
    narrow = hashed.select(*KEYS, "text_hash")
    if seen is not None:
        accepted = dedup_unseen(narrow, "text_hash", KEYS, seen)
    elif dedup:
        accepted = first_positions(narrow, "text_hash", KEYS)
    else:
        accepted = narrow
    accepted = materialize(accepted.select(*KEYS, "text_hash"))

    sources = carry_forward(
        staged.select(*KEYS, "warc_type", "warc_filename"),
        "filename",
        "ordinal",
        F.col("warc_type") == "warcinfo",
        F.coalesce("warc_filename", F.lit("")),
        "source",
        CARRY_BYTES * ORDINAL_ROOM,
    ).select(*KEYS, "source")
    texts = to_text_record(
        tidy.join(accepted, KEYS, "left_semi").join(sources, KEYS, "left"),
        record_id=strip_record_id(F.col("record_id")),
    )

    http = C.is_http_response(F.col("rec_content_type"))
    flags = staged.select(
        *KEYS, "content_length", http.alias("is_total"), (F.col("route") != "drop").alias("is_text")
    ).join(accepted.select(*KEYS, F.lit(True).alias("is_lang")), KEYS, "left")
    counters = run_counters(
        flags,
        F.col("is_total"),
        F.col("is_text"),
        F.coalesce("is_lang", F.lit(False)),
        F.col("content_length"),
    )
    types = content_type_stats(
        staged,
        F.col("rec_content_type"),
        C.not_robots(F.col("uri")),
        F.col("http_ok"),
        F.col("header"),
    )
    return CorpusRun(texts, counters, types, accepted.select("text_hash").distinct())


def write_texts(texts: DataFrame, out: str, form: str) -> None:
    """Forms: aligned, aligned_by_lang, archive, archive_by_lang, archive_by_lang_xz."""
    if form == "aligned":
        write_aligned(texts, out)
    elif form == "aligned_by_lang":
        write_aligned_by_lang(texts, out)
    elif form == "archive":
        write_record_archive(texts, out)
    elif form == "archive_by_lang":
        write_record_archive(texts, out, by_lang=True)
    elif form == "archive_by_lang_xz":
        write_record_archive(texts, out, codec="xz", by_lang=True)
    else:
        raise ValueError(f"unknown output form {form!r}")


def preprocess(
    spark: SparkSession,
    warc: str,
    out: str,
    model: LangModel,
    form: str = "aligned_by_lang",
    seen: DataFrame | None = None,
    hashes_out: str | None = None,
    refine: bool = False,
    reference: bool = False,
) -> CorpusRun:
    """Read archives, write the corpus and, when asked, the accepted 32-bit hashes.

    Deduplication takes place when hashes are given or wanted, by the 32-bit hash
    that can be exchanged with other runs.
    """
    run = build_corpus(
        read_warc(spark, warc, bodies="text"),
        model,
        seen,
        dedup=hashes_out is not None,
        hash_kind="murmur32" if seen is not None or hashes_out else "sha256",
        refine=refine,
        reference=reference,
    )
    write_texts(run.texts, out, form)
    if hashes_out:
        write_hashes(run.hashes, hashes_out)
    return run
