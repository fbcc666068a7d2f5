"""Headline timings after one warm-up run each: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from crawlloom.catalog import files, language, text  # noqa: E402
from crawlloom.functions.html import clean_text  # noqa: E402
from crawlloom.functions.text import clean_spaces  # noqa: E402
from crawlloom.operators.langid import model as M  # noqa: E402
from crawlloom.operators.langid.detect import detect_language  # noqa: E402
from crawlloom.session import spread  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="crawlloom-wh-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="crawlloom-ck-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs = text.table(spark, sf_dir, "documents")
    pages = text.table(spark, sf_dir, "pages")
    sizes = {
        "pages": pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first(),
        "documents": docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first(),
    }
    model = M.train(docs.select("lang", "text"))
    # start the Python workers before the clock runs
    run(spread(pages).select(clean_text(F.col("html"))))

    timed = {
        "html_cleaning": ("pages", lambda: run(
            spread(pages).select(clean_spaces(clean_text(F.col("html"))).alias("t")))),
        "exact_dedup": ("documents", lambda: run(text.exact_dedup_first(spark, sf_dir))),
        "drop_seen": ("documents", lambda: run(text.drop_seen_hashes(spark, sf_dir))),
        "murmur_hash": ("documents", lambda: run(text.murmur_groups(spark, sf_dir))),
        "clean_spaces": ("documents", lambda: run(text.clean_spaces(spark, sf_dir))),
        "train_model": ("documents", lambda: M.train(docs.select("lang", "text"))),
        "detect_language": ("documents", lambda: run(
            detect_language(docs, model, ["doc_id"]))),
        "detect_language_words": ("documents", lambda: run(
            language.lang_detect_words(spark, sf_dir))),
        "whole_corpus": ("pages", lambda: run(files.corpus(spark, sf_dir))),
    }
    language.model(spark, sf_dir)
    files.warc_archive(spark, sf_dir)
    queries, rates = {}, {}
    for name, (source, job) in timed.items():
        # one untimed run: compiling and JIT warm-up say nothing about throughput
        job()
        start = time.time()
        job()
        took = time.time() - start
        queries[name] = round(took, 3)
        print(name, queries[name], file=sys.stderr, flush=True)
        rows, size = sizes[source]
        rates[name] = {"rows_per_sec": round(rows / took), "mb_per_sec": round(size / took / 1e6, 2)}
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "rates": rates,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
