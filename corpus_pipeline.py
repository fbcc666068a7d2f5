"""Documents to a mixed training corpus: a stage a table, each read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.llm import decontam, linededup, mixing, neardup, toxicity
from crawlloom.llm.shared import Scratch, held, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; the model is learned as op5 learns it.

    Null and empty texts score low and stay. Rows repeated under one id, or without id, are
    judged one by one. Without labels of both kinds all stay, or none where all labels are toxic.
    An empty table gives an empty table.
    """
    labels = table(spark, sf_dir, "labels").filter(held(F.col("doc_id"), 5) != 0)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them hold.

    Every document stays, if only as an empty text; a null text becomes empty. Repeated rows count
    as documents of their own. An empty table gives an empty table.
    """
    return linededup.drop_common_lines(docs).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id.

    Null and empty texts are copies of nothing and stay, rows without id as well. Identical rows under
    the id that stays, stay with it. An empty table gives an empty table.
    """
    return neardup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none and stay. Repeated rows are judged one by one. An empty table gives
    an empty table, an empty benchmark leaves all.
    """
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a plan: how often each document is taken, instead of its text as often.

    Documents that are taken are rows with ``copies`` of 1 or more; those with 0 stay in the plan, so
    that targets can be checked. Null and empty texts have size 0. A null source is a source of its
    own. Repeated rows are decided one by one. An empty table gives an empty table.
    """
    plan = mixing.mix_plan(docs)
    return plan.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Learned scores, minimum hashes and random draws have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.put(name.replace(" ", "_"), stage(spark, docs, sf_dir))
    return docs
