"""The trainable language model: grams with up to three weighted languages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.operators.langid.dims import SCRIPTS
from crawlloom.operators.langid.grams import (
    is_kind,
    script_spans,
    span_units,
    text_grams,
    unit_grams,
    unit_size,
)
from crawlloom.session import materialize, spread

LANGS_PER_GRAM = 3
# Weight of a language whose share of a gram's occurrences is at least num/den.
WEIGHTS = [(15, 16, 12), (3, 4, 9), (1, 2, 6), (1, 4, 3)]


@dataclass
class LangModel:
    """``grams(gram, lang, weight, rank)``, ``expected(lang, score_per_kb)`` and, when
    grams within words are used, ``words(unit, lang, weight, hits, first, n)``: the summed
    scores of all words seen in training, so that these need not be cut into grams, and how
    often they were seen."""

    grams: DataFrame
    expected: DataFrame
    kinds: tuple[str, ...]
    words: DataFrame | None = None

    @cached_property
    def gram_rows(self) -> int:
        return self.grams.count()

    @cached_property
    def word_rows(self) -> dict[int, int]:
        """Rows of ``words`` by the power of two that the number of occurrences reaches."""
        power = F.floor(F.log2("n")).cast("int")
        return {r.power: r.rows for r in self.words.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("rows")).collect()}

    def frequent_words(self, max_rows: int) -> DataFrame | None:
        """The words seen most often, as many as ``max_rows`` rows allow; None if these are none."""
        rows, least = 0, None
        for power in sorted(self.word_rows, reverse=True) if self.words is not None else []:
            rows += self.word_rows[power]
            if rows > max_rows:
                break
            least = power
        return None if least is None else self.words.filter(F.col("n") >= 1 << least)

    def save(self, path: str) -> None:
        self.grams.write.mode("overwrite").parquet(f"{path}/grams")
        self.expected.write.mode("overwrite").parquet(f"{path}/expected")
        if self.words is not None:
            self.words.write.mode("overwrite").parquet(f"{path}/words")
        spark = self.grams.sparkSession
        kinds = spark.createDataFrame([(k,) for k in self.kinds], "kind string")
        kinds.write.mode("overwrite").parquet(f"{path}/kinds")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LangModel:
        kinds = tuple(r.kind for r in spark.read.parquet(f"{path}/kinds").collect())
        words = spark.read.parquet(f"{path}/words") if "quad" in kinds else None
        if words is not None and "n" not in words.columns:
            words = words.withColumn("n", F.lit(1).cast("long"))
        return LangModel(
            spark.read.parquet(f"{path}/grams"), spark.read.parquet(f"{path}/expected"), kinds, words
        )


def unit_counts(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(script_no, unit, lang, n): how often every word occurs in every language.

    Combined before the shuffle, so a frequent word is no burden to one task.
    """
    texts = spread(labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    units = span_units(script_spans(texts, ["lang"]), ["lang"])
    return (
        units.filter(~is_kind(F.col("script_no"), "one"))
        .groupBy("script_no", "unit", "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def gram_counts(
    labelled: DataFrame, lang: str = "lang", text: str = "text", kinds: Sequence[str] = ("word", "quad")
) -> DataFrame:
    """(gram, lang, n, gram_bytes) over labelled text.

    Grams within words are counted over the distinct words; only word pairs need
    every running word.
    """
    if "pair" in kinds:
        texts = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        grams = text_grams(spread(texts), ["lang"], kinds=kinds).withColumn("n", F.lit(1).cast("long"))
        grams = grams.filter(~F.col("gram").startswith("d:"))
    else:
        grams = _vocabulary_grams(unit_counts(labelled, lang, text), ["lang", "n"], kinds)
    return _sum_grams(grams)


def _vocabulary_grams(units: DataFrame, columns: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """(columns, unit, gram, unit_bytes) of distinct units."""
    return units.select(
        *columns, "unit", unit_size().alias("_size"), F.posexplode_outer(unit_grams(kinds)).alias("_at", "gram")
    ).select(
        *columns, "unit", "gram", F.when(F.col("_at") == 0, F.col("_size")).otherwise(0).alias("unit_bytes")
    )


def _sum_grams(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram", "lang").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("unit_bytes")).alias("gram_bytes")
    )


def word_scores(counts: DataFrame, weighed: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(unit, lang, weight, hits, first, n) of every word.

    Adding up the grams of a word here gives the same sums as scoring them one by
    one. ``first`` marks the row that takes the bytes of the word. The grams of a word
    do not depend on its script, so a word seen in two scripts is summed once.
    """
    of_words = counts.filter(is_kind(F.col("script_no"), "many"))
    words = of_words.groupBy("unit").agg(F.min("script_no").alias("script_no"), F.sum("n").alias("n"))
    grams = _vocabulary_grams(words, ["n"], kinds)
    scored = grams.join(weighed.select("gram", "lang", "weight", "rank"), "gram", "left")
    leads = (F.col("unit_bytes") > 0) & (F.coalesce("rank", F.lit(1)) == 1)
    return scored.groupBy("unit", "lang").agg(
        F.sum("weight").alias("weight"),
        F.count_if(F.col("rank") == 1).alias("hits"),
        F.bool_or(leads).alias("first"),
        F.max("n").alias("n"),
    )


def _weight(n: Column, total: Column) -> Column:
    out = None
    for num, den, w in WEIGHTS:
        hit = n * den >= total * num
        out = F.when(hit, w) if out is None else out.when(hit, w)
    return out.otherwise(1)


def weigh(counts: DataFrame, min_count: int = 1) -> DataFrame:
    """(gram, lang, weight, rank, n, gram_bytes): the best three languages per gram.

    A gram has one row per language before this, so its window is small.
    """
    by_gram = W.partitionBy("gram")
    ranked = counts.withColumn("_total", F.sum("n").over(by_gram)).withColumn(
        "rank", F.row_number().over(by_gram.orderBy(F.desc("n"), "lang"))
    )
    return ranked.filter((F.col("rank") <= LANGS_PER_GRAM) & (F.col("_total") >= min_count)).select(
        "gram", "lang", _weight(F.col("n"), F.col("_total")).alias("weight"), "rank", "n", "gram_bytes"
    )


def expected_scores(weighed: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, score_per_kb): what a kilobyte of a language's own text scores."""
    score = weighed.groupBy("lang").agg(F.sum(F.col("n") * F.col("weight")).alias("_score"))
    size = counts.groupBy("lang").agg(F.sum("gram_bytes").alias("_bytes"))
    return score.join(size, "lang").select(
        "lang", F.floor(F.col("_score") * 1024 / F.greatest(F.col("_bytes"), F.lit(1))).cast("long").alias("score_per_kb")
    )


def with_defaults(grams: DataFrame) -> DataFrame:
    """Adds the weight-1 hit of every script's default language."""
    rows = [(f"d:{s}", lang, 1, 0) for s, _, lang in SCRIPTS]
    dim = grams.sparkSession.createDataFrame(rows, "gram string, lang string, weight int, rank int")
    return grams.select("gram", "lang", "weight", "rank").unionByName(dim)


def train(
    labelled: DataFrame,
    lang: str = "lang",
    text: str = "text",
    kinds: Sequence[str] = ("word", "quad"),
    min_count: int = 1,
) -> LangModel:
    """Model from labelled text. What several steps read is written out once."""
    words = None
    if "pair" in kinds:
        counts = materialize(gram_counts(labelled, lang, text, kinds))
        weighed = materialize(weigh(counts, min_count))
    else:
        vocabulary = materialize(unit_counts(labelled, lang, text))
        counts = materialize(_sum_grams(_vocabulary_grams(vocabulary, ["lang", "n"], kinds)))
        weighed = materialize(weigh(counts, min_count))
        if "quad" in kinds:
            words = materialize(word_scores(vocabulary, weighed, kinds))
    return LangModel(
        with_defaults(weighed), materialize(expected_scores(weighed, counts)), tuple(kinds), words
    )
