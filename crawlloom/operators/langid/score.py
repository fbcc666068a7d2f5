"""Scoring: gram lookup, chunk totals, chunk verdicts, document totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.operators.langid.dims import SCRIPTS, UNKNOWN, array_of, close_set_of, map_of
from crawlloom.operators.langid.grams import (
    default_gram,
    is_kind,
    no_grams,
    script_spans,
    span_units,
    text_grams,
    unit_grams,
    unit_size,
)
from crawlloom.operators.langid.model import LangModel
from crawlloom.session import BROADCAST_ROWS, broadcast_if_small

MIN_GRAMS, MAX_GRAMS = 3, 16
# Grams looked up apart from the shuffle, the share of all rows that makes one of them, and what
# the sketch that finds them keeps.
HOT_GRAMS, HOT_SHARE, TRACKED = 1000, 1e-4, 50_000


def score_grams(
    grams: DataFrame, model: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None
) -> DataFrame:
    """Every gram with its languages and weights; unknown grams keep one row.

    The model is broadcast when it is small enough. Otherwise the grams that are most
    frequent in ``grams`` are looked up in a broadcast of their own few rows, together
    with the rows that have no gram; only what is left is shuffled by gram.
    """
    small = broadcast_if_small(model, max_rows, rows)
    if small is not None:
        return grams.join(small, "gram", "left")
    easy, rest, is_hot = split_by_frequency(grams)
    looked = easy.join(F.broadcast(model.filter(is_hot)), "gram", "left")
    return looked.unionByName(rest.join(model.filter(~is_hot), "gram", "left"))


def frequent_grams(grams: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """The grams that hold at least ``share`` of all rows, by a sketch of heavy hitters.

    The sketch keeps ``TRACKED`` grams a task and is merged like any aggregate; at most
    ``HOT_GRAMS`` come back.
    """
    top = F.expr(f"approx_top_k(gram, {HOT_GRAMS}, {TRACKED})")
    row = grams.filter(F.col("gram").isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(r["item"] for r in row["top"] or [] if r["count"] >= share * row["n"])


def split_by_frequency(grams: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Rows with a frequent gram or none, the other rows, and the test for a frequent gram."""
    hot = frequent_grams(grams)
    is_hot = F.col("gram").isin(hot) if hot else F.lit(False)
    easy = F.col("gram").isNull() | is_hot
    return grams.filter(easy), grams.filter(F.col("gram").isNotNull() & ~is_hot), is_hot


def chunk_scores(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per chunk and language: summed weights, grams found, bytes of its units.

    ``lang`` is null for the bytes of units that no language claims.
    """
    first = F.coalesce(F.col("rank"), F.lit(1)) <= 1
    return _sum_chunks(
        hits.withColumns(
            {
                "hits": F.when(F.col("rank") == 1, 1).otherwise(0),
                "unit_bytes": F.when(first, F.col("unit_bytes")).otherwise(0),
            }
        ),
        keys,
    )


def _sum_chunks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "span_no", "chunk", "script_no", "lang").agg(
        F.coalesce(F.sum("weight"), F.lit(0)).alias("score"),
        F.sum("hits").alias("hits"),
        F.sum("unit_bytes").alias("bytes"),
    )


def score_units(
    units: DataFrame, model: LangModel, keys: Sequence[str], words: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Chunk scores by words: the known words seen most often bring their summed scores, the others
    are cut into grams. Same result as scoring every gram, with a fraction of the rows.
    """
    place = [*keys, "span_no", "script_no", "chunk"]
    known = F.broadcast(
        words.select(
            F.col("unit").alias("_word"),
            F.col("lang").alias("_lang"),
            F.col("weight").alias("_weight"),
            F.col("hits").alias("_hits"),
            F.col("first").alias("_first"),
        )
    )
    many = is_kind(F.col("script_no"), "many")
    looked = units.join(known, many & (F.col("unit") == F.col("_word")), "left")
    found = F.col("_word").isNotNull()
    # a null gram stands for the word's own row; its other rows need no default hit
    itself = F.array(F.lit(None).cast("string"))
    own = F.when(found, itself).otherwise(unit_grams(model.kinds))
    default = F.when(F.coalesce("_first", F.lit(True)), default_gram()).otherwise(no_grams())
    # nearly all rows are of this kind: no array is made for them
    alone = found & ((F.col("pos") > 0) | ~F.coalesce("_first", F.lit(True)))
    grams = looked.select(
        *place, "pos", unit_size().alias("_size"), "_lang", "_weight", "_hits", "_first",
        F.posexplode_outer(F.when(alone, itself).otherwise(F.concat(own, default))).alias("_at", "gram"),
    )
    scored = score_grams(grams, model.grams, max_rows, model.gram_rows)
    by_word = F.col("gram").isNull() & F.col("_first").isNotNull()
    first = F.when(by_word, F.col("_first")).otherwise(F.coalesce(F.col("rank"), F.lit(1)) <= 1)
    return _sum_chunks(
        scored.select(
            *place,
            F.when(by_word, F.col("_lang")).otherwise(F.col("lang")).alias("lang"),
            F.when(by_word, F.col("_weight")).otherwise(F.col("weight")).alias("weight"),
            F.when(by_word, F.col("_hits")).when(F.col("rank") == 1, 1).otherwise(0).alias("hits"),
            F.when((F.col("_at") == 0) & first, F.col("_size")).otherwise(0).alias("unit_bytes"),
        ),
        keys,
    )


def delta_reliability(score1: Column, score2: Column, grams: Column) -> Column:
    """How clearly the best language leads, 0 to 100."""
    needed = F.least(F.greatest(F.floor(grams * 5 / 8), F.lit(MIN_GRAMS)), F.lit(MAX_GRAMS))
    most = F.when(grams < 8, grams * 12).otherwise(100)
    lead = score1 - score2
    return F.when(lead >= needed, most).when(lead <= 0, 0).otherwise(F.least(most, F.floor(lead * 100 / needed))).cast("int")


def expected_reliability(actual: Column, expected: Column) -> Column:
    """How near the score per kilobyte is to the usual one, 0 to 100.

    100 up to a ratio of 1.5, then falling linearly to 0 at 4.
    """
    high, low = F.greatest(actual, expected), F.least(actual, expected)
    # 100 * (4 - high/low) / 2.5 in integers
    slope = F.floor((low * 400 - high * 100) * 2 / (low * 5))
    return (
        F.when(expected.isNull() | (expected == 0), 100)
        .when(actual == 0, 0)
        .when(high * 2 <= low * 3, 100)
        .when(high > low * 4, 0)
        .otherwise(slope)
        .cast("int")
    )


def chunk_language(
    scores: DataFrame, expected: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """Best two languages of every chunk and the reliability of the best.

    (keys, span_no, chunk, lang1, lang2, score1, score2, grams, bytes,
    delta, expected, reliability)
    """
    # the best two stand side by side; the bytes that no language claims come last
    group = W.partitionBy(*keys, "span_no", "chunk", "script_no")
    order = group.orderBy(F.col("lang").isNull(), F.desc("score"), "lang")
    tops = scores.select(
        *keys, "span_no", "chunk", "script_no", "lang", F.when(F.col("lang").isNotNull(), F.col("score")).alias("score"),
        F.row_number().over(order).alias("_place"),
        F.lead("lang").over(order).alias("_lang2"),
        F.lead(F.when(F.col("lang").isNotNull(), F.col("score"))).over(order).alias("_score2"),
        F.sum("hits").over(group).alias("grams"),
        F.sum("bytes").over(group).alias("bytes"),
    ).filter(F.col("_place") == 1)
    defaults = array_of([lang for _, _, lang in SCRIPTS])
    by_script = is_kind(F.col("script_no"), "one")
    top = tops.select(
        *keys, "span_no", "chunk", "script_no", "grams", "bytes",
        F.when(by_script, F.get(defaults, F.col("script_no"))).otherwise(F.coalesce("lang", F.lit(UNKNOWN))).alias("lang1"),
        F.when(~by_script, F.col("_lang2")).alias("lang2"),
        F.when(by_script, F.col("bytes")).otherwise(F.coalesce("score", F.lit(0))).alias("score1"),
        F.when(by_script, 0).otherwise(F.coalesce("_score2", F.lit(0))).alias("score2"),
    )
    if expected is None:
        top = top.withColumn("_usual", F.lit(None).cast("long"))
    else:
        # one row per language
        side = F.broadcast(expected.select(F.col("lang").alias("lang1"), F.col("score_per_kb").alias("_usual")))
        top = top.join(side, "lang1", "left")
    sets = map_of(close_set_of())
    close = F.element_at(sets, F.col("lang1")) == F.element_at(sets, F.col("lang2"))
    per_kb = F.floor(F.col("score1") * 1024 / F.greatest(F.col("bytes"), F.lit(1)))
    sure = is_kind(F.col("script_no"), "one")
    return top.withColumn(
        "delta",
        F.when(sure | F.coalesce(close, F.lit(False)), 100).otherwise(
            delta_reliability(F.col("score1"), F.col("score2"), F.col("grams"))
        ),
    ).withColumn(
        "expected", F.when(sure, 100).otherwise(expected_reliability(per_kb, F.col("_usual")))
    ).select(
        *keys, "span_no", "chunk", "lang1", "lang2", "score1", "score2", "grams", "bytes",
        "delta", "expected", F.least("delta", "expected").alias("reliability"),
    )


def lang_byte_totals(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per text and language: bytes, score, and reliability times bytes."""
    return chunks.groupBy(*keys, F.col("lang1").alias("lang")).agg(
        F.sum("bytes").alias("bytes"),
        F.sum("score1").alias("score"),
        F.sum(F.col("reliability") * F.col("bytes")).alias("rel"),
    )


def score_texts(
    df: DataFrame, model: LangModel, keys: Sequence[str], text: str = "text", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Chunk scores of every text. Brings a text's grams together once, by ``keys``.

    The words seen most often in training, up to ``max_rows`` rows of them, are looked up whole; the
    others are cut into grams, which gives the same sums.
    """
    words = model.frequent_words(max_rows)
    if words is not None:
        return score_units(span_units(script_spans(df, keys, text), keys), model, keys, words, max_rows)
    grams = text_grams(df, keys, text, model.kinds)
    return chunk_scores(score_grams(grams, model.grams, max_rows, model.gram_rows), keys)
