"""Repetitive text: removing it, and the second pass over weak answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.functions.columns import let
from crawlloom.operators.langid.detect import detect_language
from crawlloom.operators.langid.grams import (
    chunk_units,
    gram_rows,
    letters_only,
    script_spans,
    span_chunks,
    text_grams,
)
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.langid.score import score_grams
from crawlloom.session import by_keys, materialize

# Sizes from which ``reference=True`` looks at a text again and squeezes it.
SHORT_TEXT, LONG_SPAN = 256, 2048
GOOD_FIRST, GOOD_FIRST_TWO = 70, 93
BLOCK, SPACES_TRIGGER, REPEATS_TRIGGER, SPACES_DROP, REPEATS_DROP = 48, 25, 67, 25, 40
CONTEXT = 4
BOOSTS = 4


def is_weak(df: DataFrame, reference: bool = False) -> Column:
    """The answer deserves a second look: no clear winner.

    With ``reference`` short texts keep their first answer.
    """
    good = (F.col("percent1") >= GOOD_FIRST) | (
        F.col("percent1") + F.col("percent2") >= GOOD_FIRST_TWO
    )
    weak = ~(F.col("reliable") & good)
    return weak & (F.col("text_bytes") > SHORT_TEXT) if reference else weak


def drop_repeated_words(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, text): words whose context of four words occurred before are left out."""
    units = df.select(*keys, F.split(letters_only(F.col(text)), " ").alias("_words"))

    def contexts(ws: Column) -> Column:
        # word by word: a slice would copy the whole array for each of them
        four = lambda i: F.concat_ws(" ", *[F.get(ws, i - n) for n in range(CONTEXT - 1, -1, -1)])
        return F.transform(
            ws,
            lambda w, i: F.struct(F.when(i >= CONTEXT - 1, four(i)).alias("context"), i.alias("pos"), w.alias("word")),
        )

    # equal contexts lie side by side, the earliest first; all within the row of the text
    kept = let(
        F.sort_array(F.flatten(F.transform("_texts", contexts))),
        lambda all_units: F.filter(
            all_units, lambda u, i: u["context"].isNull() | ~u["context"].eqNullSafe(F.get(all_units, i - 1)["context"])
        ),
    )
    in_order = F.sort_array(F.transform(kept, lambda u: F.struct(u["pos"], u["word"])))
    return units.groupBy(*keys).agg(F.collect_list("_words").alias("_texts")).select(
        *keys, F.array_join(F.transform(in_order, lambda u: u["word"]), " ").alias(text)
    )


def _share(piece: Column, pattern: str) -> Column:
    return F.regexp_count(piece, F.lit(pattern)) * 100 / F.greatest(F.length(piece), F.lit(1))


def _repeats(piece: Column) -> Column:
    """Percentage of three-letter grams of the piece that repeat an earlier one."""
    grams = F.regexp_extract_all(piece, F.lit(r"(?s)(?=(.{3}))."), F.lit(1))
    return let(
        grams,
        lambda g: (F.size(g) - F.size(F.array_distinct(g))) * 100 / F.greatest(F.size(g), F.lit(1)),
    )


def squeeze_text(text: Column, reference: bool = False) -> Column:
    """Text without the 48-letter blocks that are mostly padding or repetition.

    Every block of every text is judged alike. With ``reference`` only long texts that
    start with padding or repetition are.
    """
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))
    kept = F.filter(blocks, lambda b: (_share(b, " ") < SPACES_DROP) & (_repeats(b) < REPEATS_DROP))
    squeezed = F.array_join(kept, "")
    if not reference:
        return squeezed
    head = F.left(text, F.lit(256))
    trigger = (_share(head, " ") >= SPACES_TRIGGER) | (_repeats(head) >= REPEATS_TRIGGER)
    return F.when((F.length(text) > LONG_SPAN) & trigger, squeezed).otherwise(text)


def refine_pass(
    df: DataFrame,
    model: LangModel,
    keys: Sequence[str],
    text: str = "text",
    colocated: bool = False,
    reference: bool = False,
) -> DataFrame:
    """``detect_language`` with a second pass over the weak answers only, after squeezing
    and without repeated words.

    The second answer counts whatever it is. It is reached by the ordinary rules: languages
    that are not reliable are dropped, and it is reliable only where a first answer would
    be. So a word that no language claims stays unknown. The first answers are a narrow
    table; writing it out keeps the texts from being scored twice.
    """
    keys = list(keys)
    first = materialize(detect_language(df, model, keys, text, details=True, colocated=colocated))
    weak = first.filter(is_weak(first, reference)).select(*keys)
    texts = by_keys(df.select(*keys, text).join(weak, keys, "left_semi"), keys)
    again = drop_repeated_words(texts.withColumn(text, squeeze_text(F.col(text), reference)), keys, text)
    second = detect_language(again, model, keys, text, colocated=True)
    # a text that has no words left keeps its first answer
    second = second.select(*keys, F.struct("lang", "reliable").alias("_second"))
    return first.join(second, keys, "left").select(
        *keys,
        F.coalesce("_second.lang", "lang").alias("lang"),
        F.coalesce("_second.reliable", "reliable").alias("reliable"),
    )


def distinct_boost(scores: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds to each chunk the weights of the last four distinctive words before it.

    A word is distinctive when the model knows it in one language only; ``hits`` that say so,
    as ``gram_hits`` does in ``langs``, leave the others out before the sort. A word counts from
    the chunk after its own up to that of the fourth such word behind it, so the words are
    sorted once and no pairs are formed beyond the four that count.
    """
    keys = list(keys)
    place = [*keys, "span_no"]
    scores = materialize(scores)
    words = hits.filter(F.col("gram").startswith("w:") & F.col("lang").isNotNull())
    if "langs" in hits.columns:
        words = words.filter("langs = 1")
    same = F.struct("pos", "chunk", "gram")
    order = W.partitionBy(*place).orderBy("_same")
    alone = words.select(*place, "chunk", "pos", "lang", "weight", same.alias("_same")).withColumns(
        {"_before": F.lag("_same").over(order), "_after": F.lead("_same").over(order)}
    ).filter(~F.col("_same").eqNullSafe(F.col("_before")) & ~F.col("_same").eqNullSafe(F.col("_after")))
    upto = alone.withColumn("_upto", F.lead("chunk", BOOSTS).over(order))
    # the chunks of a span are numbered without gaps
    ends = scores.groupBy(*place, "script_no").agg(F.max("chunk").alias("_last"))
    boosts = (
        upto.select(*place, "chunk", "_upto", "lang", "weight")
        .join(ends, place)
        .withColumn("_upto", F.least(F.coalesce("_upto", "_last"), "_last"))
        .filter(F.col("_upto") > F.col("chunk"))
        .select(
            *place, F.explode(F.sequence(F.col("chunk") + 1, F.col("_upto"))).alias("chunk"), "script_no", "lang",
            F.col("weight").cast("long").alias("score"),
            F.lit(0).cast("long").alias("hits"),
            F.lit(0).cast("long").alias("bytes"),
        )
    )
    return (
        scores.unionByName(boosts)
        .groupBy(*place, "chunk", "script_no", "lang")
        .agg(F.sum("score").alias("score"), F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes"))
    )


def gram_hits(
    df: DataFrame,
    model: LangModel,
    keys: Sequence[str],
    text: str = "text",
    colocated: bool = False,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Every gram of every text with its languages, on the texts' own partitions.

    ``langs`` is the number of languages that the model knows the gram in. With ``chunks``,
    as ``dealt_chunks`` gives them, their grams instead, where the chunks are.
    """
    if chunks is not None:
        grams = gram_rows(chunk_units(chunks, keys), keys, model.kinds)
    else:
        texts = df.select(*keys, text)
        if not colocated:
            texts = by_keys(texts, keys)
        grams = text_grams(texts, keys, text, model.kinds)
    known = model.grams.withColumn("langs", F.count("lang").over(W.partitionBy("gram")))
    return score_grams(grams, known, rows=model.gram_rows)


def dealt_chunks(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """The chunks of all texts, shuffled once by text, span and chunk.

    What is read from this twice in one query reads that one shuffle, if no key can be null, and
    joins and aggregates by chunk need no other. The spans are found where ``df`` has its rows.
    """
    chunks = span_chunks(script_spans(df.select(*keys, text), keys, text), keys)
    # never null: else a join would put a filter of its own below the shuffle, which makes it another one
    numbers = {c: F.coalesce(c, F.lit(-1)) for c in ("span_no", "chunk")}
    return by_keys(chunks.withColumns(numbers), [*keys, "span_no", "chunk"])


def valid_utf8_bytes(body: Column) -> Column:
    """Length of the longest prefix of the bytes that is valid UTF-8."""
    text = body.cast("string")
    # replacement characters of the text itself are masked by as many other bytes
    masked = F.replace(text, F.lit("�"), F.lit("\x00\x00\x00"))
    prefix = F.substring_index(F.make_valid_utf8(masked), "�", 1)
    return F.when(F.is_valid_utf8(text), F.octet_length(body)).otherwise(F.octet_length(prefix))
