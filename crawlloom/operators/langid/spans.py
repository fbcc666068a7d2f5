"""Language spans inside a text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.operators.langid.detect import text_chunks
from crawlloom.operators.langid.dims import UNKNOWN
from crawlloom.operators.langid.grams import unit_places
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.langid.placed import Packed, packed, placed_chunks, placed_units
from crawlloom.operators.langid.refine import dealt_chunks, gram_hits
from crawlloom.session import by_keys, materialize

RELIABLE_CHUNK = 50


def merge_adjacent_spans(
    chunks: DataFrame, keys: Sequence[str], order: Sequence[str], lang: str = "lang", size: str = "bytes"
) -> DataFrame:
    """(keys, span, offset, bytes, lang): neighbours of one language become one.

    Offsets count the bytes of the letters-only form of the text.
    """
    place = W.partitionBy(*keys).orderBy(*order)
    changed = ~F.col(lang).eqNullSafe(F.lag(lang).over(place)) | (F.row_number().over(place) == 1)
    runs = chunks.select(
        *keys,
        F.col(lang).alias("lang"),
        F.col(size).alias("_size"),
        changed.cast("int").alias("_new"),
        *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order)],
    )
    place = W.partitionBy(*keys).orderBy(*[f"_o{n}" for n in range(len(order))])
    upto = place.rowsBetween(W.unboundedPreceding, 0)
    runs = runs.withColumns(
        {"span": F.sum("_new").over(upto) - 1, "_end": F.sum("_size").over(upto)}
    )
    return runs.groupBy(*keys, "span").agg(
        F.min(F.col("_end") - F.col("_size")).alias("offset"),
        F.sum("_size").alias("bytes"),
        F.first("lang").alias("lang"),
    )


def detect_spans(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans of one language from chunk verdicts; an unreliable chunk is unknown."""
    lang = F.when(F.col("reliability") >= RELIABLE_CHUNK, F.col("lang1")).otherwise(UNKNOWN)
    return merge_adjacent_spans(chunks.withColumn("lang", lang), keys, ["span_no", "chunk"])


def _meetings(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, span_no, chunk, _after, _before, _of): two rows for every chunk behind one of another
    language, ``_of`` being the earlier and the later of the two."""
    order = W.partitionBy(*keys, "span_no").orderBy("chunk")
    return (
        chunks.select(*keys, "span_no", "chunk", "lang1", F.lag("lang1").over(order).alias("_before"))
        .filter(F.col("_before").isNotNull() & (F.col("_before") != F.col("lang1")))
        .select(*keys, "span_no", "chunk", F.col("lang1").alias("_after"), "_before",
                F.explode(F.array(F.col("chunk") - 1, F.col("chunk"))).alias("_of"))
    )


def meeting_chunks(dealt: DataFrame, chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``dealt_chunks`` on both sides of a border: all that ``refine_boundaries`` looks at.

    The dealt chunks stay where they are and are not sorted; only the borders, by far
    fewer and narrow, are shuffled to them.
    """
    at = [*keys, "span_no", "chunk"]
    borders = _meetings(chunks, keys).select(*keys, "span_no", F.col("_of").alias("chunk")).distinct()
    # a semi-join would be moved below the shuffle, which makes it another one
    return dealt.join(borders.hint("shuffle_hash"), at)


def refine_boundaries(hits: DataFrame, chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moves each border between two languages to the unit where it fits best.

    Over the units of two neighbouring chunks with different languages, the border
    goes where the score of the first language before it plus that of the second
    one after it is largest: the maximum of a running difference.
    (keys, span_no, chunk, border): ``border`` is the position of the first unit
    that belongs to the language of ``chunk``.
    """
    keys = list(keys)
    pairs = _meetings(chunks, keys)
    lead = F.when(F.col("lang") == F.col("_before"), F.col("weight")).when(
        F.col("lang") == F.col("_after"), -F.col("weight")
    )
    scored = (
        hits.withColumnRenamed("chunk", "_of")
        .join(pairs, [*keys, "span_no", "_of"])
        .groupBy(*keys, "span_no", "chunk", "pos")
        .agg(F.coalesce(F.sum(lead), F.lit(0)).alias("_lead"))
    )
    upto = (
        W.partitionBy(*keys, "span_no", "chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    )
    running = scored.withColumn("_running", F.sum("_lead").over(upto))
    return running.groupBy(*keys, "span_no", "chunk").agg(
        (F.max_by("pos", F.struct("_running", "pos")) + 1).alias("border")
    )


def text_spans(
    df: DataFrame,
    model: LangModel,
    keys: Sequence[str],
    text: str = "text",
    refine: bool = True,
    colocated: bool = False,
) -> DataFrame:
    """(keys, span, start, length, lang): runs of one language that cover a whole text.

    Offsets count characters of the text itself, from 0. What stands between two chunks
    belongs to the earlier one, so the pieces put together are the text. An unreliable
    chunk is unknown. With ``refine`` a border between two languages is moved to the word
    where it fits best; only texts in which languages meet are looked at again for that.
    A text without letters has no spans.
    """
    keys = list(keys)
    texts = df.select(*keys, text)
    if not colocated:
        texts = by_keys(texts, keys)
    table = packed(model)
    if table is None:
        return _spans_by_units(texts, model, keys, text, refine)
    # the places of a key's texts are counted through all of them, unit by unit
    shared = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    shared = materialize(shared)
    if shared.isEmpty():
        return _spans_by_chunks(texts, model, table, keys, text, refine)
    # null keys have no spans
    own = texts.join(shared, keys, "left_anti")
    several = _spans_by_units(texts.join(shared, keys, "left_semi"), model, keys, text, refine)
    return _spans_by_chunks(own, model, table, keys, text, refine).unionByName(several)


def _spans_by_chunks(texts: DataFrame, model: LangModel, table: Packed, keys: list[str], text: str, refine: bool) -> DataFrame:
    """``text_spans`` of texts whose keys are their own: rows for runs of chunks, and for units at borders."""
    at = [*keys, "span_no", "chunk"]
    for k in keys:
        texts = texts.filter(F.col(k).isNotNull())
    chunks = placed_chunks(texts, table, keys, RELIABLE_CHUNK, text)
    if not refine:
        return _cut(chunks.withColumn("_at", F.col("start")), keys)
    chunks = materialize(chunks)
    near = chunks.filter("meets").drop("size", "reliability", "meets")
    wanted = texts.join(near.hint("shuffle_hash"), keys)
    near = materialize(placed_units(wanted, [*at, "script_no", "first", "before", "start", "lang1"], text))
    dealt = near.select(*at, "script_no", "first", "before", F.array_join("units.unit", " ").alias("words"))
    borders = refine_boundaries(gram_hits(texts, model, keys, text, chunks=dealt), near, keys)
    places = near.select(*keys, "span_no", "first", "start", F.posexplode("units").alias("_k", "_u")).select(
        *keys, "span_no", (F.col("first") + F.col("_k")).alias("border"), (F.col("start") + F.col("_u.start")).alias("_moved")
    )
    moved = borders.join(places, [*keys, "span_no", "border"], "left").select(*at, "_moved", F.lit(True).alias("_border"))
    chunks = chunks.join(moved, at, "left")
    # a border behind a chunk is where the next one begins; behind the last unit of all nothing is left of the chunk
    start = F.when(F.col("_border"), F.coalesce("_moved", "then", "stop")).otherwise(F.col("start"))
    return _cut(chunks.withColumn("_at", start), keys)


def _spans_by_units(texts: DataFrame, model: LangModel, keys: list[str], text: str, refine: bool) -> DataFrame:
    """``text_spans`` with a row for every unit of every text."""
    chunks = text_chunks(texts, model, keys, text, colocated=True)
    # by the order of spans and chunks, the place of every chunk's first unit
    places = unit_places(texts, keys, text)
    starts = places.groupBy(*keys, "span_no", "chunk").agg(F.min("start").alias("start"), F.max("stop").alias("_stop"))
    chunks = chunks.join(starts, [*keys, "span_no", "chunk"])
    if refine:
        chunks = materialize(chunks)
        order = W.partitionBy(*keys, "span_no").orderBy("chunk")
        meets = chunks.withColumn("_before", F.lag("lang1").over(order)).filter("_before <> lang1").select(*keys).distinct()
        mixed = texts.join(meets, keys, "left_semi")
        dealt = meeting_chunks(dealt_chunks(mixed, keys, text), chunks, keys)
        hits = gram_hits(mixed, model, keys, text, chunks=dealt)
        borders = refine_boundaries(hits, chunks, keys)
        moved = borders.join(
            unit_places(mixed, keys, text).select(*keys, "span_no", F.col("pos").alias("border"), F.col("start").alias("_moved")),
            [*keys, "span_no", "border"], "left",
        ).select(*keys, "span_no", "chunk", "_moved", F.lit(True).alias("_border"))
        chunks = chunks.join(moved, [*keys, "span_no", "chunk"], "left")
        # behind the last unit of all there is no other: nothing is left of such a chunk
        start = F.when(F.col("_border"), F.coalesce("_moved", "_stop")).otherwise(F.col("start"))
    else:
        start = F.col("start")
    return _cut(chunks.withColumn("_at", start), keys, texts.select(*keys, F.length(text).alias("size")))


def _cut(chunks: DataFrame, keys: Sequence[str], sizes: DataFrame | None = None) -> DataFrame:
    """Spans from chunks that begin at ``_at`` in a text of length ``size``, a column of theirs or of ``sizes``."""
    lang = F.when(F.col("reliability") >= RELIABLE_CHUNK, F.col("lang1")).otherwise(UNKNOWN)
    order = W.partitionBy(*keys).orderBy("span_no", "chunk")
    # two borders of a short chunk may cross; then the later one gives way
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    runs = chunks.select(*keys, "span_no", "chunk", lang.alias("lang"), "_at", *([] if sizes else ["size"]))
    runs = runs.withColumns({"_at": F.max("_at").over(upto), "_k": F.row_number().over(order)})
    runs = runs.withColumn("_at", F.when(F.col("_k") == 1, 0).otherwise(F.col("_at")))
    runs = runs.join(sizes, keys) if sizes else runs
    runs = runs.withColumn("_next", F.coalesce(F.lead("_at").over(order), F.col("size")))
    merged = merge_adjacent_spans(
        runs.filter("_next > _at").withColumn("_length", F.col("_next") - F.col("_at")), keys, ["span_no", "chunk"], size="_length"
    )
    return merged.select(*keys, "span", F.col("offset").alias("start"), F.col("bytes").alias("length"), "lang")
