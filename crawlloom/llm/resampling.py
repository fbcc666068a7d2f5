"""Importance resampling towards a target: bucketed word counts, Gumbel keys, a radix sort.

Scores are sums of an array's entries over a document's features (Xie et al., "Data
Selection for Language Models via Importance Resampling", 2023); Gumbel noise makes the
highest scores a draw without replacement. Ranks come from a distributed LSD radix sort:
stable counting-sort passes over the digits of (score descending, id ascending).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlloom.llm import words as W
from crawlloom.llm.shared import Scratch
from crawlloom.session import shuffle_partitions

BUCKETS, NGRAMS, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
#: Bits of a digit: a pass counts at most 2^12 digits a block.
DIGIT_BITS = 12
#: Rows of a block at most, the unit a task sorts in memory (about 50 bytes a row).
BLOCK_ROWS = 1 << 20
#: Longer features are hashed one by one.
_SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc32_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of the byte ranges, all short ranges a byte at a time together."""
    size = end - start
    out = np.empty(len(start), dtype=np.uint32)
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]])
    short = np.flatnonzero(size <= _SHORT)
    order = short[np.argsort(-size[short], kind="stable")]
    s, most = start[order], int(size[order[0]]) if len(order) else 0
    # how many ranges are longer than k
    longer = len(order) - np.cumsum(np.bincount(size[order], minlength=most + 1))
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(most):
        m = int(longer[k])
        c = crc[:m]
        crc[:m] = _CRC[(c ^ data[s[:m] + k]) & 255] ^ (c >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features(col: pa.Array, ngrams: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after, words per row, features per row, buckets of the features row by row).

    The words are written out again in lower case with one blank between, so that a run
    of words is one range of bytes.
    """
    for a, b, data, offsets in W.slices(col):
        start, end = W.word_bounds(data, offsets[1:], W.PUNCTUATION)
        counts = np.diff(np.searchsorted(start, offsets))
        size = end - start
        to = np.cumsum(size + 1) - (size + 1)
        text = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        text[np.repeat(to, size) + inside] = _LOWER[data[np.repeat(start, size) + inside]]
        doc, found, owner = np.repeat(np.arange(b - a), counts), [], []
        for n in range(1, ngrams + 1):
            first = np.arange(max(0, len(start) - n + 1))
            first = first[doc[first] == doc[first + n - 1]]
            last = first + n - 1
            found.append(crc32_ranges(text, to[first], to[last] + size[last]).astype(np.int64) % buckets)
            owner.append(doc[first])
        of = np.concatenate(owner)
        found = np.concatenate(found)[np.argsort(of, kind="stable")]
        yield a, b, counts, np.bincount(of, minlength=b - a), found


def _tally(batches, ngrams: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for *_, found in features(batch.column(0), ngrams, buckets):
            total += np.bincount(found, minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; ``buckets`` numbers are all that reaches the driver."""
    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(lambda it: _tally(it, ngrams, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, target over source, for each bucket."""
    n = float(len(source))
    up = (target + 1.0) * (float(source.sum()) + n)
    down = (source + 1.0) * (float(target.sum()) + n)
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def _weigh(batches, shared, ngrams: int) -> Iterator[pa.RecordBatch]:
    gain = shared.value
    for batch in batches:
        for a, b, n_words, per, found in features(batch.column(1), ngrams, len(gain)):
            sums = np.concatenate([[0], np.cumsum(gain[found])])
            ends = np.cumsum(per)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(n_words), pa.array(per), pa.array(sums[ends] - sums[ends - per])],
                names=["id", "n_words", "n_features", "weight"],
            )


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """(id, n_words, n_features, weight) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _weigh(it, shared, ngrams), f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_col: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256("seed:id")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def _sorter(word: str, shift: int, bits: int, block_rows: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One block's counting sort: the rows of a digit keep their order, from the digit's offset on."""

    def place(rows: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True)
        digit = (rows[word].to_numpy() >> shift) & ((1 << bits) - 1)
        base = np.zeros(1 << bits, dtype=np.int64)
        base[offsets["digit"].to_numpy()] = offsets["before"].to_numpy()
        order = np.argsort(digit.astype(np.uint16), kind="stable")  # a counting sort, for 16-bit numbers
        count = np.bincount(digit, minlength=1 << bits)
        to = np.empty(len(rows), dtype=np.int64)
        to[order] = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        rows["at"] = to + base[digit]
        rows["block"] = rows["at"] // block_rows
        return rows

    return place


def radix_sort(rows: DataFrame, words: list[tuple[str, int]], digit_bits: int = DIGIT_BITS) -> tuple[DataFrame, Scratch]:
    """``rows`` with ``at``, their place from 0 in the order of ``words``; and the tables behind it.

    ``words`` are non-negative bigint columns and their bits, the least significant first.
    A pass takes one digit: blocks count their digits, offsets are the digits before in all
    blocks and the same digit in earlier blocks, and each row goes to the place they give.
    Blocks are equal runs of places, whatever the keys, so no digit is a hot one; rows that
    are equal keep their order. Each pass is written, which cuts the lineage.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "radix")
    start = F.monotonically_increasing_id()
    now = scratch.put("rows", rows.withColumn("block", start.bitwiseAND(~((1 << 33) - 1))).withColumn("at", start))
    total = now.count()
    block_rows = max(1, min(BLOCK_ROWS, math.ceil(total / shuffle_partitions(spark))))
    passes = [(w, shift, min(digit_bits, bits - shift)) for w, bits in words for shift in range(0, bits, digit_bits)]
    # without any bit to tell rows apart, one pass still turns row numbers into places
    for k, (word, shift, bits) in enumerate(passes or [(words[0][0], 0, 1)]):
        digit = F.shiftright(word, shift).bitwiseAND((1 << bits) - 1).cast("int")
        counts = scratch.put(f"counts{k}", now.groupBy("block", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")))
        per = {r["digit"]: r["n"] for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).collect()}
        below, done = [], 0
        for d in sorted(per):
            below.append((d, done))
            done += per[d]
        below = F.broadcast(spark.createDataFrame(below, "digit int, below bigint"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(below, "digit")
        offsets = offsets.select("block", "digit", (F.col("below") + F.col("earlier")).alias("before"))
        sorter = _sorter(word, shift, bits, block_rows)
        placed = now.groupBy("block").cogroup(offsets.groupBy("block")).applyInPandas(sorter, now.schema)
        old, name = ("rows" if k == 0 else f"pass{k - 1}"), f"pass{k}"
        now = scratch.put(name, placed)
        scratch.drop(old, f"counts{k}")
    return now.drop("block"), scratch


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``; rank is null where not drawn.

    Features are the runs of 1 to ``ngrams`` words, bucketed by crc32. Bucket counts cover all
    documents and all texts of ``target``. ``weight`` sums the gains of a document's features,
    ``score`` adds Gumbel noise that depends on id and ``seed`` only. Of the documents with at
    least ``least_words`` words ``percent`` percent, rounded down, are drawn: the highest
    scores, ties to the smaller id. Ids are integers.

    Null and empty texts have no features, weight 0, and are not drawn while ``least_words``
    is above 0. Rows repeated under one id each count, have the same noise, and are ranked one by one; rows
    without id share one noise and come after all ids in a tie. An empty table gives an empty table,
    an empty target equal shares. Other columns are not looked at.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_text_col, ngrams, buckets))
    weighed = weights(docs, gain, id_col, text_col, ngrams).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scratch = Scratch(spark, "resampling")
    weighed = scratch.put("weighed", weighed)
    fit = F.col("n_words") >= least_words
    ranked = weighed.filter(fit)
    edge = ranked.agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top"), F.min("score").alias("low"),
                      F.min("id").alias("first"), F.max("id").alias("last")).first()
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not edge["n"]:
        return weighed.select(*columns, none)
    first, last = (edge["first"], edge["last"] + 1) if edge["first"] is not None else (0, 0)
    low = F.coalesce(F.col("id").cast("bigint"), F.lit(last)) - F.lit(first)
    high = F.lit(edge["top"]) - F.col("score")
    low_bits, high_bits = (last - first).bit_length(), (edge["top"] - edge["low"]).bit_length()
    if low_bits + high_bits <= 63:  # one word: a digit may take bits of both
        rows, words = ranked.withColumn("k0", F.shiftleft(high, low_bits).bitwiseOR(low)), [("k0", low_bits + high_bits)]
    else:
        rows, words = ranked.withColumn("k0", low).withColumn("k1", high), [("k0", low_bits), ("k1", high_bits)]
    placed, _ = radix_sort(rows, words)
    drawn = percent * edge["n"] // 100
    rank = F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank")
    return placed.select(*columns, rank).union(weighed.filter(~fit).select(*columns, none))
