"""Ranked lexical search: documents that look alike to the items are scored once.

A document is cut down to the items' vocabulary. Documents with the same counts of its terms
and the same length factor m form a class: they are grouped by a hash and told apart by the
counts themselves, so only equal ones meet. Each class is scored once for every item and
its members follow in the order of their ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlloom.llm import words as W
from crawlloom.llm.shared import Scratch, bounded_blocks

TOP = 10
#: Text of the items that are searched at a time; more items make more passes.
BLOCK_BYTES = 1 << 20
#: Cells of the table of classes and items, and postings behind them, that a task fills at a time.
CELLS = 1 << 20


def _term_hashes(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, word hashes, words per row)."""
    for a, b, data, offsets in W.slices(col):
        start, end = W.word_bounds(data, offsets[1:], W.PUNCTUATION)
        yield a, b, W.hash_words(data, start, end), np.diff(np.searchsorted(start, offsets))


class Queries:
    """The terms of a block of items as postings: for each term its items and how often they hold it."""

    def __init__(self, rows: list[int], texts: list[str | None]):
        self.rows, hashes, owner = rows, [], []
        for a, b, found, counts in _term_hashes(pa.array(texts, type=pa.large_string())):
            hashes.append(found)
            owner.append(np.repeat(np.arange(a, b), counts))
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
        self.terms, term = np.unique(hashes, return_inverse=True)
        pair, self.times = np.unique(term * max(1, len(rows)) + owner, return_counts=True)
        self.item = pair % max(1, len(rows))
        self.first = np.searchsorted(pair // max(1, len(rows)), np.arange(len(self.terms) + 1))
        self.weight = np.zeros(len(self.terms), dtype=np.int64)

    def weigh(self, n: int, df: np.ndarray) -> None:
        self.weight = np.floor(1000.0 * np.log((2.0 * n + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def _bag(batches, shared) -> Iterator[pa.RecordBatch]:
    """The counts of the vocabulary's terms in each text: term numbers, then their counts, as 32-bit integers."""
    vocabulary = shared.value.terms
    for batch in batches:
        for a, b, hashes, counts in _term_hashes(batch.column(1)):
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = vocabulary[at] == hashes
            doc = np.repeat(np.arange(b - a), counts)[hit]
            key, tf = np.unique(doc * len(vocabulary) + at[hit], return_counts=True)
            edges = np.searchsorted(key // len(vocabulary), np.arange(b - a + 1))
            term, tf = (key % len(vocabulary)).astype("<i4"), tf.astype("<i4")
            bags = [term[i:j].tobytes() + tf[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(counts), pa.array(bags, type=pa.binary())], names=["id", "n", "bag"]
            )


def _df(batches, n_terms: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(n_terms, dtype=np.int64)
    for batch in batches:
        for bag in batch.column(0):
            both = np.frombuffer(bag.as_buffer(), dtype="<i4")
            df[both[: len(both) // 2]] += 1
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])


def _scores(query: Queries, bags: list[np.ndarray], m: np.ndarray) -> np.ndarray:
    """Classes x items: the scores, in 64-bit integers."""
    size = np.array([len(b) // 2 for b in bags])
    row = np.repeat(np.arange(len(bags)), size)
    term = np.concatenate([b[: len(b) // 2] for b in bags])
    tf = np.concatenate([b[len(b) // 2 :] for b in bags]).astype(np.int64)
    impact = query.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    n = query.first[term + 1] - query.first[term]
    at = np.repeat(query.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    cell = np.repeat(row, n) * len(query.rows) + query.item[at]
    value = np.repeat(impact, n) * query.times[at]
    cells = len(bags) * len(query.rows)
    # doubles hold 53 bits: the upper and the lower half of the bits are summed apart
    low = np.bincount(cell, weights=value & 0xFFFFFF, minlength=cells)
    high = np.bincount(cell, weights=value >> 24, minlength=cells)
    return (low.astype(np.int64) + (high.astype(np.int64) << 24)).reshape(len(bags), -1)


def _parts(query: Queries, bags: list[np.ndarray], order: list[int]) -> Iterator[list[int]]:
    """``order`` cut into runs of classes that take ``CELLS`` cells and postings at most, or one class that takes more."""
    postings = np.diff(query.first)
    part, held = [], 0
    for j in order:
        size = len(query.rows) + int(postings[bags[j][: len(bags[j]) // 2]].sum())
        if part and held + size > CELLS:
            yield part
            part, held = [], 0
        part.append(j)
        held += size
    if part:
        yield part


def _rank(batches, shared, top: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The best documents of this task for each item, from its classes."""
    query = shared.value
    best: list[list] = [[] for _ in query.rows]
    for batch in batches:
        members = batch.column(2).to_pylist()
        # by smallest member, so that equal scores are met in the order of their ids
        order = sorted(range(len(members)), key=lambda i: (members[i][0]["absent"], members[i][0]["id"] or 0) if members[i][0]["absent"] else (False, members[i][0]["id"]))
        every = [np.frombuffer(bag.as_buffer(), dtype="<i4") for bag in batch.column(1)]
        for part in _parts(query, every, order):
            scores = _scores(query, [every[j] for j in part], batch.column(0).take(pa.array(part)).to_numpy(zero_copy_only=False))
            for k in np.flatnonzero(scores.max(axis=0) > 0).tolist():
                mine = scores[:, k]
                least = -best[k][-1][0] if len(best[k]) == top else 1
                some = np.flatnonzero(mine >= least)
                some = some[np.argsort(-mine[some], kind="stable")[:top]]
                if len(some):
                    new = [(-int(mine[c]), x["absent"], x["id"]) for c in some.tolist() for x in members[part[c]]]
                    best[k] = sorted(best[k] + new, key=lambda x: x[:2] if x[1] else x)[:top]
    rows = [(query.rows[k], x[2], -x[0]) for k, found in enumerate(best) for x in found]
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item_id, rank, id, score, item_row): the ``top`` best documents of every row of ``items``.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A document's m
    is 25 + (75 * its terms * documents) div all terms; its score sums, over the item's terms with
    repeats, floor(1000 ln((2N + 2) / (2df + 1))) * ((10^9 tf) div (1000 tf + 8m)). N and all terms count
    every document with a term. Only scores above 0 are returned, equal ones by ascending id.

    Items are searched in blocks of ``BLOCK_BYTES`` of text (or one longer item), which bounds what
    is broadcast; each block makes a pass over the documents. A class brings its ``top`` smallest ids,
    picked before the shuffle as well, so a class of any size is no hot group. Words are compared
    as 64-bit hashes.

    Null and empty texts have no terms: such items find nothing, such documents are not counted.
    Rows repeated under one id are documents of their own, and may fill several ranks; rows
    without id come last among equal scores. Items repeated under one id, or without id, are
    each searched; ``item_row`` tells them apart. Empty tables give an empty table. Other columns
    are not looked at.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "ranking")
    kind = docs.schema[id_col].dataType
    asked = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    asked = scratch.put("items", asked.withColumn("_row", F.monotonically_increasing_id()))
    dealt, blocks = bounded_blocks(asked.withColumn("_size", F.coalesce(F.octet_length("text"), F.lit(0))), "_size", BLOCK_BYTES)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found_ddl = f"item_row bigint, id {kind.simpleString()}, score bigint"
    empty = spark.createDataFrame([], found_ddl)
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, ranked = to_arrow_schema(empty.schema), empty
    for k, (bucket, piece) in enumerate(blocks):
        mine = dealt.filter((F.col("_bucket") == bucket) & (F.col("_piece") == piece)).select("_row", "text").collect()
        query = Queries([r["_row"] for r in mine], [r["text"] for r in mine])
        if not len(query.terms):
            continue
        words = spark.sparkContext.broadcast(query)
        bags = scratch.put(f"bags{k}", texts.mapInArrow(lambda it, q=words: _bag(it, q), f"id {kind.simpleString()}, n bigint, bag binary"))
        words.destroy()
        size = bags.filter("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
        if not size["N"]:
            break
        df, n_terms = np.zeros(len(query.terms), dtype=np.int64), len(query.terms)
        seen = bags.select("bag").mapInArrow(lambda it, n=n_terms: _df(it, n), "term bigint, df bigint")
        for r in seen.groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        query.weigh(size["N"], df)
        m = (F.lit(25) + F.expr(f"(75L * n * {size['N']}L) div {size['L']}L")).alias("m")
        same = ["hash", "m", "bag"]
        classes = bags.filter(F.octet_length("bag") > 0).select("id", m, "bag").withColumn("hash", F.xxhash64("m", "bag"))
        first = Window.partitionBy(*same).orderBy(F.col("id").asc_nulls_last())
        classes = classes.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= top)
        member = F.struct(F.col("id").isNull().alias("absent"), "id")
        classes = classes.groupBy(*same).agg(F.array_sort(F.collect_list(member)).alias("members")).drop("hash")
        weighed = spark.sparkContext.broadcast(query)
        best = classes.mapInArrow(lambda it, q=weighed: _rank(it, q, top, schema), found_ddl)
        ranked = ranked.union(scratch.put(f"best{k}", best))
        weighed.destroy()
        scratch.drop(f"bags{k}")
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = asked.select(F.col("_row").alias("item_row"), "item_id")
    return named.join(ranked, "item_row").select(F.col("item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score", "item_row")
