"""Benchmark decontamination: suffix arrays of the training text, searched by test suffixes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm import words as W
from crawlloom.llm.shared import Scratch, bounded_blocks

WINDOW = 10
#: Text of one shard, the unit that gets a suffix array of its own.
SHARD_BYTES = 4 << 20
#: Benchmark text that is held by a task at a time; more items make more passes.
BLOCK_BYTES = 32 << 20
#: Pairs of a place in a document and one in an item that are followed at a time.
PAIRS = 1 << 20


class SuffixArray:
    """Suffixes of a sequence of words, sorted by their first 27 words.

    Words are their 64-bit hashes, whose order is as good as any. Three rounds of
    tripling sort by 3, 9 and 27 words; ties after that are in any order, which does not
    matter to a search for at most that many words. Longer matches are found from
    the places by comparing on.
    """

    REACH = 27

    def __init__(self, seq: np.ndarray):
        self.seq, n = seq, len(seq)
        order = np.argsort(seq)
        rank = self._ranks(seq[order], order)
        for step in (1, 3, 9):
            bits = np.uint64(max(1, math.ceil(math.log2(int(rank.max(initial=0)) + 2))))
            key = rank + np.uint64(1)
            if 3 * int(bits) <= 64:
                key = (key << bits) | self._shift(rank, step)
                key = (key << bits) | self._shift(rank, 2 * step)
                order = np.argsort(key)
                rank = self._ranks(key[order], order)
            else:  # more than two million different ranks: one word pair at a time
                for by in (step, 2 * step):
                    pair = (key << bits) | self._shift(rank, by)
                    order = np.argsort(pair)
                    key = self._ranks(pair[order], order) + np.uint64(1)
                rank = key - np.uint64(1)
        self.sa = order if n else np.zeros(0, dtype=np.int64)

    @staticmethod
    def _shift(rank: np.ndarray, by: int) -> np.ndarray:
        """Rank + 1 of the suffix ``by`` words on, 0 past the end."""
        out = np.zeros_like(rank)
        if by < len(rank):
            out[:-by] = rank[by:] + np.uint64(1)
        return out

    @staticmethod
    def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
        out = np.empty(len(order), dtype=np.uint64)
        if len(order):
            out[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
        return out

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the array whose suffixes start with each row of ``queries`` (at most 27 wide)."""
        lo = np.zeros(len(queries), dtype=np.int64)
        hi = np.full(len(queries), len(self.sa), dtype=np.int64)
        for w in range(queries.shape[1]):
            want = queries[:, w]
            lo, hi = self._bound(lo, hi, want, w, False), self._bound(lo, hi, want, w, True)
        return lo, hi

    def _bound(self, lo, hi, want, w: int, after: bool) -> np.ndarray:
        lo, hi, n = lo.copy(), hi.copy(), len(self.seq)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            at = self.sa[mid] + w
            word = self.seq[np.minimum(at, n - 1)]
            # a suffix that has ended comes before every other
            less = (at >= n) | ((word <= want[open_]) if after else (word < want[open_]))
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo


class TestItems:
    """Words of benchmark items and the starts of their windows, by window width."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        col = pa.array(texts, type=pa.large_string())
        seqs, owner = [], []
        for a, _, data, offsets in W.slices(col):
            start, end = W.word_bounds(data, offsets[1:], W.PUNCTUATION)
            seqs.append(W.hash_words(data, start, end))
            owner.append(a + np.searchsorted(offsets, start, side="right") - 1)
        self.ids = ids
        self.words = np.concatenate(seqs) if seqs else np.zeros(0, dtype=np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(owner, np.arange(len(ids)))
        self.count = np.diff(np.append(self.first, len(self.words)))
        #: by width: the distinct windows, and where each stands: places sorted by window, first of each
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in np.unique(np.minimum(self.count, window)):
            if width:
                items = np.flatnonzero(np.minimum(self.count, window) == width)
                n = self.count[items] - width + 1
                at = np.repeat(self.first[items] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                rows = np.ascontiguousarray(self.words[at[:, None] + np.arange(width)])
                _, one, which = np.unique(rows.view(f"V{8 * width}").ravel(), return_index=True, return_inverse=True)
                order = np.argsort(which, kind="stable")
                edges = np.searchsorted(which[order], np.arange(len(one) + 1))
                self.by_width[int(width)] = (rows[one], at[order], np.repeat(items, n)[order], edges)


HITS = "id string, row bigint, n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>, longest bigint"


def _merged(start: np.ndarray, stop: np.ndarray) -> list[dict]:
    """Unions of intervals; ``start`` is sorted."""
    reach = np.maximum.accumulate(stop)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return [{"start": int(a), "stop": int(b)} for a, b in zip(start[first], reach[last], strict=True)]


def _shard(ids: pa.Array, rows: pa.Array, data: np.ndarray, offsets: np.ndarray, test: TestItems) -> Iterator[dict]:
    start, end = W.word_bounds(data, offsets[1:], W.PUNCTUATION)
    first = np.searchsorted(start, offsets)
    counts = np.diff(first)
    # one separator after each document, a value no word has twice: matches stop there
    docs = np.repeat(np.arange(len(counts)), counts)
    seq = W.constants(41, 1).repeat(len(start) + len(counts))
    seq[np.arange(len(start)) + docs] = W.hash_words(data, start, end)
    begin = first[:-1] + np.arange(len(counts))
    array, spans, owners, longest = SuffixArray(seq), [], [], np.zeros(len(counts), dtype=np.int64)
    for width, (windows, at, item, edges) in test.by_width.items():
        lo, hi = array.search(windows)
        n = hi - lo
        # a place starts one window of a width at most, so there are no more places than words
        place = array.sa[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        window = np.repeat(np.arange(len(windows)), n)
        owner = np.searchsorted(begin, place, side="right") - 1
        spans.append(np.stack([place, np.full(len(place), width), owner]))
        held = np.unique(owner * len(windows) + window)
        doc, w = held // len(windows), held % len(windows)
        many = edges[w + 1] - edges[w]
        which = item[np.repeat(edges[w] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        owners.append(np.unique(np.repeat(doc, many) * len(test.ids) + which))
        _longest(seq, test, place, window, owner, at, item, edges, width, longest)
    found = np.concatenate(spans, axis=1) if spans else np.zeros((3, 0), dtype=np.int64)
    found = found[:, np.argsort(found[0], kind="stable")]
    cuts = np.searchsorted(found[2], np.arange(len(counts) + 1))
    pairs = np.unique(np.concatenate(owners)) if owners else np.zeros(0, dtype=np.int64)
    starts = np.searchsorted(pairs // max(1, len(test.ids)), np.arange(len(counts) + 1))
    for d in range(len(counts)):
        mine = found[:, cuts[d] : cuts[d + 1]]
        names = [test.ids[i] for i in (pairs[starts[d] : starts[d + 1]] % max(1, len(test.ids))).tolist()]
        yield {
            "id": ids[d].as_py(), "row": rows[d].as_py(), "n_words": int(counts[d]),
            "spans": _merged(mine[0] - begin[d], mine[0] - begin[d] + mine[1]) if mine.shape[1] else [],
            "items": [str(i) for i in names if i is not None], "longest": int(longest[d]),
        }


def _longest(seq, test, place, window, owner, at, item, edges, width: int, longest: np.ndarray) -> None:
    """Raise ``longest`` to each document's longest verbatim match, in words of one item.

    Of all pairs of a place and an item's window only those that begin a match are
    followed; pairs are made a bounded number at a time.
    """
    many = edges[window + 1] - edges[window]
    upto = np.cumsum(many)
    a = 0
    while a < len(place):
        done = int(upto[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
        n, first = many[a:b], edges[window[a:b]]
        k = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        p, q, it = np.repeat(place[a:b], n), at[k], item[k]
        # the word before differs, or there is none before in the item
        begins = (q == test.first[it]) | (p == 0)
        begins |= seq[np.maximum(p - 1, 0)] != test.words[np.maximum(q - 1, 0)]
        p, q, it = p[begins], q[begins], it[begins]
        doc, size = np.repeat(owner[a:b], n)[begins], np.full(int(begins.sum()), width)
        stop, on = test.first[it] + test.count[it], np.arange(len(p))
        while len(on):
            x, y = p[on] + size[on], q[on] + size[on]
            inside = (y < stop[on]) & (x < len(seq))
            on, x, y = on[inside], x[inside], y[inside]
            on = on[seq[x] == test.words[y]]
            size[on] += 1
        np.maximum.at(longest, doc, size)
        a = b


def _search(batches, test) -> Iterator[pa.RecordBatch]:
    items = test.value
    schema = pa.schema(
        [
            ("id", pa.string()), ("row", pa.int64()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("items", pa.list_(pa.string())), ("longest", pa.int64()),
        ]
    )
    for batch in batches:
        for a, b, data, offsets in W.slices(batch.column(2), SHARD_BYTES):
            ids, rows = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
            found = list(_shard(ids, rows, data, offsets, items))
            yield pa.RecordBatch.from_pylist(found, schema=schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(id, row, n_words, n_hit, spans, items, longest) for every row of ``docs``.

    Each shard of a few MB of whole documents gets a suffix array; the start of every
    test suffix of ``window`` words is binary-searched in it. ``spans`` are the word
    ranges inside any occurrence, ``n_hit`` their length, ``items`` the sorted ids of the
    items that occur, ``longest`` the longest verbatim match. ``row`` is a hash of id and
    text. Benchmark items are read in blocks of ``BLOCK_BYTES`` of text, or of one longer item;
    a block is broadcast and searched in a pass of its own, one block is held at a time, and
    the passes' spans are united; so any number of items is searched in full.

    An item of fewer words is one window; one without words, or null, occurs nowhere. An item
    without id counts for spans and ``n_hit`` and is in no list of items.
    Null and empty texts have no words and no hits. Matches do not cross documents. Rows
    repeated under one id, or without id, are searched one by one. Items that share an
    id count as one. Without items nothing is hit; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("string").alias("id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"),
    )
    if window > SuffixArray.REACH:
        raise ValueError(f"suffixes are sorted by {SuffixArray.REACH} words, a window of {window} is longer")
    scratch = Scratch(spark, "decontam")
    items = benchmark.select(F.col(item_id_col).cast("string").alias("i"), F.col(item_text_col).alias("t"))
    items = items.filter("t is not null").withColumns({"_row": F.monotonically_increasing_id(), "_size": F.octet_length("t")})
    dealt, blocks = bounded_blocks(scratch.put("items", items), "_size", BLOCK_BYTES)
    passes = []
    for k, (bucket, piece) in enumerate(blocks or [(0, 0)]):
        mine = dealt.filter((F.col("_bucket") == bucket) & (F.col("_piece") == piece)).select("i", "t").collect()
        test = spark.sparkContext.broadcast(TestItems([r["i"] for r in mine], [r["t"] for r in mine], window))
        one = rows.mapInArrow(lambda it, test=test: _search(it, test), HITS)
        if len(blocks) > 1:  # written at once, so that one block is held at a time
            one = scratch.put(f"pass{k}", one)
            test.destroy()
        passes.append(one)
    found = passes[0]
    for one in passes[1:]:
        found = found.union(one)
    if len(passes) > 1:
        found = _united(found, len(passes))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["stop"] - x["start"])
    return found.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "row", "n_words",
        n_hit.alias("n_hit"), "spans", F.array_sort(F.array_distinct("items")).alias("items"), "longest",
    )


def _united(found: DataFrame, passes: int) -> DataFrame:
    """One row a document from one per pass; identical rows come back as often as they were given."""
    both = F.array_sort(F.flatten(F.collect_list("spans")))
    one = found.groupBy("id", "row").agg(
        F.first("n_words").alias("n_words"), both.alias("all"),
        F.flatten(F.collect_list("items")).alias("items"), F.max("longest").alias("longest"),
        (F.count(F.lit(1)) / passes).cast("int").alias("times"),
    )
    # walk the sorted spans; the last one of the list is still growing
    merged = F.aggregate(
        "all", F.slice("all", 1, 0),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.get(done, F.size(done) - 1)["start"].alias("start"),
                    F.greatest(F.get(done, F.size(done) - 1)["stop"], x["stop"]).alias("stop"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    one = one.withColumn("spans", merged).withColumn("times", F.explode(F.sequence(F.lit(1), "times")))
    return one.drop("all", "times")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item; columns as they were.

    Null and empty texts stay. Rows that are the same in id and text go together. An empty table
    gives an empty table.
    """
    found = contamination(docs, benchmark, id_col, text_col, **options)
    bad = found.filter("n_hit > 0").select(F.col("row").alias("_row"), F.col(id_col).alias("_id"))
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.join(bad, (row == bad["_row"]) & docs[id_col].eqNullSafe(bad["_id"]), "left_anti")
