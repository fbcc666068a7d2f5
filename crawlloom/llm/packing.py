"""Packing documents into training windows, by sums of squares over fill levels.

Sum-of-squares packing (Csirik et al., "On the Sum-of-Squares Algorithm for Bin Packing",
2006): the next document goes to the fill level that leaves the squared numbers of partially
filled windows, summed over all levels, least. Only an array of windows per level is looked
at. Every task packs its own rows, so nothing is shuffled and nothing grows with the input.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.words import SLICE_BYTES

CAPACITY, END = 2048, 1
#: Open windows of a task before they are poured together; each holds less than a window of ids.
MOST_OPEN = 4096
#: Words whose ids a Python worker remembers, and the longest of them. Others are encoded again.
CACHED_WORDS, CACHED_BYTES = 500_000, 64
#: Signs that often stand behind a word.
SIGNS = ".,;:!?"
#: Pieces of one Arrow batch.
BATCH_PIECES = 8192


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of whole columns of texts; every distinct word is encoded once.

    For vocabularies whose merges never reach over a blank and that drop blanks: the ids of
    a text are then those of its words, one after the other.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model, self.table = self.tokenizer.model, self._letters()
        odd = [chr(c) for c in range(0x250) if chr(c).isalpha() and c not in self.table]
        self.odd = re.compile(f"[{''.join(odd)}]" if odd else r"(?!)")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _letters(self) -> dict[int, str]:
        """What the steps before the model make of each Latin letter, when they treat letters one by one.

        Empty when they do not part letters from the signs behind them.
        """
        t = self.tokenizer
        if not (t.normalizer and t.pre_tokenizer) or any(a.content.isalpha() for a in t.get_added_tokens_decoder().values()):
            return {}
        if [p for p, _ in self._prepared(f"aZ{SIGNS}")] != ["az", SIGNS]:
            return {}
        one = {c: self._prepared(chr(c)) for c in range(0x250) if chr(c).isalpha()}
        return {c: found[0][0] for c, found in one.items() if len(found) == 1}

    def _prepared(self, word: str) -> list:
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word))

    def _encode(self, part: str) -> list[int]:
        """Ids of a word, straight from the model where it is of Latin letters alone."""
        if self.table and part.isalpha() and max(part) < "\u0250" and not self.odd.search(part):
            return [x.id for x in self.model.tokenize(part.translate(self.table))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _number(self, words: list[str]) -> np.ndarray:
        """The number of each word in ``ends``; new ones are encoded."""
        number, new = self.number, [w for w in words if w not in self.number]
        found = [np.array(self._encode(w), dtype=np.uint32).tobytes() for w in new]
        number.update(zip(new, range(len(self.ends) - 1, len(self.ends) - 1 + len(new)), strict=True))
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), dtype=np.uint32)])
        return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))

    def _numbers(self, col: pa.Array) -> np.ndarray:
        coded = col.dictionary_encode()
        return self._number(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]

    def texts(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of ids of each."""
        if len(self.number) > CACHED_WORDS:
            self.clear()
        words = pc.ascii_split_whitespace(col)
        coded = words.flatten().dictionary_encode()
        own = coded.dictionary
        # words that differ only by the signs behind them are encoded once
        signed = pc.match_substring_regex(own, f"[A-Za-zÀ-ÖØ-öø-ɏ][{SIGNS}]+$") if self.table else pa.array([False] * len(own))
        bodies = pc.if_else(signed, pc.utf8_rtrim(own, SIGNS), own)
        signs = pc.if_else(signed, pc.replace_substring_regex(own, f"(?s)^.*[^{SIGNS}]", ""), "")
        which = coded.indices.to_numpy(zero_copy_only=False)
        # a word is two runs of ids, its body's and its signs'
        run = np.stack([self._numbers(bodies)[which], self._numbers(signs)[which]], axis=1).ravel()
        first, size = self.ends[run], self.ends[run + 1] - self.ends[run]
        total = np.concatenate([[0], np.cumsum(size)])
        out = self.ids[np.repeat(first - total[:-1], size) + np.arange(total[-1])]
        if pc.any(pc.greater(pc.binary_length(bodies), CACHED_BYTES)).as_py():
            for w in bodies.filter(pc.greater(pc.binary_length(bodies), CACHED_BYTES)).to_pylist():
                self.number.pop(w, None)
        edges = total[2 * (words.offsets.to_numpy() - words.offsets[0].as_py())]
        return out, np.diff(edges)


_encoders: dict[int, WordEncoder] = {}


def _encoder(vocabulary: str) -> WordEncoder:
    """The encoder of this Python worker, which serves many tasks."""
    key = zlib.crc32(vocabulary.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(vocabulary)
    return _encoders[key]


class Piece:
    """``ids`` of one document from its ``start``-th on; ``total`` is the document's number."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total


class Levels:
    """Open windows by fill level, and the level array that says where the next piece goes."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        self.open = 0
        # what the sum of squares gains when a window comes to a level, and when one leaves it;
        # a full window does not count, and a new one leaves no level
        self.enter = np.ones(capacity + 1, dtype=np.int64)
        self.enter[capacity] = 0
        self.leave = np.full(capacity + 1, np.iinfo(np.int64).max // 4, dtype=np.int64)
        self.leave[0] = 0
        self.empty = int(self.leave[-1])

    def _count(self, level: int, change: int) -> None:
        self.open += change
        n = len(self.windows[level])
        self.enter[level] = 2 * n + 1
        self.leave[level] = 1 - 2 * n if n else self.empty

    def level_for(self, size: int) -> int:
        """The level whose use leaves the least sum of squares; of equals the fullest; 0 is a new window."""
        last = self.capacity - size
        change = self.enter[size:] + self.leave[: last + 1]
        return last - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> list[Piece] | None:
        """Place a piece; the window it fills, if it does."""
        size = len(piece.ids)
        level = self.level_for(size)
        window = []
        if level:
            window = self.windows[level].pop()
            self._count(level, -1)
        window.append(piece)
        return self._put(window, level + size)

    def _put(self, window: list[Piece], level: int) -> list[Piece] | None:
        if level == self.capacity:
            return window
        self.windows[level].append(window)
        self._count(level, 1)
        return None

    def pour(self) -> list[list[Piece]]:
        """Fill the fullest windows from the emptiest, cutting where one is full; one at most stays open."""
        queue = [w for level in reversed(self.windows) for w in level]
        for level in range(1, self.capacity):
            if self.windows[level]:
                self.open -= len(self.windows[level])
                self.windows[level] = []
                self._count(level, 0)
        full, i, j = [], 0, len(queue) - 1
        free = [self.capacity - sum(len(p.ids) for p in w) for w in queue]
        while i < j:
            piece = queue[j].pop()
            take = min(free[i], len(piece.ids))
            rest = len(piece.ids) - take
            queue[i].append(Piece(piece.doc, piece.start + rest, piece.ids[rest:], piece.total))
            if rest:
                queue[j].append(Piece(piece.doc, piece.start, piece.ids[:rest], piece.total))
            free[i] -= take
            free[j] += take
            if not free[i]:
                full.append(queue[i])
                i += 1
            if i < j and not queue[j]:
                j -= 1
        if i == j and queue[j]:
            done = self._put(queue[j], self.capacity - free[j])
            full += [done] if done else []
        return full

    def tail(self) -> list[list[Piece]]:
        """What is open after ``pour``, cut into sequences whose lengths are powers of two."""
        rest = [p for level in self.windows for w in level for p in w]
        left, out = sum(len(p.ids) for p in rest), []
        while left:
            want = 1 << (left.bit_length() - 1)
            left -= want
            part = []
            while want:
                piece = rest.pop(0)
                part.append(Piece(piece.doc, piece.start, piece.ids[:want], piece.total))
                if len(piece.ids) > want:
                    rest.insert(0, Piece(piece.doc, piece.start + want, piece.ids[want:], piece.total))
                want -= len(part[-1].ids)
            out.append(part)
        return out


def _slices(col: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of a few MB of text, or of one longer text."""
    ends = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False)) if len(col) else []
    a = 0
    while a < len(col):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield a, b
        a = b


def _pack(batches, shared, capacity: int, end: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoder, levels = _encoder(shared.value), Levels(capacity)
    number = TaskContext.get().partitionId() << 32
    rows: list[list] = [[] for _ in schema]

    def emit(window: list[Piece]) -> None:
        nonlocal number
        offset = 0
        for p in window:
            ids = np.ascontiguousarray(p.ids, dtype="<u4")
            full = [p.doc, p.start, len(ids), zlib.crc32(ids), p.total, number, offset, ids]
            for column, value in zip(rows, full):
                column.append(value)
            offset += len(ids)
        number += 1

    def batch_of() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)
        for column in rows:
            column.clear()
        return out

    for batch in batches:
        col = batch.column(1).cast(pa.large_string()).fill_null("")
        for a, b in _slices(col):
            ids, counts = encoder.texts(col.slice(a, b - a))
            last = np.cumsum(counts)
            for doc, stop, n in zip(batch.column(0).slice(a, b - a).to_pylist(), last.tolist(), counts.tolist(), strict=True):
                own = np.append(ids[stop - n : stop], np.uint32(end))
                whole = (n + 1) // capacity * capacity
                for start in range(0, whole, capacity):
                    emit([Piece(doc, start, own[start : start + capacity], n + 1)])
                if n + 1 > whole:
                    done = levels.add(Piece(doc, whole, own[whole:].copy(), n + 1))
                    if done:
                        emit(done)
                    elif levels.open > MOST_OPEN:
                        for window in levels.pour():
                            emit(window)
                if len(rows[0]) >= BATCH_PIECES:
                    yield batch_of()
    for window in levels.pour():
        emit(window)
    for window in levels.tail():
        emit(window)
    yield batch_of()


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = True,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): a row for each piece.

    A document is the ids of its text by the tokenizer file ``vocabulary`` and ``end``
    after them. What is longer than a window is cut into full windows and a rest. Rests
    and shorter documents stay whole while the level array places them, in the order of
    the rows. At the end of a task, and whenever more than ``MOST_OPEN`` windows are open,
    the emptiest windows are poured into the fullest and documents are cut at their ends;
    the one window a task has left is cut into sequences whose lengths are powers of two,
    which need no padding. So every sequence has ``capacity`` ids or a power of two.

    ``offset`` is the place in the sequence, without gaps from 0. ``sequence_id`` counts
    the sequences of a partition above its number times 2^32. ``vocabulary`` must drop
    blanks and make no token over a blank. Null and empty texts, and texts of blanks, are
    ``end`` alone. Rows repeated under one id, or without id, are packed one by one. An
    empty table gives an empty table. Other columns are not looked at.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    empty = docs.sparkSession.createDataFrame([], ddl + (", ids array<bigint>" if with_ids else ""))
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(empty.schema)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _pack(it, shared, capacity, end, schema), empty.schema)
    return out.withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, docs, pad): the windows themselves, from ``pack`` with ids.

    ``docs`` are the (id, start, length) of the pieces in order, for attention masks. Sequences
    that are no power of two are padded to ``capacity``. A group is one window at most.
    """
    part = F.struct("offset", F.col(id_col).alias("id"), "start", "length", "ids")
    whole = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ids, size = F.flatten("parts.ids"), F.size(F.flatten("parts.ids"))
    full = F.when(F.bit_count(size) == 1, 0).otherwise(capacity - size)
    return whole.select(
        "sequence_id", F.concat(ids, F.array_repeat(F.lit(pad).cast("bigint"), full)).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["id"].alias("id"), p["start"].alias("start"), p["length"].alias("length"))).alias("docs"),
        full.cast("long").alias("pad"),
    )
