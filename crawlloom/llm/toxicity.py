"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear machine.

The kernel of two words counts the subsequences of three symbols they share, each
weighted by DECAY for every symbol it spans, spans of at most SPAN. Gaps and inserted
characters so cost weight but do not break a match. A word is divided by the norm that
depends on its length only, which keeps the kernel positive and lets a model over
landmarks be folded into one weight per subsequence: scoring is then a sum over places.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.svm import linear_svm, logistic_scale, sigmoid

#: Texts of each class in the training sample; longer texts are not drawn.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1500, 20_000
LANDMARKS, ROUNDS, SEED = 600, 6, 5
#: Regularisation and steps of the machine, and the share of the insults in its loss.
REG, STEPS, INSULT_SHARE = 1e-6, 800, 0.6
#: Times as frequent in toxic texts as in clean ones that a sure insult is, and how much its odd
#: copies together weigh beside it.
SURE_ODDS, ODD_WEIGHT = 300, 10.0
#: The working set: clean words and odd copies of an insult it starts with, and how many of the
#: worst join in each round, out of all words of the sample and all odd copies.
FIRST_CLEAN, WORST, FIRST_ODD, WORST_ODD = 6000, 1500, 40, 30
DECAY, SPAN = 0.7, 5
#: Padding between words: with end and start it keeps a span out of the next word's letters.
PAD = 1
#: Symbols: 0 padding, 1-26 a-z, 27 and 28 other letters, 29 start and 30 end of a word.
_N, _START, _END = 31, 29, 30
#: (second, third) place after the first, within SPAN symbols.
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
#: Digits and signs that stand for letters. Fixed values.
_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_GAP, _BLANK, _OTHER = 60, 61, 62


def _symbol(c: str) -> int:
    if c.isspace():
        return _BLANK
    if c in _LOOKALIKES:
        return ord(_LOOKALIKES[c]) - 96
    base = unicodedata.normalize("NFD", c.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + ord(c) % 2 if c.isalpha() else _GAP


_TABLE = np.array([_symbol(chr(i)) for i in range(0x250)] + [_OTHER], dtype=np.uint8)


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the words of a text, each with start, end and padding, and the word starts.

    Words are split at blanks; other signs between letters are dropped, so i-d-i-o-t and
    idi.ot are one word each. Three or more single letters in a row are joined.
    """
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    sym = _TABLE[np.minimum(cp, len(_TABLE) - 1)]
    wide = np.flatnonzero(sym == _OTHER)
    if len(wide):
        letters = {u: chr(u).isalpha() for u in np.unique(cp[wide]).tolist()}
        sym[wide] = [27 + u % 2 if letters[u] else _GAP for u in cp[wide].tolist()]
    keep = sym != _GAP
    sym = sym[keep]
    blank = sym == _BLANK
    first = ~blank
    first[1:] &= blank[:-1]
    letters = sym[~blank]
    start = np.flatnonzero(first[~blank])
    if not len(start):
        return np.zeros(0, dtype=np.int32), start
    size = np.diff(np.append(start, len(letters)))
    single = np.concatenate([[False], size == 1, [False]]).astype(np.int8)
    turn = np.flatnonzero(np.diff(single))
    for a, b in zip(turn[::2], turn[1::2], strict=True):
        if b - a >= 3:
            start[a + 1 : b] = -1
    start = start[start >= 0]
    size = np.diff(np.append(start, len(letters)))
    # layout of a word: start, letters, end, padding
    place = start + np.arange(len(start)) * (2 + PAD)
    out = np.zeros(len(letters) + len(start) * (2 + PAD) + SPAN, dtype=np.int32)
    out[place] = _START
    out[np.arange(len(letters)) + np.repeat(np.arange(len(start)) * (2 + PAD) + 1, size)] = letters
    out[place + size + 1] = _END
    return out, place


def _strings(sym: np.ndarray, place: np.ndarray) -> list[bytes]:
    raw = sym.astype(np.uint8).tobytes()
    return [raw[a + 1 : raw.index(_END, a)] for a in place.tolist()]


def _places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [bytes([_START]) + w + bytes([_END]) + bytes(PAD) for w in words]
    sizes = np.array([len(p) for p in parts])
    sym = np.frombuffer(b"".join(parts) + bytes(SPAN), dtype=np.uint8).astype(np.int32)
    return sym, np.cumsum(sizes) - sizes


def _subsequences(sym: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    n = len(sym) - SPAN + 1
    for i, j in _STEPS:
        yield (sym[:n] * _N + sym[i : n + i]) * _N + sym[j : n + j], DECAY ** (j + 1)


def _valid() -> np.ndarray:
    """Which subsequences count: padding nowhere, a start only first, an end only last."""
    a = np.arange(_N**3)
    x, y, z = a // _N**2, a // _N % _N, a % _N
    return (x > 0) & (y > 0) & (z > 0) & (x != _END) & (y != _END) & (y != _START) & (z != _START)


def _norms(most: int) -> np.ndarray:
    """Norm of a word by its number of symbols, start and end included."""
    n = np.arange(most + 1)
    square = sum(np.maximum(0, n - j) * DECAY ** (2 * (j + 1)) for _, j in _STEPS)
    return np.sqrt(np.maximum(square, DECAY**6))


def _sums(values_at, sym: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Per word, the sum over its subsequences of ``values_at(code)``, over its norm."""
    total = None
    for code, weight in _subsequences(sym):
        v = values_at(code) * weight
        total = v if total is None else total + v
    sums = np.add.reduceat(total, place, axis=0)
    length = np.diff(np.append(place, len(sym) - SPAN)) - PAD
    norm = _norms(int(length.max()))[length]
    return sums / (norm[:, None] if sums.ndim == 2 else norm)


@dataclass
class Model:
    #: one weight per subsequence, the offset, and the logistic scale of a text's best word
    theta: np.ndarray
    offset: float
    scale: tuple[float, float]

    @classmethod
    def of(cls, row) -> Model:
        return cls(np.frombuffer(bytes(row["theta"]), dtype=np.float32), row["offset"], (row["a"], row["b"]))

    def words(self, sym: np.ndarray, place: np.ndarray) -> np.ndarray:
        return _sums(lambda code: self.theta[code], sym, place) + self.offset

    def text(self, text: str | None) -> float:
        """Score of the worst word of a text, cut into pieces at word starts."""
        sym, place = _tokens(text or "")
        if not len(place):
            return -2.0
        best, step = -2.0, 1 << 13
        for i in range(0, len(place), step):
            part = place[i : i + step]
            end = place[i + step] if i + step < len(place) else len(sym) - SPAN
            piece = np.concatenate([sym[part[0] : end], np.zeros(SPAN, dtype=np.int32)])
            best = max(best, float(self.words(piece, part - part[0]).max()))
        return best

    def chance(self, score):
        return sigmoid(self.scale[0] * np.asarray(score) + self.scale[1])


def _landmark_map(landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence weights of each landmark (codes x landmarks), and the Nyström root."""
    valid, cols = _valid(), np.zeros((_N**3, len(landmarks)), dtype=np.float32)
    for m, word in enumerate(landmarks):
        sym, place = _places([word])
        for code, weight in _subsequences(sym):
            np.add.at(cols[:, m], code, weight)
        cols[:, m] /= _norms(len(word) + 2)[len(word) + 2]
    cols[~valid] = 0
    gram = cols.T @ cols
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    inverse = np.where(values > 1e-4, 1 / np.sqrt(np.maximum(values, 1e-4)), 0.0)
    return cols, (vectors * inverse) @ vectors.T


def _kernel(words: list[bytes], cols: np.ndarray) -> np.ndarray:
    """Words x landmarks, a few words at a time: each place takes a row of all landmarks."""
    out = np.empty((len(words), cols.shape[1]), dtype=np.float32)
    for i in range(0, len(words), 200):
        sym, place = _places(words[i : i + 200])
        out[i : i + len(place)] = _sums(lambda code: cols[code], sym, place)
    return out


def odd_copies(word: bytes) -> list[bytes]:
    """A word with any one letter put in between two of its own, or one of its own said twice."""
    put = [word[:a] + bytes([k]) + word[a:] for a in range(1, len(word)) for k in range(1, 27)]
    return list(dict.fromkeys(put + [word[:a] + word[a : a + 1] + word[a:] for a in range(len(word))]))


def _texts_with(bags: list[np.ndarray], groups: np.ndarray, n_words: int) -> np.ndarray:
    """How many groups of texts hold each word."""
    base = int(groups.max(initial=0)) + 1
    pairs = [b * base + g for b, g in zip(bags, groups.tolist(), strict=True)]
    held = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *pairs]))
    return np.bincount(held // base, minlength=n_words)


def _by_chance(hit: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
    """Chance that of ``total`` texts at least ``hit`` are toxic when ``share`` of all are."""
    log = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, int(total.max(initial=0)) + 1)))])
    out = np.ones(len(hit))
    for i in np.flatnonzero(hit).tolist():
        n, k = int(total[i]), np.arange(int(hit[i]), int(total[i]) + 1)
        out[i] = np.exp(log[n] - log[k] - log[n - k] + k * np.log(share) + (n - k) * np.log1p(-share)).sum()
    return out


def _fit(texts: list[bytes], labels: np.ndarray, weights: tuple[float, float], seed: int) -> Model:
    """Learn which words make a text toxic, and how they look with a slip.

    ``texts`` hold the distinct words of a text, joined by zero bytes. A word is sure to be an
    insult when it is in far more toxic texts than chance allows, copies of a text counted
    once. Every other toxic text has one word, at first unknown, that makes it so. Copies of the
    sure words with one letter too many are insults as well. The machine is trained on a
    working set: all insults, the most frequent clean words, some odd copies; every round
    scores all words and all odd copies, and those on the wrong side come in.
    """
    rng = np.random.default_rng(seed)
    every = sorted({w for t in texts for w in t.split(b"\0") if w})
    number = {w: i for i, w in enumerate(every)}
    bags = [np.array([number[w] for w in t.split(b"\0") if w], dtype=np.int64) for t in texts]
    del number
    # copies of a text mostly have the same least word, by an order drawn once
    order = rng.permutation(len(every))
    least = np.array([order[b].min() if len(b) else 0 for b in bags])
    groups = np.unique(least, return_inverse=True)[1]
    hit, miss = (_texts_with([b for b, y in zip(bags, labels, strict=True) if y == k], groups[labels == k], len(every)) for k in (1, 0))
    n1, n0 = (max(1, len(np.unique(groups[labels == k]))) for k in (1, 0))
    odds = np.log((hit + 0.1) / n1) - np.log((miss + 0.1) / n0)
    sure = np.flatnonzero((odds > np.log(SURE_ODDS)) & (_by_chance(hit, hit + miss, n1 / (n1 + n0)) < 1 / max(1, len(every))))
    insults, known = [every[i] for i in sure], set(sure.tolist())
    unsure = [b for b, y in zip(bags, labels, strict=True) if y and len(b) and known.isdisjoint(b.tolist())]
    likely = odds * np.log1p(hit)
    guess = np.unique([int(b[np.argmax(likely[b])]) for b in unsure]).astype(np.int64)
    common = np.argsort(-miss, kind="stable")[: int((miss > 0).sum())]
    clean = common[:FIRST_CLEAN]
    odd = {w: odd_copies(w) for w in insults}
    work = {w: [o[i] for i in rng.permutation(len(o))[:FIRST_ODD]] for w, o in odd.items()}

    strange = [o for w in insults for o in work[w][:8]][: LANDMARKS // 3]
    guesses = [every[i] for i in guess[np.argsort(-hit[guess], kind="stable")]][: LANDMARKS // 4]
    chosen = list(dict.fromkeys(insults + guesses + strange))
    spaced = [every[i] for i in clean[:: max(1, len(clean) // max(1, LANDMARKS - len(chosen)))]]
    cols, root = _landmark_map(list(dict.fromkeys(chosen + spaced))[:LANDMARKS])
    model, score = None, np.zeros(len(every))

    def scores(words: list[bytes]) -> np.ndarray:
        parts = [words[i : i + (1 << 13)] for i in range(0, len(words), 1 << 13)]
        return np.concatenate([model.words(*_places(p)) for p in parts]) if parts else np.zeros(0)

    for _ in range(ROUNDS):
        bad = [(w, hit[i]) for i, w in zip(sure, insults, strict=True)] + [(every[i], hit[i]) for i in guess]
        bad += [(o, ODD_WEIGHT * hit[i] / len(work[w])) for i, w in zip(sure, insults, strict=True) for o in work[w]]
        words = [w for w, _ in bad] + [every[i] for i in clean]
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(clean))])
        up, down = np.array([n for _, n in bad], dtype=float), miss[clean] ** 0.5
        weight = np.concatenate([INSULT_SHARE * up / max(1e-9, up.sum()), (1 - INSULT_SHARE) * down / max(1e-9, down.sum())])
        w, offset = linear_svm(_kernel(words, cols) @ root.astype(np.float32), y, REG, STEPS, weight)
        model = Model((cols @ (root @ w)).astype(np.float32), offset, (1.0, 0.0))
        score = scores(every)
        best = np.unique([int(b[np.argmax(score[b])]) for b in unsure]).astype(np.int64)
        guess = best[(score[best] > -0.5) & (odds[best] > 0)] if len(best) else best
        clean = np.unique(np.concatenate([clean, common[np.argsort(-score[common], kind="stable")[:WORST]]]))
        for w, copies in odd.items():
            lowest = np.argsort(scores(copies), kind="stable")[:WORST_ODD]
            work[w] = list(dict.fromkeys(work[w] + [copies[i] for i in lowest]))
    tops = np.array([score[b].max() if len(b) else -2.0 for b in bags])
    y, weight = labels.astype(float), np.where(labels > 0, weights[1], weights[0])
    # a text whose one insult has a slip is as toxic: together they count as much as the toxic texts
    slips = [scores(odd[w]) for w in insults]
    each = [np.full(len(x), weight[labels > 0].sum() * hit[i] / hit[sure].sum() / len(x)) for i, x in zip(sure, slips, strict=True)]
    tops, weight = np.concatenate([tops, *slips]), np.concatenate([weight, *each])
    model.scale = logistic_scale(tops, np.concatenate([y, np.ones(len(tops) - len(y))]), weight)
    return model


def _word_sets(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [b"\0".join(sorted(set(_strings(*_tokens(t.as_py()))))) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(words, type=pa.binary()), batch.column(1)], names=["words", "label"])


FITTED = "theta binary, offset double, a double, b double"


def _fitted(batches, sizes: dict[int, int], seed: int) -> Iterator[pa.RecordBatch]:
    """The model of a whole sample, as one row."""
    got = sorted((bytes(r["words"]), r["label"]) for batch in batches for r in batch.to_pylist())
    if got:
        found = np.array([label for _, label in got])
        weights = tuple(sizes[k] / max(1, int((found == k).sum())) for k in (0, 1))
        model = _fit([t for t, _ in got], found, weights, seed)
        row = {"theta": model.theta.tobytes(), "offset": model.offset, "a": model.scale[0], "b": model.scale[1]}
        schema = pa.schema([("theta", pa.binary()), ("offset", pa.float64()), ("a", pa.float64()), ("b", pa.float64())])
        yield pa.RecordBatch.from_pylist([row], schema)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
    seed: int = SEED,
) -> Model:
    """Fit on about ``per_class`` texts of each label, drawn by a hash of the id.

    ``labels`` (id, label) names the rows to learn from. The draw is made on ids and
    lengths; only the drawn ids, four times ``per_class`` rows at most, are broadcast to
    the texts. The sample, as many sets of words of texts of at most ``SAMPLE_CHARS``
    characters, is fitted in one task; the weights alone come back. Chances are scaled to the shares the labels have in
    all labelled rows. Rows without text or with another label than 0 and 1 teach nothing.
    Without texts of both labels every text scores 1 or, without any, 0.
    """
    lengths = docs.select(F.col(id_col).alias("_id"), F.char_length(text_col).alias("_len"))
    label = labels.select(F.col(id_col).alias("_of"), F.col(label_col).cast("int").alias("label"))
    rows = lengths.filter(F.col("_len").between(1, SAMPLE_CHARS)).join(label.filter(F.col("label").isin(0, 1)), F.col("_id") == F.col("_of"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:  # nothing to tell apart: every text gets the share of toxic labels
        return Model(np.zeros(_N**3, dtype=np.float32), 0.0, (0.0, 40.0 if 1 in sizes else -40.0))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.when(F.col("label") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    drawn = rows.filter(draw <= share).select("_id", "label").distinct().limit(4 * per_class)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    sample = texts.join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).select("_text", "label")
    sets = sample.mapInArrow(_word_sets, "words binary, label int").limit(4 * per_class)
    return Model.of(sets.mapInArrow(lambda it: _fitted(it, sizes, seed), FITTED).first())


def _score(batches, shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        best = [model.text(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(model.chance(best), type=pa.float64())], names=["id", "score"]
        )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``: the chance that its worst word makes it toxic.

    Null and empty texts, and texts without letters, get the score of a text whose worst
    word is far from the margin. Rows repeated under one id, or without id, each come
    back. An empty table gives an empty table. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(
        lambda it: _score(it, shared), f"id {kind}, score double"
    ).withColumnRenamed("id", id_col)


def _keep(batches, shared, at: int, least: float) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        chance = model.chance([model.text(t.as_py()) for t in batch.column(at)])
        yield batch.filter(pa.array(chance < least))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; one pass, no shuffle of the texts.

    Null and empty texts stay. Repeated rows, and rows without id, are judged one by one. An
    empty table gives an empty table. Columns are as they were.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _keep(it, shared, at, least), docs.schema)
