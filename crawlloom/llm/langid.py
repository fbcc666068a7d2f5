"""Language identification: the family first, then one-versus-one machines inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm import words as W
from crawlloom.llm.svm import linear_svm, sigmoid

#: Languages by family. Fixed values; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "celtic": "ga gd cy br".split(),
    "turkic": "tr az kk ky uz tt tk".split(),
    "semitic": "ar he mt am".split(),
    "indic": "hi mr ne bn gu pa or as si ur sa".split(),
    "dravidian": "ta te kn ml".split(),
    "iranian": "fa ps ku tg".split(),
    "austronesian": "id ms jv tl mg".split(),
}
UNKNOWN = "und"
#: Texts a language may have in the training sample; texts longer than this are not drawn.
SAMPLE_PER_LANG, SAMPLE_BYTES = 600, 20_000
BITS = 13

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed three-byte sequences at each place, and whether to count them.

    A-Z are a-z and other ASCII characters are one blank; runs of blanks do not count.
    Before and behind every text stands a blank, whatever its neighbours are.
    """
    b = _FOLD[data].astype(np.uint32)
    before, after = np.full(len(b), 32, dtype=np.uint32), np.full(len(b), 32, dtype=np.uint32)
    before[1:], after[:-1] = b[:-1], b[1:]
    before[offsets[:-1][offsets[:-1] < len(b)]] = 32
    after[offsets[1:][offsets[1:] > 0] - 1] = 32
    h = (before << np.uint32(16)) | (b << np.uint32(8)) | after
    return (h * np.uint32(2654435761)) >> np.uint32(32 - BITS), b != 32


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))


def _wide_letter(text: str) -> bool:
    """Whether a text without a-z has a letter of another script."""
    return any(c.isalpha() for c in text)


@dataclass
class Model:
    langs: list[str]
    families: list[str]
    #: rows of weights over the hashed features, with offsets
    weights: np.ndarray
    offsets: np.ndarray
    #: (first, second, row) of the machines between families, and of those inside each
    between: list[tuple[str, str, int]]
    inside: dict[str, list[tuple[str, str, int]]]

    def _vote(self, names: list[str], machines, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Winner of the one-versus-one votes per row, and the chance of it; ties by summed margin."""
        n = margins.shape[0]
        score, place = np.zeros((n, len(names))), {x: i for i, x in enumerate(names)}
        chance = np.ones((n, len(names)))
        for a, b, row in machines:
            p = sigmoid(4.0 * margins[:, row])
            for x, q in ((place[a], p), (place[b], 1 - p)):
                score[:, x] += (q > 0.5) + 1e-3 * q
                chance[:, x] = np.minimum(chance[:, x], q)
        best = score.argmax(axis=1)
        return [names[i] for i in best], chance[np.arange(n), best]

    def predict(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(margins), np.zeros(len(margins))
        family, sure = self._vote(self.families, self.between, margins)
        lang, chance = list(family), sure.copy()
        for name in self.families:
            rows = np.array([i for i, f in enumerate(family) if f == name], dtype=int)
            mine = [x for x in self.langs if family_of(x) == name]
            if len(rows):
                got, p = self._vote(mine, self.inside[name], margins[rows])
                for i, g in zip(rows, got, strict=True):
                    lang[i] = g
                chance[rows] *= p
        return lang, chance


def _counts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, _, data, offsets in W.slices(batch.column(1)):
            h, counted = _features(data, offsets)
            for s, e in zip(offsets[:-1], offsets[1:], strict=True):
                n = np.bincount(h[s:e][counted[s:e]], minlength=1 << BITS)
                at = np.flatnonzero(n)
                rows.append(at.astype(np.int32).tobytes() + n[at].astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, type=pa.binary())], names=["lang", "counts"])


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = SAMPLE_PER_LANG,
) -> Model:
    """Fit on about ``per_lang`` texts a language, drawn by a hash of id and text.

    The sample is the only thing that reaches the driver: about that many texts of
    ``SAMPLE_BYTES`` bytes a language, never more than twice as many in all, as counts of
    hashed features. Rows without text or
    language teach nothing; a model that has learned no language finds every text ``und``.
    """
    short = F.octet_length(text_col).between(1, SAMPLE_BYTES)
    rows = labelled.filter(F.col(lang_col).isNotNull() & short)
    sizes = {r[lang_col]: r["n"] for r in rows.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], [], np.zeros((0, 1 << BITS), dtype=np.float32), np.zeros(0), [], {})
    draw = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_lang / n))])
    sample = rows.filter(draw <= share[F.col(lang_col)]).select(lang_col, text_col)
    counts = sample.mapInArrow(_counts, "lang string, counts binary")
    # rows that are the same in id and text are drawn together; the limit holds for them too
    got = sorted(counts.limit(2 * per_lang * len(sizes)).collect())
    x = np.zeros((len(got), 1 << BITS), dtype=np.float32)
    y = np.array([r["lang"] for r in got])
    for i, r in enumerate(got):
        at, n = np.frombuffer(r["counts"], dtype=np.int32).reshape(2, -1)
        x[i, at] = n / max(1, n.sum())
    # rare and frequent sequences get a like say; folded into the weights afterwards
    scale = 1.0 / (np.sqrt((x * x).mean(axis=0)) + 1e-3)
    x *= scale
    norm = float(np.sqrt((x * x).sum(axis=1).mean())) or 1.0
    x /= norm
    langs = sorted(sizes)
    families = sorted({family_of(v) for v in langs})
    of_family = np.array([family_of(v) for v in y])
    rows_, offsets, between, inside = [], [], [], {f: [] for f in families}

    def fit(labels, a, b, into):
        at = (labels == a) | (labels == b)
        w, c = linear_svm(x[at], np.where(labels[at] == a, 1.0, -1.0), 1e-3, 200)
        into.append((a, b, len(rows_)))
        rows_.append(w * scale / norm)
        offsets.append(c)

    for a, b in combinations(families, 2):
        fit(of_family, a, b, between)
    for f in families:
        for a, b in combinations([v for v in langs if family_of(v) == f], 2):
            fit(y, a, b, inside[f])
    weights = np.array(rows_, dtype=np.float32).reshape(len(rows_), 1 << BITS)
    return Model(langs, families, weights, np.array(offsets), between, inside)


def _predict(batches, shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        langs, scores = [], []
        for a, b, data, offsets in W.slices(batch.column(1)):
            h, counted = _features(data, offsets)
            total = np.concatenate([[0], np.cumsum(counted)])
            n = np.maximum(1, np.diff(total[offsets]))
            h = h[counted]
            at = total[offsets]
            margins = np.empty((b - a, len(model.weights)))
            for k, w in enumerate(model.weights):
                sums = np.concatenate([[0.0], np.cumsum(w[h], dtype=np.float64)])
                margins[:, k] = np.diff(sums[at]) / n + model.offsets[k]
            lang, score = model.predict(margins)
            plain = np.concatenate([[0], np.cumsum(_letters(data))])
            for i in np.flatnonzero(np.diff(plain[offsets]) == 0):
                if not _wide_letter(batch.column(1)[a + int(i)].as_py() or ""):
                    lang[i], score[i] = UNKNOWN, 0.0
            langs += lang
            scores += score.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())],
            names=["id", "lang_pred", "score"],
        )


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``, from its whole text only.

    ``score`` is the least chance the winner has against a family or a language, between
    0 and 1. Null, empty and letterless texts are ``und`` with score 0. Rows repeated
    under one id, or without id, each come back. An empty table gives an empty table.
    Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(
        lambda it: _predict(it, shared), f"id {kind}, lang_pred string, score double"
    ).withColumnRenamed("id", id_col)
