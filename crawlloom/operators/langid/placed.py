"""Chunks of whole texts in one pass: their places in the text and their best languages.

The same chunks and sums as ``score_texts`` and ``unit_places`` give, for models without grams
inside words, but a text stays one row until it is chunks: its words are found, looked up and
summed as arrays, a few MB of text at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlloom.operators.langid.dims import SCRIPTS, UNKNOWN, close_set_of
from crawlloom.operators.langid.grams import CHUNK_CJK, CHUNK_WORDS, SPAN_GAP, WORD_LETTERS, kind_numbers, script_number, span_runs
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.langid.score import MAX_GRAMS, MIN_GRAMS

# Rows of a packed table; some 20 bytes a row keep it as far below 1 GB as a broadcast.
PACKED_ROWS = 8_000_000
# Bytes of text that are arrays at a time.
SLICE_BYTES = 4 << 20

_INT, _LONG, _STRING = T.IntegerType(), T.LongType(), T.StringType()
_CHUNK = T.StructType(
    [T.StructField(n, _INT) for n in ("chunk", "first", "start", "stop", "then")]
    + [T.StructField("again", T.ArrayType(_INT)), T.StructField("before", _STRING), T.StructField("lang1", _STRING)]
    + [T.StructField("reliability", _INT), T.StructField("meets", T.BooleanType())]
)
_UNIT = T.StructType([T.StructField("unit", _STRING), T.StructField("start", _INT)])
# a-z and all bytes of other characters: the rest of ASCII stands between words
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


class Packed:
    """A model as arrays: of every gram its rows, and of every row language, weight and rank."""

    def __init__(self, rows: pa.Table, expected: dict[str, int]):
        names = {x for x in rows["lang"].to_pylist() if x is not None}
        self.langs = sorted(names, key=lambda x: x.encode())
        # rows without a language go where the bytes go that none claims
        lang = pc.fill_null(pc.index_in(rows["lang"].combine_chunks(), pa.array(self.langs, pa.string())), len(self.langs))
        gram = rows["gram"].combine_chunks().dictionary_encode()
        gram_no = gram.indices.to_numpy()
        order = np.argsort(gram_no, kind="stable")
        self.lang = lang.to_numpy(zero_copy_only=False).astype(np.int16)[order]
        self.weight = rows["weight"].to_numpy().astype(np.int32)[order]
        self.rank = rows["rank"].to_numpy().astype(np.int32)[order]
        self.count = np.bincount(gram_no, minlength=len(gram.dictionary)).astype(np.int32)
        self.at = np.concatenate([[0], np.cumsum(self.count)[:-1]]).astype(np.int32)
        grams = gram.dictionary
        self.kinds = {}
        for kind in ("w:", "u:", "b:", "d:"):
            own = pc.indices_nonzero(pc.starts_with(grams, kind))
            self.kinds[kind] = (pc.utf8_slice_codeunits(grams.take(own), 2), own.to_numpy().astype(np.int32))
        names, own = self.kinds.pop("d:")
        defaults = dict(zip(names.to_pylist(), own.tolist(), strict=True))
        self.defaults = np.array([defaults.get(s, -1) for s, _, _ in SCRIPTS], np.int32)
        # the languages of a verdict: those of the model, none, and those of scripts
        self.names = sorted({*self.langs, UNKNOWN, *(lang for _, _, lang in SCRIPTS)})
        number = {x: i for i, x in enumerate(self.names)}
        self.name = np.array([number[x] for x in [*self.langs, UNKNOWN]])
        self.script_name = np.array([number[lang] for _, _, lang in SCRIPTS])
        sets = close_set_of()
        self.close = np.array([sets.get(x, -1) for x in self.names])
        self.usual = np.array([expected.get(x) or 0 for x in self.names])

    def find(self, kind: str, grams: pa.Array) -> np.ndarray:
        """The number of each gram, -1 where the model does not know it.

        The model is looked up in the few distinct grams, not these in the model: that needs
        no table of the whole model.
        """
        coded = grams.dictionary_encode()
        names, numbers = self.kinds[kind]
        where = pc.index_in(names, value_set=coded.dictionary)
        known = where.is_valid().to_numpy(zero_copy_only=False)
        found = np.full(len(coded.dictionary), -1, np.int32)
        found[where.drop_null().to_numpy()] = numbers[known]
        return found[coded.indices.to_numpy()]


def packed(model: LangModel, max_rows: int = PACKED_ROWS) -> Packed | None:
    """The model as arrays; None if it has too many rows or grams inside words or of pairs."""
    if tuple(model.kinds) != ("word",) or model.gram_rows > max_rows:
        return None
    rows = model.grams.select("gram", "lang", F.col("weight").cast("int"), F.col("rank").cast("int")).toArrow()
    return Packed(rows, {r.lang: r.score_per_kb for r in model.expected.collect()})


def _chunk_index(pos: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``grams.chunk_index`` of arrays."""
    whole = np.maximum(n // size - 1, 0)
    rest = n - whole * size
    late = pos - whole * size
    one = (rest * 2 < size * 3) | (rest >= size * 2) | (late < (rest + 1) // 2)
    return np.where(late < 0, pos // size, np.where(one, whole, whole + 1))


def _reliability(model: Packed, one: np.ndarray, lang: np.ndarray, lang2: np.ndarray, score: np.ndarray, score2: np.ndarray,
                 hits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``delta_reliability`` and ``expected_reliability`` of arrays, the smaller of both; ``lang2`` is -1 for none."""
    close = (lang2 >= 0) & (model.close[lang] >= 0) & (model.close[lang] == model.close[lang2])
    needed, most, lead = np.clip(hits * 5 // 8, MIN_GRAMS, MAX_GRAMS), np.where(hits < 8, hits * 12, 100), score - score2
    delta = np.where(lead >= needed, most, np.where(lead <= 0, 0, np.minimum(most, lead * 100 // needed)))
    usual, actual = model.usual[lang], score * 1024 // np.maximum(size, 1)
    high, low = np.maximum(usual, actual), np.minimum(usual, actual)
    slope = (low * 400 - high * 100) * 2 // np.maximum(low * 5, 1)
    expected = np.where(actual == 0, 0, np.where(high * 2 <= low * 3, 100, np.where(high > low * 4, 0, slope)))
    expected = np.where(usual == 0, 100, expected)
    return np.where(one, 100, np.minimum(np.where(close, 100, delta), expected))


class _Units:
    """The units of some spans, with the close repeats marked: ``text`` of each, the ``span`` it is of,
    and ``start`` and ``stop`` in characters of the span."""

    def __init__(self, spans: pa.Array, dotted: pa.Array, script: np.ndarray):
        spans = spans.cast(pa.string())
        offsets = np.frombuffer(spans.buffers()[1], np.int32)[spans.offset : spans.offset + len(spans) + 1]
        data = spans.buffers()[2]
        b = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = (offsets - offsets[0]).astype(np.int64)
        self.kinds = {kind: np.isin(script, kind_numbers(kind)) for kind in ("many", "one", "cjk")}
        letter, head = _LETTER[b], (b & 0xC0) != 0x80
        edge = np.zeros(len(b) + 1, bool)
        edge[offsets] = True
        begins = letter & (edge[:-1] | ~np.concatenate([[False], letter])[:-1])
        stops = letter & (edge[1:] | ~np.concatenate([letter, [False]])[1:])
        if self.kinds["cjk"].any():
            # a CJK unit is one character
            single = letter & np.repeat(self.kinds["cjk"], np.diff(offsets))
            begins, stops = begins | (single & head), stops | (single & np.concatenate([head, [True]])[1:])
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.span = np.searchsorted(offsets, starts, "right") - 1
        chars = np.concatenate([[0], np.cumsum(head, dtype=np.int32)])
        self.length = chars[offsets[1:]] - chars[offsets[:-1]]
        self.start, self.stop = (chars[x] - chars[offsets[self.span]] for x in (starts, ends))
        self.size = (ends - starts).astype(np.int32)
        bounds = np.concatenate([[0], np.cumsum(self.size, dtype=np.int32)]).astype(np.int32)
        letters = b[letter].tobytes()
        self.text = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(letters))
        for i in np.flatnonzero(dotted.is_valid().to_numpy(zero_copy_only=False)):
            self._undotted(i, dotted[int(i)].as_py())
        self.word = self.text.dictionary_encode()
        self.again = self._again()

    def _undotted(self, i: int, dotted: str) -> None:
        """Places in the text itself, where a character is two when it is lower-case."""
        back = np.repeat(np.arange(len(dotted)), [1 + (c == "İ") for c in dotted])
        own = self.span == i
        self.start[own], self.stop[own] = back[self.start[own]], back[self.stop[own] - 1] + 1
        self.length[i] = len(dotted)

    def _again(self) -> np.ndarray:
        code, span = self.word.indices.to_numpy(), self.span
        again = np.zeros(len(code), bool)
        for n in (1, 2):
            again[n:] |= (code[n:] == code[:-n]) & (span[n:] == span[:-n])
        return again & self.kinds["many"][span]


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _chunks(model: Packed, least: int, spans: pa.Array, dotted: pa.Array, script: np.ndarray) -> pa.Array:
    """The chunks of every span, as ``placed_chunks`` gives them."""
    n_spans, units = len(spans), _Units(spans, dotted, script)
    one = units.kinds["one"]
    # a span whose script decides is one unit
    kept = np.flatnonzero(~units.again & ~one[units.span])
    span = units.span[kept]
    n = np.bincount(span, minlength=n_spans)
    n_letters = np.bincount(units.span, weights=units.size, minlength=n_spans).astype(np.int64)
    gaps = np.bincount(units.span, minlength=n_spans)
    pos = np.arange(len(kept), dtype=np.int32) - np.concatenate([[0], np.cumsum(n)]).astype(np.int32)[span]
    cjk = units.kinds["cjk"][span]
    in_span = _chunk_index(pos, n.astype(np.int32)[span], np.where(cjk, CHUNK_CJK, CHUNK_WORDS).astype(np.int32))
    leads = np.concatenate([[True], (span[1:] != span[:-1]) | (in_span[1:] != in_span[:-1])])[: len(kept)]
    first = np.flatnonzero(leads)
    # chunks in order, those of ``one`` between the others
    of = np.concatenate([span[first], np.flatnonzero(one)])
    order = np.argsort(of, kind="stable")
    place = np.empty(len(of), np.int64)
    place[order] = np.arange(len(of))
    chunk = place[np.cumsum(leads) - 1] if len(kept) else np.zeros(0, np.int64)
    of, n_chunks = of[order], len(of)
    first_of_span = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_spans))])

    def by_chunk(of_units, of_ones):
        return np.concatenate([of_units, of_ones])[order]

    last = np.concatenate([first[1:], [len(kept)]])[: len(first)] - 1
    zeros = np.zeros(one.sum(), np.int64)
    starts, stops = by_chunk(units.start[kept[first]], zeros), by_chunk(units.stop[kept[last]], units.length[one])
    # dropped words, counted from the first word of their chunk
    dropped = np.flatnonzero(units.again)
    into = np.searchsorted(kept, dropped) - 1
    again = pa.array((dropped - kept[first[np.cumsum(leads)[into] - 1]]) if len(dropped) else [], pa.int32())
    n_again = np.bincount(chunk[into], minlength=n_chunks)
    before = np.where(cjk[first] & (pos[first] > 0), kept[first] - 1, -1)
    before = units.text.take(pa.array(by_chunk(before, zeros - 1), pa.int64(), mask=by_chunk(before, zeros - 1) < 0))

    # the grams: of words their first letters, of characters these and the pairs, one default a span
    gram = np.full(len(kept), -1, np.int32)
    words = units.word.dictionary
    code = units.word.indices.to_numpy()[kept]
    gram[~cjk] = model.find("w:", pc.utf8_slice_codeunits(words, 0, WORD_LETTERS))[code[~cjk]]
    more, more_of = [], []
    if cjk.any():
        gram[cjk] = model.find("u:", words)[code[cjk]]
        behind = np.flatnonzero(cjk & (pos > 0))
        pairs = pc.binary_join_element_wise(units.text.take(pa.array(kept[behind] - 1)), units.text.take(pa.array(kept[behind])), "")
        more, more_of = [model.find("b:", pairs)], [chunk[behind]]
    size = units.size[kept] + ~cjk
    spans_with = np.flatnonzero((n > 0) | one)
    default_of = first_of_span[spans_with]
    default_size = np.where(one[spans_with], (n_letters + gaps)[spans_with], 0)
    gram = np.concatenate([gram, *more, model.defaults[script[spans_with]]])
    chunk = np.concatenate([chunk, *more_of, default_of])
    size = np.concatenate([size, *[np.zeros(len(x), np.int64) for x in more], default_size])

    # their languages
    unknown, width = gram < 0, len(model.langs) + 1
    known = np.flatnonzero(~unknown)
    count = model.count[gram[known]]
    row = np.repeat(model.at[gram[known]] - np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64), count) + np.arange(count.sum())
    key = np.repeat(chunk[known], count) * width + model.lang[row]
    rank = model.rank[row]
    seen = np.zeros(n_chunks * width, bool)
    seen[key] = True
    scores = np.bincount(key, model.weight[row], n_chunks * width).astype(np.int64)
    scores = np.where(seen, scores, -1).reshape(n_chunks, width)[:, :-1]
    hits = np.bincount(np.repeat(chunk[known], count), rank == 1, n_chunks).astype(np.int64)
    sizes = np.bincount(np.repeat(chunk[known], count), np.where(rank <= 1, np.repeat(size[known], count), 0), n_chunks)
    sizes = (sizes + np.bincount(chunk[unknown], size[unknown], n_chunks)).astype(np.int64)
    best, each = [], np.arange(n_chunks)
    for _ in range(2):
        # the first of equal ones: languages are in order
        lang = scores.argmax(1) if model.langs else np.zeros(n_chunks, np.int64)
        score = scores[each, lang] if model.langs else np.full(n_chunks, -1)
        best.append((np.where(score < 0, -1, lang), np.maximum(score, 0)))
        if model.langs:
            scores[each, lang] = -1
    (lang, score), (lang2, score2) = best
    by_script, script = one[of], script[of]
    lang, lang2 = np.where(by_script, model.script_name[script], model.name[lang]), np.where(lang2 < 0, -1, model.name[lang2])
    reliability = _reliability(model, by_script, lang, lang2, score, score2, hits, sizes)

    # chunks like the one before them in their span say nothing
    inner = of[1:] == of[:-1]
    meets = inner & (lang[1:] != lang[:-1])
    other = ~inner | meets | ((reliability[1:] >= least) != (reliability[:-1] >= least))
    meets = np.concatenate([[False], meets])[:n_chunks] | np.concatenate([meets, [False]])[:n_chunks]
    says = np.flatnonzero(np.concatenate([[True], other])[:n_chunks] | meets)
    then = np.where(np.concatenate([inner, [False]])[:n_chunks], np.concatenate([starts[1:], [0]])[:n_chunks], -1)[says]
    columns = [
        pa.array(by_chunk(in_span[first], zeros)[says], pa.int32()), pa.array(by_chunk(pos[first], zeros)[says], pa.int32()),
        pa.array(starts[says], pa.int32()), pa.array(stops[says], pa.int32()), pa.array(then, pa.int32(), mask=then < 0),
        _lists(n_again, again).take(pa.array(says)), before.take(pa.array(says)), pa.array(model.names).take(pa.array(lang[says])),
        pa.array(reliability[says], pa.int32()), pa.array(meets[says]),
    ]
    return _lists(np.bincount(of[says], minlength=n_spans), pa.StructArray.from_arrays(columns, _CHUNK.names))


def _units(spans: pa.Array, dotted: pa.Array, script: np.ndarray, again: pa.Array) -> pa.Array:
    """The units of chunks that stand alone: ``again`` says which words were left out."""
    units = _Units(spans, dotted, script)
    number = np.arange(len(units.span)) - np.searchsorted(units.span, units.span)
    # both in one number, to be searched for; words left out behind the last unit are not here
    left_out = again.flatten().to_numpy().astype(np.int64)
    base = int(max(number.max(initial=0), left_out.max(initial=0))) + 1
    out = left_out + np.repeat(np.arange(len(spans)), pc.list_value_length(again).to_numpy()) * base
    kept = np.flatnonzero(~np.isin(units.span * base + number, out))
    rows = pa.StructArray.from_arrays([units.text.take(pa.array(kept)), pa.array(units.start[kept], pa.int32())], ["unit", "start"])
    return _lists(np.bincount(units.span[kept], minlength=len(spans)), rows)


def _by_bytes(f, spans: pa.Array, dotted: pa.Array, script: pa.Array, *more: pa.Array) -> pa.Array:
    """``f`` of slices of ``SLICE_BYTES`` or one row."""
    ends = np.cumsum(pc.binary_length(spans).to_numpy(zero_copy_only=False))
    out, at = [], 0
    while at < len(spans) or not out:
        n = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")) - at)
        columns = [x.slice(at, n) for x in (spans, dotted, *more)]
        out.append(f(*columns[:2], script.slice(at, n).to_numpy(), *columns[2:]))
        at += n
    return pa.concat_arrays(out)


@F.arrow_udf(T.ArrayType(_UNIT))
def _found_units(spans: pa.Array, dotted: pa.Array, script: pa.Array, again: pa.Array) -> pa.Array:
    return _by_bytes(_units, spans, dotted, script, again)


def _lower(raw: str) -> tuple[Column, Column]:
    """The span in lower case, with nothing but letters, marks and ASCII; and as it is where a character becomes two."""
    # whether a sigma is a word's last one must not depend on what stands between words
    pattern = r"[^\p{L}\p{M}]"
    plain = F.when(F.contains(raw, F.lit("Σ")), F.regexp_replace(raw, pattern, " ")).otherwise(
        F.regexp_replace(raw, rf"[^\x00-\x7f\p{{L}}\p{{M}}]", " ")
    )
    return F.lower(plain), F.when(F.contains(raw, F.lit("İ")), F.col(raw))


def placed_chunks(df: DataFrame, model: Packed, keys: Sequence[str], least: int, text: str = "text") -> DataFrame:
    """(keys, size, span_no, script_no, chunk, first, start, stop, then, again, before, lang1, reliability, meets).

    Of the chunks of ``text_chunks`` the first one of every span, those on both sides of a border between languages
    (``meets``), and those that are reliable, by ``least``, when the one before is not, or the other way round.
    ``size`` is the length of the text, ``start`` and ``stop`` are places in it: of the chunk's first unit and behind
    its last. The next chunk of the span begins at ``then``. ``first`` is the position of the first unit,
    ``before`` the CJK character in front of it, ``again`` the words of the chunk that are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.ArrayType(_CHUNK))
    def found(spans: pa.Array, dotted: pa.Array, script: pa.Array) -> pa.Array:
        return _by_bytes(lambda *x: _chunks(shared.value, least, *x), spans, dotted, script)

    runs = df.select(*keys, F.length(text).alias("size"), span_runs(text, gaps=True).alias("_runs"))
    is_gap = lambda x: F.rlike(F.left(x, F.lit(1)), F.lit(SPAN_GAP))
    # a run that is no span lies between two
    before = lambda i: F.get("_runs", i - 1)
    with_gaps = F.transform("_runs", lambda x, i: F.struct(x.alias("raw"), F.when(is_gap(before(i)), F.length(before(i))).otherwise(0).alias("gap")))
    found_spans = F.filter(with_gaps, lambda s: ~is_gap(s["raw"]))
    spans = runs.select(*keys, "size", F.posexplode_outer(found_spans).alias("span_no", "_s")).filter(F.col("_s").isNotNull())
    spans = spans.select(*keys, "size", "span_no", "_s.gap", F.col("_s.raw").alias("_raw"), F.left("_s.raw", F.lit(1)).alias("_letter"))
    lower, dotted = _lower("_raw")
    spans = spans.select(
        *keys, "size", "span_no", "gap", F.length("_raw").alias("length"), script_number("_letter").alias("script_no"),
        lower.alias("_low"), dotted.alias("_dotted"),
    )
    chunks = spans.select(
        *keys, "size", "span_no", "gap", "length", "script_no", F.explode_outer(found("_low", "_dotted", "script_no")).alias("_c")
    ).select(*keys, "size", "span_no", "gap", "length", "script_no", "_c.*")
    # all spans before, and the gaps before them
    order = W.partitionBy(*keys).orderBy("span_no", "chunk")
    upto = F.sum(F.when(F.col("chunk") == 0, F.col("gap") + F.col("length")).otherwise(0)).over(order) - F.col("length")
    return chunks.withColumn("_from", upto.cast("int")).withColumns(
        {c: F.col("_from") + F.col(c) for c in ("start", "stop", "then")}
    ).drop("_from", "gap", "length")


def placed_units(chunks: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """(columns, units): the units of chunks as ``placed_chunks`` gives them, ``text`` being the whole text; each with
    its place in the chunk."""
    raw = F.substring(text, F.col("start") + 1, F.col("stop") - F.col("start"))
    cut = chunks.select(*columns, "again", raw.alias("_raw"))
    lower, dotted = _lower("_raw")
    cut = cut.select(*columns, "again", lower.alias("_low"), dotted.alias("_dotted"))
    return cut.select(*columns, _found_units("_low", "_dotted", "script_no", "again").alias("units"))
