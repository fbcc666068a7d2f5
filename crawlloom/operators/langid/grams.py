"""From text to scored units: script spans, words, grams, chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.functions.columns import let
from crawlloom.operators.langid.dims import SCRIPTS, array_of, map_of

WORD_LETTERS = 8
# Units per chunk.
CHUNK_WORDS, CHUNK_CJK = 20, 50
# Up to four letters, with the marks of the word's ends where they reach these; then past
# the word when its end is reached, else two letters on and over one vowel.
_QUAD = r"(?=(_?[^_]{1,4}(?:_\z)?))(?:_?[^_]{1,4}_\z|_?[^_]{2}[aeiou]?)"


def _script_class(script: str) -> str:
    # ranges within the script come first: the script of a character is searched for in a long table
    if script == "Han":
        return r"\x{4e00}-\x{9fef}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsBopomofo}"
    if script == "Latin":
        return r"a-zA-Z\p{IsLatin}"
    return rf"\p{{Is{script}}}"


def _span_pattern(script: str) -> str:
    """A run of one script; a single foreign letter inside does not end it."""
    own = _script_class(script)
    return rf"[{own}&&\p{{L}}](?:[\P{{L}}{own}]++|\p{{L}}(?=\P{{L}}*+[{own}]))*+"


SPAN_PATTERN = "|".join(_span_pattern(s) for s, _, _ in SCRIPTS)
# What lies between spans: other characters than letters, and letters of no such script.
SPAN_GAP = rf"[\P{{L}}[^{''.join(_script_class(s) for s, _, _ in SCRIPTS)}]]"
# Letters that are not Latin; those of the first blocks all are but one.
_FOREIGN = r"[[^\x00-\xb4\xb6-\x{24f}]&&\p{L}&&[^\p{IsLatin}]]"
# The one span of a text without such letters.
_LATIN = rf"[{_script_class('Latin')}&&\p{{L}}](?s:.*+)"


def span_runs(text: str, gaps: bool = False) -> Column:
    """The spans of a text, with ``gaps`` also what lies between them, in order."""
    more = rf"|{SPAN_GAP}++" if gaps else ""
    latin, mixed = (F.regexp_extract_all(text, F.lit(p + more), F.lit(0)) for p in (_LATIN, SPAN_PATTERN))
    # most texts have one script: nothing has to be matched letter by letter
    return F.when(F.rlike(text, F.lit(_FOREIGN)), mixed).otherwise(latin)


def script_of(span: str) -> Column:
    """Script of the first letter of column ``span``."""
    cases = " ".join(rf"WHEN rlike({span}, r'\A[{_script_class(s)}]') THEN '{s}'" for s, _, _ in SCRIPTS)
    return F.expr(f"CASE {cases} END")


def letters_only(span: Column) -> Column:
    """Lower-case letters, every other run being one space."""
    return F.trim(F.lower(F.regexp_replace(span, r"[^a-zA-Z\p{L}\p{M}]+", " ")))


def script_spans(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, span_no, script, rtype, span): maximal runs of one script."""
    found = df.select(
        *keys,
        F.posexplode_outer(span_runs(text)).alias("span_no", "raw"),
    ).filter(F.col("raw").isNotNull())
    rtypes = map_of({s: r for s, r, _ in SCRIPTS})
    return found.select(
        *keys,
        "span_no",
        script_of("raw").alias("script"),
        letters_only(F.col("raw")).alias("span"),
    ).select(*keys, "span_no", "script", F.element_at(rtypes, F.col("script")).alias("rtype"), "span")


def drop_close_repeats(units: Column) -> Column:
    """Leave out a unit equal to one of the two before it."""
    return let(
        units,
        lambda all_units: F.filter(
            all_units,
            lambda u, i: ~u.eqNullSafe(F.get(all_units, i - 1))
            & ~u.eqNullSafe(F.get(all_units, i - 2)),
        ),
    )


def words(span: Column) -> Column:
    return drop_close_repeats(F.split(span, " "))


def word_grams(unit: Column) -> Column:
    return F.left(unit, F.lit(WORD_LETTERS))


def quad_grams(word: Column) -> Column:
    """Grams of up to four letters, with marks at the word's ends, every two letters.

    A vowel of a-z at the next place is passed over, and a gram that reaches the word's end
    is its last.
    """
    return F.regexp_extract_all(F.concat(F.lit("_"), word, F.lit("_")), F.lit(_QUAD), F.lit(1))


def cjk_characters(span: Column) -> Column:
    return F.split(F.replace(span, F.lit(" "), F.lit("")), "")


def with_previous(units: Column) -> Column:
    """(unit, prev) of each unit, made without a function call for each of them."""
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), units), F.lit(1), F.size(units))
    return F.arrays_zip(units.alias("unit"), before.alias("prev"))


def cjk_character(unit: Column) -> Column:
    return F.right(unit, F.lit(1))


def chunk_index(pos: Column, n: Column, size: Column | int) -> Column:
    """Chunk of the unit at ``pos`` of ``n``: runs of ``size``.

    A rest of less than one and a half runs is one chunk, one of less than two
    runs is cut in half.
    """
    size = F.lit(size) if isinstance(size, int) else size
    whole = F.greatest(F.floor(n / size) - 1, F.lit(0)).cast("int")
    rest = n - whole * size
    late = pos - whole * size
    return (
        F.when(late < 0, F.floor(pos / size).cast("int"))
        .when((rest * 2 < size * 3) | (rest >= size * 2), whole)
        .when(late < F.floor((rest + 1) / 2), whole)
        .otherwise(whole + 1)
    )


# Scripts travel as numbers through the heavy steps: keys of fixed width are cheaper.
_NUMBER = {script: n for n, (script, _, _) in enumerate(SCRIPTS)}
_OF_KIND = {
    kind: [n for n, (_, r, _) in enumerate(SCRIPTS) if r == kind] for kind in ("many", "one", "cjk")
}


def kind_numbers(kind: str) -> list[int]:
    return _OF_KIND[kind]


def script_number(span: str) -> Column:
    return F.element_at(map_of(_NUMBER), script_of(span))


def is_kind(script_no: Column, kind: str) -> Column:
    return script_no.isin(*_OF_KIND[kind])


def _unit_lists(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, span_no, script_no, _units): the units of every span, CJK characters one by one."""
    units = (
        F.when(F.col("rtype") == "many", words(F.col("span")))
        .when(F.col("rtype") == "cjk", cjk_characters(F.col("span")))
        .otherwise(F.array("span"))
    )
    number = F.element_at(map_of(_NUMBER), F.col("script"))
    return spans.select(*keys, "span_no", number.alias("script_no"), units.alias("_units"))


def _joined_unit() -> Column:
    """The unit of ``_unit``: a word, or a CJK character behind the one before it."""
    cjk = is_kind(F.col("script_no"), "cjk")
    return F.when(cjk, F.concat(F.coalesce("_unit.prev", F.lit("")), "_unit.unit")).otherwise(F.col("_unit.unit"))


def span_units(spans: DataFrame, keys: Sequence[str], pairs: bool = False) -> DataFrame:
    """(keys, span_no, script_no, chunk, pos, unit [, prev]), one row per unit.

    A unit is a word, a CJK character behind the one before it, or the whole span when the
    script decides.
    ``script_no`` is the place of the script in the table of scripts.
    """
    with_units = _unit_lists(spans, keys)
    cjk = is_kind(F.col("script_no"), "cjk")
    # only CJK characters and pairs need the unit before
    alone = F.arrays_zip(F.col("_units").alias("unit"), no_grams().alias("prev"))
    both = with_previous(F.col("_units"))
    # the size is taken before the explode, so that no row carries the array
    sized = with_units.select(
        *keys, "span_no", "script_no", F.size("_units").alias("_n"),
        (both if pairs else F.when(cjk, both).otherwise(alone)).alias("_units"),
    )
    rows = sized.select(
        *keys, "span_no", "script_no", "_n", F.posexplode_outer("_units").alias("pos", "_unit")
    )
    size = F.when(cjk, CHUNK_CJK).otherwise(CHUNK_WORDS)
    return rows.select(
        *keys,
        "span_no",
        "script_no",
        chunk_index(F.col("pos"), F.col("_n"), size).alias("chunk"),
        "pos",
        _joined_unit().alias("unit"),
        *([F.col("_unit.prev").alias("prev")] if pairs else []),
    )


def span_chunks(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, span_no, script_no, chunk, first, before, words), one row per chunk.

    ``words`` are the units of the chunk with a space between them, ``first`` the position of
    its first unit in the span and ``before`` the unit in front of that. ``chunk_units`` makes the
    rows of ``span_units`` from these, so that whole chunks can be left out first.
    """
    size = F.when(is_kind(F.col("script_no"), "cjk"), CHUNK_CJK).otherwise(CHUNK_WORDS)
    sized = _unit_lists(spans, keys).select(
        *keys, "span_no", "script_no", "_units", F.size("_units").alias("_n"), size.alias("_size")
    )
    n, last = F.col("_n"), chunk_index(F.col("_n") - 1, F.col("_n"), F.col("_size"))

    def start(chunk: Column) -> Column:
        # only the last of several chunks may begin elsewhere: it is one half of the rest
        plain = chunk * F.col("_size")
        half = F.floor((n - (chunk - 1) * F.col("_size") + 1) / 2).cast("int") + (chunk - 1) * F.col("_size")
        at_plain = chunk_index(plain - 1, n, F.col("_size")) < chunk
        return F.when(chunk > last, n).when((chunk == 0) | at_plain, plain).otherwise(half)

    def cut(bounds: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda c: F.struct(
                c.alias("chunk"),
                bounds[c].alias("first"),
                F.get("_units", bounds[c] - 1).alias("before"),
                F.array_join(F.slice("_units", bounds[c] + 1, bounds[c + 1] - bounds[c]), " ").alias("words"),
            ),
        )

    chunks = let(F.transform(F.sequence(F.lit(0), last + 1), start), cut)
    return sized.select(*keys, "span_no", "script_no", chunks.alias("_chunks")).select(
        *keys, "span_no", "script_no", F.explode_outer("_chunks").alias("_c")
    ).select(*keys, "span_no", "script_no", "_c.chunk", "_c.first", "_c.before", "_c.words")


def chunk_units(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``span_units`` (without ``prev``) of chunks as ``span_chunks`` gives them."""
    cjk = is_kind(F.col("script_no"), "cjk")
    one = is_kind(F.col("script_no"), "one")
    cut = F.when(one, F.array("words")).otherwise(F.split("words", " "))
    alone = F.arrays_zip(cut.alias("unit"), no_grams().alias("prev"))
    before = F.concat(F.array("before"), cut)
    both = F.arrays_zip(cut.alias("unit"), F.slice(before, F.lit(1), F.size(cut)).alias("prev"))
    rows = chunks.select(
        *keys, "span_no", "script_no", "chunk", "first",
        F.posexplode_outer(F.when(cjk, both).otherwise(alone)).alias("_at", "_unit"),
    )
    return rows.select(
        *keys, "span_no", "script_no", "chunk", (F.col("first") + F.col("_at")).alias("pos"), _joined_unit().alias("unit")
    )


def _matches(text: Column, pattern: str | Column) -> Column:
    """The matches of ``pattern`` in ``text`` and what lies before each, to be exploded."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    # the split has one piece more than there are matches
    return F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))


def unit_places(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, span_no, chunk, pos, start, stop): where the units of ``span_units`` stand in the text.

    Offsets count characters of the text itself. Letters-only offsets are aligned to them by
    running sums over the matches and the gaps between them, first of the script
    spans and then of the words in each; rows stay on the partitioning by ``keys``.
    """
    whole, inside = W.partitionBy(*keys), W.partitionBy(*keys, "span_no")
    size = F.length("_m.gap") + F.length("_m.found")
    # matches are found in columns of their own before every explode: what stands beside an
    # explode is computed for each of its rows, on the whole text
    spans = df.select(*keys, _matches(F.col(text), SPAN_PATTERN).alias("_matches")).select(
        *keys, F.posexplode_outer("_matches").alias("span_no", "_m")
    ).filter(F.col("_m").isNotNull()).select(
        *keys, "span_no", F.col("_m.found").alias("_raw"),
        (F.sum(size).over(whole.orderBy("span_no")) - F.length("_m.found")).alias("_from"),
    )
    script = F.element_at(map_of(_NUMBER), script_of("_raw"))
    pattern = (
        F.when(is_kind(F.col("_script"), "many"), r"[\p{L}\p{M}]+").when(is_kind(F.col("_script"), "cjk"), r"[\p{L}\p{M}]").otherwise(r"(?s).+")
    )
    chunk_size = F.when(is_kind(F.col("_script"), "cjk"), CHUNK_CJK).otherwise(CHUNK_WORDS)
    in_order = inside.orderBy("_at")
    units = spans.withColumn("_script", script).select(
        *keys, "span_no", "_from", is_kind(F.col("_script"), "many").alias("_words"), chunk_size.alias("_chunk"),
        _matches(F.col("_raw"), pattern).alias("_matches"),
    ).select(
        *keys, "span_no", "_from", "_words", "_chunk", F.posexplode_outer("_matches").alias("_at", "_m"),
    ).select(
        *keys, "span_no", "_words", "_chunk", "_at", F.lower("_m.found").alias("_unit"), F.length("_m.found").alias("_length"),
        (F.col("_from") + F.sum(size).over(in_order)).alias("stop"),
    )
    again = F.lag("_unit").over(in_order).eqNullSafe(F.col("_unit")) | F.lag("_unit", 2).over(in_order).eqNullSafe(F.col("_unit"))
    kept = units.withColumn("_again", again & F.col("_words")).filter(~F.col("_again"))
    kept = kept.withColumns({"pos": F.row_number().over(in_order) - 1, "_n": F.count(F.lit(1)).over(inside).cast("int")})
    return kept.select(
        *keys, "span_no", chunk_index(F.col("pos"), F.col("_n"), F.col("_chunk")).alias("chunk"), "pos",
        (F.col("stop") - F.col("_length")).cast("int").alias("start"), F.col("stop").cast("int").alias("stop"),
    )


# explode_outer is used on arrays that are never empty: for the plain form Spark adds
# a filter on the array's size, which would compute the array twice.


def no_grams() -> Column:
    return F.array().cast("array<string>")


def single_gram(prefix: str) -> Column:
    """The gram of a word that each word has once at most: ``w:`` or ``p:``."""
    own = word_grams(F.col("unit"))
    if prefix == "w:":
        return F.concat(F.lit("w:"), own)
    return F.concat(F.lit("p:"), word_grams(F.col("prev")), F.lit(" "), own)


def unit_grams(kinds: Sequence[str]) -> Column:
    """Grams of a unit, the unit's own first; none when the script decides.

    Quadgrams are stored as they are; other kinds carry a prefix: ``w:`` word,
    ``p:`` word pair, ``u:`` and ``b:`` one and two CJK characters. The script chooses:
    ``kinds`` is about words, CJK characters always have both of theirs.
    """
    unit, prev, script = F.col("unit"), F.col("prev"), F.col("script_no")
    many = [F.array(single_gram("w:"))]
    two = F.array(F.concat(F.lit("u:"), cjk_character(unit)), F.concat(F.lit("b:"), unit))
    cjk = F.when(F.length(unit) == 2, two).otherwise(F.array(F.concat(F.lit("u:"), unit)))
    if "quad" in kinds:
        many.append(quad_grams(unit))
    if "pair" in kinds:
        many.append(F.when(prev.isNotNull(), F.array(single_gram("p:"))).otherwise(no_grams()))
    return (
        F.when(is_kind(script, "many"), F.concat(*many))
        .when(is_kind(script, "cjk"), cjk)
        .otherwise(no_grams())
    )


def default_gram() -> Column:
    """``d:`` and the script: a hit for its default language, once per span."""
    names = array_of([f"d:{s}" for s, _, _ in SCRIPTS])
    return F.when(F.col("pos") == 0, F.array(F.get(names, F.col("script_no")))).otherwise(no_grams())


def unit_size() -> Column:
    """Bytes of a unit and of the space after it."""
    own = F.octet_length(cjk_character(F.col("unit")))
    return F.when(is_kind(F.col("script_no"), "cjk"), own).otherwise(F.octet_length("unit") + 1)


def gram_rows(units: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """(keys, span_no, script_no, chunk, pos, gram, unit_bytes), one row per gram.

    ``unit_bytes`` is carried by the first gram of a unit only.
    """
    place = [*keys, "span_no", "script_no", "chunk", "pos"]
    return units.select(
        *place,
        unit_size().alias("_size"),
        F.posexplode_outer(F.concat(unit_grams(kinds), default_gram())).alias("_at", "gram"),
    ).select(*place, "gram", F.when(F.col("_at") == 0, F.col("_size")).otherwise(0).alias("unit_bytes"))


def text_grams(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    kinds: Sequence[str] = ("word", "quad"),
    prefix: str | None = None,
) -> DataFrame:
    """Every gram of every text, with its place.

    With ``prefix`` ``w:`` or ``p:`` only the grams that begin so, without ``unit_bytes``;
    a word has one at most, so no others are made and left out again.
    """
    units = span_units(script_spans(df, keys, text), keys, pairs="pair" in kinds)
    if prefix is None:
        return gram_rows(units, keys, kinds)
    # without a word before there is no pair
    wanted = units.filter(is_kind(F.col("script_no"), "many"))
    wanted = wanted.filter(F.col("prev").isNotNull()) if prefix == "p:" else wanted
    return wanted.select(*keys, "span_no", "script_no", "chunk", "pos", single_gram(prefix).alias("gram"))
