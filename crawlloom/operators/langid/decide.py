"""From language totals of a text to its verdict.

A text has few languages. They are gathered into one short array, and the rules
below are expressions over it, so that no further shuffle or join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.operators.langid.dims import CLOSEST, UNKNOWN, close_set_of, map_sql

KEEP_RELIABILITY = 41
KEEP_PERCENT = 2
SECOND_OVER_ENGLISH, SECOND_OVER_FIGS, SECOND_BYTES = 17, 20, 15
FIRST_PERCENT, FIRST_RELIABLE_PERCENT, IGNORED_PERCENT = 26, 51, 20
FIGS = "('fr', 'it', 'de', 'es')"
EFIGS = "('en', 'fr', 'it', 'de', 'es')"

# The rules are SQL text: the same lambdas built call by call take seconds to plan.


def gather(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, langs, text_bytes) from one row per text and language."""
    return totals.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("lang", "bytes", "score", "rel"))).alias("langs"),
        F.sum("bytes").alias("text_bytes"),
    )


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def _sum(items: str, field: str) -> str:
    return f"aggregate({items}, 0L, (a, y) -> a + y.{field})"


_LANG = {n: f"x.{n}" for n in ("lang", "bytes", "score", "rel")}


def merge_close_pairs(langs: DataFrame) -> DataFrame:
    """Of each set of close languages, the one with most bytes takes all."""
    with_set = f"transform(langs, x -> {_struct(**_LANG, s=f'try_element_at({map_sql(close_set_of())}, x.lang)')})"
    beaten = "exists(ls, y -> y.s <=> x.s AND (y.bytes > x.bytes OR (y.bytes = x.bytes AND y.lang < x.lang)))"
    same = "filter(ls, y -> y.s <=> x.s)"
    merged = _struct(
        lang="x.lang", bytes=_sum(same, "bytes"), score=_sum(same, "score"), rel=_sum(same, "rel")
    )
    body = (
        f"transform(filter(ls, x -> x.s IS NULL OR NOT {beaten}), "
        f"x -> IF(x.s IS NULL, {_struct(**_LANG)}, {merged}))"
    )
    return langs.withColumn("langs", F.expr(_let(with_set, "ls", body)))


def drop_unreliable(langs: DataFrame) -> DataFrame:
    """Languages below 41 % reliability go, or join their closest neighbour.

    Where the closest language of an unreliable one is present as well, the more
    reliable of the two stays, with the score and reliability of both.
    """
    rated = _struct(
        **_LANG,
        pct="x.rel div greatest(x.bytes, 1L)",
        alt=f"coalesce(try_element_at({map_sql(CLOSEST)}, x.lang), '')",
    )
    paired = (
        f"x.lang <> y.lang AND y.bytes > 0 AND ((x.pct < {KEEP_RELIABILITY} AND x.alt = y.lang) "
        f"OR (y.pct < {KEEP_RELIABILITY} AND y.alt = x.lang))"
    )
    loses = f"exists(ls, y -> {paired} AND (y.pct > x.pct OR (y.pct = x.pct AND y.lang < x.lang)))"
    both = f"(x.bytes + {_sum('o', 'bytes')})"
    best = f"aggregate(o, greatest(x.pct, {KEEP_RELIABILITY}L), (a, y) -> greatest(a, y.pct))"
    joined = _struct(lang="x.lang", bytes="x.bytes", score=both, rel=f"{best} * {both}")
    survivor = _let(f"filter(ls, y -> {paired})", "o", f"IF(size(o) = 0, {_struct(**_LANG)}, {joined})")
    body = (
        f"filter(transform(filter(ls, x -> NOT {loses}), x -> {survivor}), "
        f"x -> x.rel div greatest(x.bytes, 1L) >= {KEEP_RELIABILITY})"
    )
    return langs.withColumn("langs", F.expr(_let(f"transform(langs, x -> {rated})", "ls", body)))


def top3(df: DataFrame) -> DataFrame:
    """Adds the three largest languages: lang1.., percent1.., score1.., text_bytes.

    Percents are differences of cumulative ones, which rounds better; a rounding
    inversion of neighbours is put right. Scores are per 1024 bytes.
    """
    order = (
        f"slice(array_sort(transform(filter(langs, x -> x.lang <> '{UNKNOWN}'), "
        f"x -> {_struct(neg='-x.bytes', lang='x.lang', score='x.score')})), 1, 3)"
    )
    fields = {}
    for n in (1, 2, 3):
        entry = f"get(t, {n - 1})"
        fields[f"lang{n}"] = f"coalesce({entry}.lang, '{UNKNOWN}')"
        fields[f"score{n}"] = (
            f"coalesce({entry}.score * 1024 div greatest(-{entry}.neg, 1L), 0L)"
        )
        fields[f"b{n}"] = f"coalesce(-{entry}.neg, 0L)"
    kept = {n: f"s.{n}" for n in fields if n[0] != "b"}
    sized = {**kept, "text_bytes": "s.text_bytes"}
    size = "greatest(s.text_bytes, 1L)"
    c1, c2, c3 = (
        f"CAST(({b}) * 100 div {size} AS INT)"
        for b in ("s.b1", "s.b1 + s.b2", "s.b1 + s.b2 + s.b3")
    )
    shares = {n: f"s.{n}" for n in ("percent1", "percent2", "percent3")}

    def level(first: str, second: str) -> str:
        up = f"IF(s.{first} < s.{second}, 1, 0)"
        return _struct(
            **{**sized, **shares, first: f"s.{first} + {up}", second: f"s.{second} - {up}"}
        )

    out = _let(order, "t", _struct(**fields))
    for body in (
        _struct(**{n: f"s.{n}" for n in fields}, text_bytes="greatest(text_bytes, s.b1 + s.b2 + s.b3)"),
        _struct(**sized, percent1=c1, percent2=f"{c2} - {c1}", percent3=f"{c3} - {c2}"),
        level("percent2", "percent3"),
        level("percent1", "percent2"),
    ):
        out = _let(out, "s", body)
    top = df.withColumn("_top", F.expr(out)).drop("text_bytes")
    return top.select("*", "_top.*").drop("_top")


def summary_language(df: DataFrame, best_effort: bool = False) -> DataFrame:
    """Adds ``lang`` and ``reliable`` from the top three languages.

    A large enough second language wins over English, and over French, Italian,
    German and Spanish, which are then taken for boilerplate; a second language
    of that kind is left out of the first one's percentage.
    """
    second = (
        f"lang2 <> '{UNKNOWN}' AND text_bytes * percent2 div 100 >= {SECOND_BYTES} AND "
        f"((lang1 = 'en' AND lang2 <> 'en' AND percent2 >= {SECOND_OVER_ENGLISH}) OR "
        f"(lang1 IN {FIGS} AND lang2 NOT IN {EFIGS} AND percent2 >= {SECOND_OVER_FIGS}))"
    )
    less_second = (
        f"(lang2 = 'en' AND lang1 <> 'en') OR (lang2 IN {FIGS} AND lang1 NOT IN {EFIGS})"
    )
    chosen = _struct(
        second=f"({second})",
        percent=f"CASE WHEN {second} THEN percent2 * 100 div (101 - percent1) "
        f"WHEN {less_second} THEN percent1 * 100 div (101 - percent2) ELSE percent1 END",
    )
    too_small = "false" if best_effort else f"s.percent < {FIRST_PERCENT}"
    settled = _struct(
        lang=f"CASE WHEN {too_small} THEN '{UNKNOWN}' WHEN s.second THEN lang2 ELSE lang1 END",
        reliable=f"percent1 >= {KEEP_PERCENT} AND NOT ({too_small}) "
        f"AND s.percent >= {FIRST_RELIABLE_PERCENT} "
        f"AND 100 - (percent1 + percent2 + percent3) <= {IGNORED_PERCENT}",
    )
    out = df.withColumn("_summary", F.expr(_let(chosen, "s", settled)))
    return out.select("*", "_summary.*").drop("_summary")


def decide(totals: DataFrame, keys: Sequence[str], best_effort: bool = False) -> DataFrame:
    """Verdict per text from its language totals.

    (keys, text_bytes, lang1..3, percent1..3, score1..3, lang, reliable)
    """
    langs = merge_close_pairs(gather(totals, keys))
    if not best_effort:
        langs = drop_unreliable(langs)
    return summary_language(top3(langs), best_effort).drop("langs")
