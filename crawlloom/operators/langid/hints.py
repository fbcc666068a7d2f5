"""Language hints: markup tags, country domain, encoding, stated language."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlloom.functions.columns import let
from crawlloom.operators.langid.dims import (
    CLOSE_SETS,
    ENCODING_LANGUAGES,
    ENCODING_WEIGHT,
    LANGUAGE_WEIGHT,
    lang_tag_dim,
    map_of,
    tld_dim,
)

# Limits of ``reference=True``; by default no tag and no hint is left out.
MOST_TAGS, LONGEST_TAG, LONGEST_CODE, MOST_PRIORS = 5, 16, 3, 4

# A tag that can state a language: a lang attribute, or a meta element about it.
_TAGGED = (
    r"(?i)<(?!!--|(?:font|script|link|img|a)\s)(?:"
    r"meta\s[^<>&]*(?:http-equiv\s*=\s*[\"']?content-language|name\s*=\s*[\"']?(?:dc\.)?language)[^<>]*"
    r"|[^<>&]*?[\s:]lang\s*=[^<>]*)>"
)
_META = r"(?i)\A<meta\s(?:.*(?:content-language|language))"
_ATTRIBUTE = r"(?i)[\s:]lang\s*=\s*[\"']?([a-z_,\s-]+)"
_CONTENT = r"(?i)\scontent\s*=\s*[\"']?([a-z_,\s-]+)"


def html_lang_tags(html: Column) -> Column:
    """Comma list of the language tags a whole page states, lower-case, each once."""
    tags = F.regexp_extract_all(html, F.lit(_TAGGED), F.lit(0))

    def stated(tag: Column) -> Column:
        by_attribute = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1))
        by_content = F.regexp_extract_all(tag, F.lit(_CONTENT), F.lit(1))
        return F.when(tag.rlike(_META), F.concat(by_content, by_attribute)).otherwise(by_attribute)

    joined = F.array_join(F.flatten(F.transform(tags, stated)), ",")
    plain = F.regexp_replace(F.replace(F.lower(joined), F.lit("_"), F.lit("-")), r"\s+", "")
    return F.array_join(F.array_distinct(F.filter(F.split(plain, ","), lambda t: F.length(t) > 0)), ",")


def host_tld(url: Column) -> Column:
    """Last label of the host name, lower-case."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)
    return F.lower(F.substring_index(host, ".", -1))


def tag_priors(df: DataFrame, keys: Sequence[str], tags: str, reference: bool = False) -> DataFrame:
    """(keys, lang, weight) of a comma list of tags; a language counts once, by its
    largest weight. A tag that is not known as a whole counts by its part before the
    first hyphen. With ``reference`` more than five tags say nothing, tags of over 16
    letters are passed over, and only parts of up to three letters are looked up."""
    dim = F.broadcast(lang_tag_dim(df.sparkSession))  # a few hundred rows
    parts = F.split(F.col(tags), ",")
    some = df.filter(F.length(tags) > 0)
    if reference:
        some = some.filter(F.size(parts) <= MOST_TAGS)
    each = some.select(*keys, F.explode_outer(F.array_distinct(parts)).alias("_tag"))
    code = F.substring_index("_tag", "-", 1)
    if reference:
        each = each.filter(F.length("_tag") <= LONGEST_TAG)
        code = F.when(F.length(code) <= LONGEST_CODE, code)
    whole = dim.select(F.col("tag").alias("_tag"), F.lit(True).alias("_known")).distinct()
    looked = each.join(F.broadcast(whole), "_tag", "left").withColumn(
        "tag", F.when(F.col("_known"), F.col("_tag")).otherwise(code)
    )
    return looked.join(dim, "tag").groupBy(*keys, "lang").agg(F.max("weight").alias("weight"))


def tld_prior(df: DataFrame, keys: Sequence[str], tld: str) -> DataFrame:
    """(keys, lang, weight) of a country domain."""
    dim = F.broadcast(tld_dim(df.sparkSession))  # under 250 rows
    return df.select(*keys, F.lower(tld).alias("tld")).join(dim, "tld").select(*keys, "lang", "weight")


def encoding_prior(df: DataFrame, keys: Sequence[str], encoding: str) -> DataFrame:
    lang = F.element_at(map_of(ENCODING_LANGUAGES), F.lower(encoding))
    return (
        df.select(*keys, lang.alias("lang"), F.lit(ENCODING_WEIGHT).alias("weight"))
        .filter(F.col("lang").isNotNull())
    )


def stated_prior(df: DataFrame, keys: Sequence[str], lang: str) -> DataFrame:
    return df.filter(F.length(lang) > 0).select(
        *keys, F.col(lang).alias("lang"), F.lit(LANGUAGE_WEIGHT).alias("weight")
    )


def language_priors(
    df: DataFrame,
    keys: Sequence[str],
    tags: str | None = None,
    tld: str | None = None,
    encoding: str | None = None,
    lang: str | None = None,
    reference: bool = False,
) -> DataFrame:
    """(keys, lang, weight): all hints of a text combined.

    The first hint for a language gives its weight; each further kind of hint for
    the same language adds 2. With ``reference`` the strongest four hints stay.
    """
    kinds = [
        (0, tags, partial(tag_priors, reference=reference)),
        (1, tld, tld_prior),
        (2, encoding, encoding_prior),
        (3, lang, stated_prior),
    ]
    parts = [
        build(df, keys, column).withColumn("_kind", F.lit(kind))
        for kind, column, build in kinds
        if column is not None
    ]
    hints = parts[0]
    for part in parts[1:]:
        hints = hints.unionByName(part)
    merged = hints.groupBy(*keys, "lang").agg(
        (F.min_by("weight", "_kind") + 2 * (F.count(F.lit(1)) - 1)).cast("int").alias("weight"),
        F.min("_kind").alias("_first"),
    )
    if not reference:
        return merged.select(*keys, "lang", "weight")
    # a text has a handful of hints
    strongest = W.partitionBy(*keys).orderBy(F.desc(F.abs("weight")), "_first", "lang")
    return (
        merged.withColumn("_rank", F.row_number().over(strongest))
        .filter(F.col("_rank") <= MOST_PRIORS)
        .select(*keys, "lang", "weight")
    )


def suppressed(langs: Column) -> Column:
    """Languages ruled out: the rest of a close set of which one member is hinted.

    ``langs`` holds the hinted ones. The two Chinese scripts form a set as well.
    """
    sets = CLOSE_SETS + [["zh", "zh-Hant"]]
    out = []
    for members in sets:
        named = F.array(*[F.lit(m) for m in members])
        hit = F.array_intersect(langs["lang"], named)
        positive = F.exists(langs, lambda x: F.array_contains(named, x["lang"]) & (x["weight"] > 0))
        out.append(
            F.when((F.size(hit) == 1) & positive, F.array_except(named, hit)).otherwise(
                F.array().cast("array<string>")
            )
        )
    return F.concat(*out)


def apply_priors(scores: DataFrame, priors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chunk scores with every positive hint added to every chunk of its text."""
    hints = priors.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lang", "weight"))).alias("_hints"))
    hints = hints.select(
        *keys,
        F.filter("_hints", lambda x: x["weight"] > 0).alias("_boosts"),
        let(F.col("_hints"), suppressed).alias("_out"),
    )
    place = [*keys, "span_no", "chunk", "script_no"]
    entry = F.struct("lang", "score", "hits", "bytes")
    gathered = scores.groupBy(*place).agg(F.collect_list(entry).alias("_rows"))
    boost = F.transform(
        F.coalesce("_boosts", F.array().cast("array<struct<lang:string,weight:int>>")),
        lambda x: F.struct(
            x["lang"].alias("lang"),
            x["weight"].cast("long").alias("score"),
            F.lit(0).cast("long").alias("hits"),
            F.lit(0).cast("long").alias("bytes"),
        ),
    )
    rows = (
        gathered.join(hints, list(keys), "left")
        .select(*place, "_out", F.explode_outer(F.concat("_rows", boost)).alias("_row"))
        .select(*place, "_out", "_row.*")
    )
    # a ruled-out language keeps its bytes, as text nobody claims
    out = F.coalesce(F.array_contains("_out", F.col("lang")), F.lit(False))
    rows = rows.withColumns(
        {
            "lang": F.when(~out, F.col("lang")),
            "score": F.when(out, 0).otherwise(F.col("score")),
        }
    )
    return rows.groupBy(*place, "lang").agg(
        F.sum("score").alias("score"), F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes")
    )
