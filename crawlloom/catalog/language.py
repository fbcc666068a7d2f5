"""Checked queries of the language job, with the same steps in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlloom.catalog.text import documents, table
from crawlloom.functions.text import byte_length
from crawlloom.operators.langid import decide as D
from crawlloom.operators.langid import grams as G
from crawlloom.operators.langid import model as M
from crawlloom.operators.langid import score as S
from crawlloom.operators.langid.detect import DETAILS, detect_language, text_chunks, with_language
from crawlloom.operators.langid.hints import apply_priors, host_tld, html_lang_tags, language_priors
from crawlloom.operators.langid.refine import (
    dealt_chunks,
    distinct_boost,
    drop_repeated_words,
    gram_hits,
    refine_pass,
    squeeze_text,
)
from crawlloom.operators.langid.spans import (
    detect_spans,
    meeting_chunks,
    merge_adjacent_spans,
    refine_boundaries,
    text_spans,
)
from crawlloom.operators.routing import reliable_only
from crawlloom.session import by_keys, spread

KEYS = ["doc_id"]
_models: dict[tuple, M.LangModel] = {}


def model(spark, sf, kinds=("word",)) -> M.LangModel:
    """Model trained on all documents; trained once per session."""
    key = (spark.sparkContext.applicationId, sf, kinds)
    if key not in _models:
        _models[key] = M.train(table(spark, sf, "documents"), kinds=kinds)
    return _models[key]


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def script_spans(spark, sf):
    spans = G.script_spans(spread(docs(spark, sf)), KEYS)
    return spans.select("doc_id", "span_no", "script", "rtype", "span")


def _gram_counts(spark, sf, kinds, prefix=None):
    grams = G.text_grams(spread(docs(spark, sf)), KEYS, kinds=kinds, prefix=prefix)
    grams = grams if prefix else grams.filter(~F.col("gram").contains(":"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def word_grams(spark, sf):
    return _gram_counts(spark, sf, ("word",), "w:")


def word_pairs(spark, sf):
    return _gram_counts(spark, sf, ("word", "pair"), "p:")


def quad_grams(spark, sf):
    return _gram_counts(spark, sf, ("word", "quad"))


# Characters that are moved in one pass; U+0800 and above go one by one.
_LOW = 0x800


def moved_to_han(text):
    """The text with each character moved to a Han character, one to one."""
    code = "lpad(hex(19968 + ascii(c) % 20000), 4, '0')"
    one_by_one = F.expr(f"array_join(transform(split({text}, ''), c -> decode(unhex({code}), 'UTF-16BE')), '')")
    low, han = ("".join(map(chr, range(at, at + _LOW))) for at in (0, 19968))
    return F.when(F.col(text).rlike(rf"\A[\x00-\x{{{_LOW - 1:x}}}]+\z"), F.translate(text, low, han)).otherwise(one_by_one)


def cjk_grams(spark, sf):
    """All characters of the documents moved to Han characters, one to one."""
    han = spread(docs(spark, sf)).select("doc_id", moved_to_han("text").alias("text"))
    grams = G.text_grams(han, KEYS, kinds=("word",))
    # the kind is part of the gram: it is no key of the first, large aggregate
    each = grams.filter(~F.col("gram").startswith("d:")).groupBy("chunk", "gram").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(F.left("gram", F.lit(2)).alias("kind"), "chunk").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("grams")
    )


def lang_train_grams(spark, sf):
    return M.weigh(M.gram_counts(table(spark, sf, "documents"), kinds=("word",))).select(
        "gram", "lang", "weight", "rank", "n"
    )


def lang_expected_scores(spark, sf):
    return model(spark, sf).expected


def chunk_scores(spark, sf):
    scores = S.score_texts(by_keys(docs(spark, sf), KEYS), model(spark, sf), KEYS)
    return scores.select("doc_id", "chunk", "lang", "score", "hits", "bytes")


def chunk_reliability(spark, sf):
    return text_chunks(docs(spark, sf), model(spark, sf), KEYS).drop("span_no")


def lang_byte_totals(spark, sf):
    return S.lang_byte_totals(text_chunks(docs(spark, sf), model(spark, sf), KEYS), KEYS)


def lang_detect_words(spark, sf):
    return detect_language(docs(spark, sf), model(spark, sf), KEYS, details=True)


def lang_detect(spark, sf):
    return detect_language(docs(spark, sf), model(spark, sf, ("word", "quad")), KEYS, details=True)


def lang_detect_best_effort(spark, sf):
    return detect_language(docs(spark, sf), model(spark, sf), KEYS, best_effort=True)


def lang_accuracy(spark, sf):
    """Documents by stated and found language; unreliable answers left out."""
    gold = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("stated"))
    found = reliable_only(with_language(gold, lang_detect_words(spark, sf), KEYS))
    return found.groupBy("stated", "lang").agg(F.count(F.lit(1)).alias("texts"))


# Totals per source, with the languages renamed so that every rule has work to do.
RELABEL = (
    "CASE lang WHEN 'es' THEN CASE doc_id % 3 WHEN 0 THEN 'es' WHEN 1 THEN 'pt' ELSE 'gl' END "
    "WHEN 'fr' THEN CASE doc_id % 2 WHEN 0 THEN 'cs' ELSE 'sk' END "
    "WHEN 'de' THEN CASE doc_id % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'nn' WHEN 2 THEN 'ru' ELSE 'bg' END "
    "ELSE CASE doc_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'it' ELSE 'id' END END"
)
GROUP = "doc_id % 199"
PERCENT = "(doc_id * 7) % 83"


def _totals(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.expr(GROUP).alias("grp"), F.expr(RELABEL).alias("lang"), "n_chars", F.expr(PERCENT).alias("pct")
    )
    return rows.groupBy("grp", "lang").agg(
        F.sum("n_chars").alias("bytes"),
        F.count(F.lit(1)).alias("score"),
        F.sum(F.col("n_chars") * F.col("pct")).alias("rel"),
    )


def _exploded(langs):
    return langs.select("grp", F.explode("langs").alias("l")).select("grp", "l.*")


def close_pair_merge(spark, sf):
    langs = D.gather(_totals(spark, sf), ["grp"])
    return _exploded(D.merge_close_pairs(langs))


def drop_unreliable(spark, sf):
    langs = D.gather(_totals(spark, sf), ["grp"])
    return _exploded(D.drop_unreliable(langs))


def lang_top3_percent(spark, sf):
    return D.top3(D.gather(_totals(spark, sf), ["grp"])).drop("langs")


def lang_summary(spark, sf):
    top = D.top3(D.gather(_totals(spark, sf), ["grp"]))
    return D.summary_language(top).select("grp", "lang", "reliable")


def lang_summary_best_effort(spark, sf):
    top = D.top3(D.gather(_totals(spark, sf), ["grp"]))
    return D.summary_language(top, best_effort=True).select("grp", "lang", "reliable")


def lang_spans(spark, sf):
    """Runs of turns in one language within each conversation."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    verdict = detect_language(turns, model(spark, sf), ["conv_id", "turn"])
    sized = with_language(turns, verdict, ["conv_id", "turn"]).withColumn(
        "bytes", byte_length(F.col("text"))
    )
    return merge_adjacent_spans(sized, ["conv_id"], ["turn"])


def document_spans(spark, sf):
    return detect_spans(text_chunks(docs(spark, sf), model(spark, sf), KEYS), KEYS)


def text_spans_cut(spark, sf):
    """Each document followed by the next one, cut into pieces of one language, by places in the text itself."""
    # dealt out before the join, whose partitions would be merged by their bytes else
    d = by_keys(docs(spark, sf), KEYS)
    after = by_keys(docs(spark, sf).select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("more")), KEYS)
    joined = d.join(after, "doc_id").select("doc_id", F.concat_ws("\n", "text", "more").alias("text"))
    spans = text_spans(joined, model(spark, sf), KEYS)
    piece = F.substring("text", F.col("start").cast("int") + 1, F.col("length").cast("int"))
    return joined.join(spans.hint("shuffle_hash"), "doc_id").select("doc_id", "span", "start", "length", "lang", F.sha2(piece, 256).alias("piece"))


def span_borders(spark, sf):
    """Each document followed by the next one: borders between languages, sharpened."""
    # dealt out before the join, whose partitions would be merged by their bytes else
    d = by_keys(docs(spark, sf), KEYS)
    after = by_keys(docs(spark, sf).select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("more")), KEYS)
    joined = d.join(after, "doc_id").select("doc_id", F.concat_ws("\n", "text", "more").alias("text"))
    m = model(spark, sf)
    dealt = dealt_chunks(joined, KEYS)
    hits = gram_hits(joined, m, KEYS, chunks=dealt)
    chunks = S.chunk_language(S.chunk_scores(hits, KEYS), m.expected, KEYS)
    near = gram_hits(joined, m, KEYS, chunks=meeting_chunks(dealt, chunks, KEYS))
    return refine_boundaries(near, chunks, KEYS).select("doc_id", "chunk", "border")


def priors(spark, sf):
    d = documents(spark, sf).select(
        "doc_id",
        F.expr("CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN concat(lang, ',ms') WHEN 2 THEN 'da-dk' "
               "WHEN 3 THEN concat(lang, '-XX,', lang) ELSE 'czech,xx' END").alias("tags"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN lang WHEN 1 THEN 'ch' ELSE 'com' END").alias("tld"),
        F.expr("CASE doc_id % 4 WHEN 0 THEN 'Shift_JIS' ELSE 'utf-8' END").alias("encoding"),
        F.expr("CASE doc_id % 7 WHEN 0 THEN lang ELSE '' END").alias("stated"),
    )
    return language_priors(d, KEYS, "tags", "tld", "encoding", "stated")


def page_priors(spark, sf):
    """Hints of real pages: the tags they state and their hosts."""
    pages = table(spark, sf, "pages").select(
        "page_id", html_lang_tags(F.col("html")).alias("tags"), host_tld(F.col("url")).alias("tld")
    )
    return language_priors(pages, ["page_id"], "tags", "tld")


def lang_detect_hinted(spark, sf):
    return detect_language(docs(spark, sf), model(spark, sf), KEYS, details=True, priors=priors(spark, sf))


def chunk_scores_with_priors(spark, sf):
    scores = S.score_texts(by_keys(docs(spark, sf), KEYS), model(spark, sf), KEYS)
    out = apply_priors(scores, priors(spark, sf), KEYS)
    return out.select("doc_id", "chunk", "lang", "score", "hits", "bytes")


def chunk_scores_with_boost(spark, sf):
    hits = gram_hits(docs(spark, sf), model(spark, sf), KEYS)
    out = distinct_boost(S.chunk_scores(hits, KEYS), hits, KEYS)
    return out.select("doc_id", "chunk", "lang", "score", "hits", "bytes")


def repeated_words(spark, sf):
    return drop_repeated_words(by_keys(docs(spark, sf), KEYS), KEYS)


def squeezed_text(spark, sf):
    return spread(docs(spark, sf)).select("doc_id", squeeze_text(F.col("text")).alias("text"))


def lang_refined(spark, sf):
    """Whole texts under twice their id, and their first words alone under the next number."""
    whole = docs(spark, sf)
    words = whole.select((F.col("doc_id") * 2 + 1).alias("doc_id"), F.regexp_extract("text", r"\p{L}+", 0).alias("text"))
    both = whole.select((F.col("doc_id") * 2).alias("doc_id"), "text").union(words)
    return refine_pass(both, model(spark, sf), KEYS)


_CHUNK = """CASE WHEN pos < 20 * greatest(n // 20 - 1, 0) THEN pos // 20
  WHEN (n - 20 * greatest(n // 20 - 1, 0)) * 2 < 60 OR n - 20 * greatest(n // 20 - 1, 0) >= 40
    OR pos - 20 * greatest(n // 20 - 1, 0) < (n - 20 * greatest(n // 20 - 1, 0) + 1) // 2
  THEN greatest(n // 20 - 1, 0) ELSE greatest(n // 20 - 1, 0) + 1 END"""


def _units_sql(name: str, base: str) -> str:
    """CTEs ``{name}``: one row per unit of the texts of ``base(id, gold, text)``."""
    return rf"""{name}_l AS (SELECT id, gold, string_split(trim(lower(regexp_replace(text, '[^\p{{L}}\p{{M}}]+', ' ', 'g'))), ' ') AS l
      FROM ({base})),
    {name}_u AS (SELECT id, gold, list_filter(l, lambda w, i: (i < 2 OR w <> l[i - 1]) AND (i < 3 OR w <> l[i - 2])) AS u
      FROM {name}_l WHERE l[1] <> ''),
    {name}_p AS (SELECT id, gold, len(u) AS n, unnest(range(len(u))) AS pos, unnest(u) AS unit FROM {name}_u),
    {name} AS (SELECT id, gold, pos, unit, {_CHUNK} AS chunk FROM {name}_p)"""


def _walk_sql(name: str, words: str) -> str:
    """CTE ``{name}(unit, gram)``: a step takes up to four letters, then goes two on and over a vowel."""
    return f"""{name}_s AS (
      SELECT DISTINCT unit, 0 AS o FROM {words} WHERE unit <> ''
      UNION ALL SELECT unit, o + 2 + CASE WHEN substr(unit, o + 3, 1) IN ('a', 'e', 'i', 'o', 'u') THEN 1 ELSE 0 END
      FROM {name}_s WHERE length(unit) - o > 4),
    {name} AS (SELECT unit, CASE WHEN o = 0 THEN '_' ELSE '' END || substr(unit, o + 1, 4)
      || CASE WHEN length(unit) - o <= 4 THEN '_' ELSE '' END AS gram FROM {name}_s)"""


def _grams_sql(name: str, units: str, quads: bool) -> str:
    out = f"""{name} AS (SELECT id, gold, chunk, pos, 'w:' || left(unit, 8) AS gram, strlen(unit) + 1 AS unit_bytes FROM {units}"""
    if quads:
        out += f" UNION ALL SELECT id, gold, chunk, pos, k.gram, 0 FROM {units} JOIN {name}_k k USING (unit)"
    return (f"{_walk_sql(f'{name}_k', units)}, " if quads else "") + out + ")"


_DOCS = "SELECT doc_id AS id, lang AS gold, text FROM documents"
_NEXT = """SELECT a.doc_id AS id, a.lang AS gold, a.text || '\n' || b.text AS text
    FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"""
_TURNS = "SELECT conv_id * 1000000 + turn AS id, '' AS gold, text FROM conversations"


def _model_sql(quads: bool = False) -> str:
    return f"""WITH {"RECURSIVE " if quads else ""}{_units_sql("tu", _DOCS)}, {_grams_sql("tg", "tu", quads)},
    cn AS (SELECT gram, gold AS lang, count(*) AS n, sum(unit_bytes) AS gram_bytes FROM tg GROUP BY ALL),
    wt AS (SELECT *, sum(n) OVER (PARTITION BY gram) AS tot,
      row_number() OVER (PARTITION BY gram ORDER BY n DESC, lang) AS rank FROM cn),
    md AS (SELECT gram, lang, CASE WHEN n * 16 >= tot * 15 THEN 12 WHEN n * 4 >= tot * 3 THEN 9
      WHEN n * 2 >= tot THEN 6 WHEN n * 4 >= tot THEN 3 ELSE 1 END AS weight, rank, n FROM wt WHERE rank <= 3),
    ex AS (SELECT lang, ((s * 1024) // b)::BIGINT AS score_per_kb FROM
      (SELECT lang, sum(n * weight) AS s FROM md GROUP BY lang) JOIN
      (SELECT lang, sum(gram_bytes) AS b FROM cn GROUP BY lang) USING (lang)),
    mm AS (SELECT gram, lang, weight, rank FROM md UNION ALL SELECT 'd:Latin', 'en', 1, 0)"""


def _score_sql(base: str = _DOCS, quads: bool = False) -> str:
    return f"""{_model_sql(quads)}, {_units_sql("du", base)}, {_grams_sql("dg", "du", quads)},
    gd AS (SELECT id, chunk, pos, gram, unit_bytes FROM dg
      UNION ALL SELECT id, chunk, 0, 'd:Latin', 0 FROM du WHERE pos = 0),
    hi AS (SELECT * FROM gd LEFT JOIN mm USING (gram)),
    cs AS (SELECT id, chunk, lang, coalesce(sum(weight), 0)::BIGINT AS score, count(*) FILTER (rank = 1) AS hits,
      sum(CASE WHEN coalesce(rank, 1) <= 1 THEN unit_bytes ELSE 0 END)::BIGINT AS bytes FROM hi GROUP BY ALL)"""


def _chunks_sql(base: str = _DOCS, quads: bool = False, hints: str = "") -> str:
    scores = f"{_score_sql(base, quads)}, {hints}" if hints else _score_sql(base, quads)
    return f"""{scores},
    rk AS (SELECT *, row_number() OVER (PARTITION BY id, chunk ORDER BY (lang IS NULL), score DESC, lang) AS r FROM {"ch" if hints else "cs"}),
    c1 AS (SELECT id, chunk, coalesce(max(lang) FILTER (r = 1), 'un') AS lang1, max(lang) FILTER (r = 2) AS lang2,
      coalesce(max(score) FILTER (r = 1 AND lang IS NOT NULL), 0) AS score1,
      coalesce(max(score) FILTER (r = 2 AND lang IS NOT NULL), 0) AS score2,
      sum(hits)::BIGINT AS grams, sum(bytes)::BIGINT AS bytes FROM rk GROUP BY id, chunk),
    c2 AS (SELECT c1.*, score_per_kb AS e, (score1 * 1024) // greatest(bytes, 1) AS a,
      least(greatest(grams * 5 // 8, 3), 16) AS need, CASE WHEN grams < 8 THEN grams * 12 ELSE 100 END AS most
      FROM c1 LEFT JOIN ex ON ex.lang = lang1),
    cl AS (SELECT id, chunk, lang1, lang2, score1, score2, grams, bytes,
      CASE WHEN score1 - score2 >= need THEN most WHEN score1 <= score2 THEN 0
        ELSE least(most, (score1 - score2) * 100 // need) END::INTEGER AS delta,
      CASE WHEN e IS NULL OR e = 0 THEN 100 WHEN a = 0 THEN 0 WHEN greatest(a, e) * 2 <= least(a, e) * 3 THEN 100
        WHEN greatest(a, e) > least(a, e) * 4 THEN 0
        ELSE floor((4 - greatest(a, e) / least(a, e)) * 40 + 1e-9) END::INTEGER AS expected FROM c2),
    ck AS (SELECT *, least(delta, expected) AS reliability FROM cl),
    dt AS (SELECT id, lang1 AS lang, sum(bytes)::BIGINT AS bytes, sum(score1)::BIGINT AS score,
      sum(reliability * bytes)::BIGINT AS rel FROM ck GROUP BY ALL)"""


def _top3_sql(source: str, total: str) -> str:
    """CTEs from ``source(id, lang, bytes, score)`` and ``total(id, tb)`` to ``t4``."""
    return f"""tr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY bytes DESC, lang) AS r FROM {source} WHERE lang <> 'un'),
    t1 AS (SELECT id, any_value(tb) AS tb0,
      {", ".join(f"coalesce(max(lang) FILTER (r = {i}), 'un') AS lang{i}, coalesce(max(bytes) FILTER (r = {i}), 0) AS b{i}, coalesce(max(score) FILTER (r = {i}) * 1024 // greatest(max(bytes) FILTER (r = {i}), 1), 0) AS score{i}" for i in (1, 2, 3))}
      FROM {total} LEFT JOIN tr USING (id) GROUP BY id),
    t2 AS (SELECT *, greatest(tb0, b1 + b2 + b3)::BIGINT AS text_bytes FROM t1),
    t3 AS (SELECT *, (b1 * 100 // greatest(text_bytes, 1))::INTEGER AS q1,
      ((b1 + b2) * 100 // greatest(text_bytes, 1) - b1 * 100 // greatest(text_bytes, 1))::INTEGER AS q2,
      ((b1 + b2 + b3) * 100 // greatest(text_bytes, 1) - (b1 + b2) * 100 // greatest(text_bytes, 1))::INTEGER AS q3 FROM t2),
    t3b AS (SELECT * EXCLUDE (q2, q3), CASE WHEN q2 < q3 THEN q2 + 1 ELSE q2 END AS q2, CASE WHEN q2 < q3 THEN q3 - 1 ELSE q3 END AS q3 FROM t3),
    t4 AS (SELECT id, text_bytes, lang1, lang2, lang3, score1, score2, score3,
      CASE WHEN q1 < q2 THEN q1 + 1 ELSE q1 END AS percent1, CASE WHEN q1 < q2 THEN q2 - 1 ELSE q2 END AS percent2, q3 AS percent3 FROM t3b)"""


def _summary_sql(best_effort: bool = False) -> str:
    figs, efigs = "('fr', 'it', 'de', 'es')", "('en', 'fr', 'it', 'de', 'es')"
    small = "false" if best_effort else "p < 26"
    return f"""s1 AS (SELECT *, lang2 <> 'un' AND text_bytes * percent2 // 100 >= 15 AND
        ((lang1 = 'en' AND lang2 <> 'en' AND percent2 >= 17) OR (lang1 IN {figs} AND lang2 NOT IN {efigs} AND percent2 >= 20)) AS sec,
        (lang2 = 'en' AND lang1 <> 'en') OR (lang2 IN {figs} AND lang1 NOT IN {efigs}) AS les FROM t4),
    s2 AS (SELECT *, CASE WHEN sec THEN percent2 * 100 // (101 - percent1) WHEN les THEN percent1 * 100 // (101 - percent2)
        ELSE percent1 END AS p FROM s1),
    s3 AS (SELECT *, CASE WHEN {small} THEN 'un' WHEN sec THEN lang2 ELSE lang1 END AS lang,
        percent1 >= 2 AND NOT ({small}) AND p >= 51 AND 100 - (percent1 + percent2 + percent3) <= 20 AS reliable FROM s2)"""


def _verdict_sql(base: str = _DOCS, quads: bool = False, best_effort: bool = False, hints: str = "") -> str:
    keep = "true" if best_effort else "rel // greatest(bytes, 1) >= 41"
    return f"""{_chunks_sql(base, quads, hints)}, kp AS (SELECT * FROM dt WHERE {keep}),
    tt AS (SELECT id, sum(bytes)::BIGINT AS tb FROM dt GROUP BY id), {_top3_sql("kp", "tt")}, {_summary_sql(best_effort)}"""


_DETAILS = ", ".join(DETAILS)
_TOTALS = f"""WITH tot AS (SELECT {GROUP} AS grp, {RELABEL} AS lang, sum(n_chars)::BIGINT AS bytes, count(*) AS score,
    sum(n_chars * ({PERCENT}))::BIGINT AS rel FROM documents GROUP BY ALL)"""
_TOTALS_TOP = f"""{_TOTALS}, sr AS (SELECT grp AS id, lang, bytes, score FROM tot),
    tt AS (SELECT grp AS id, sum(bytes)::BIGINT AS tb FROM tot GROUP BY grp), {_top3_sql("sr", "tt")}"""

_PRIORS = """WITH d AS (SELECT doc_id, lang,
    CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN lang || ',ms' WHEN 2 THEN 'da-dk' WHEN 3 THEN lang || '-XX,' || lang ELSE 'czech,xx' END AS tags,
    CASE doc_id % 3 WHEN 0 THEN lang WHEN 1 THEN 'ch' ELSE 'com' END AS tld,
    CASE doc_id % 4 WHEN 0 THEN 'ja' END AS enc, CASE doc_id % 7 WHEN 0 THEN lang END AS stated FROM documents),
  tagp(tag, lang, weight) AS (VALUES ('en','en',4), ('fr','fr',10), ('de','de',10), ('es','es',10), ('ms','ms',10), ('ms','id',-4),
    ('da','da',10), ('da','no',-4), ('czech','cs',10), ('czech','sk',-4)),
  tldp(tld, lang, weight) AS (VALUES ('fr','fr',4), ('de','de',4), ('es','es',4), ('ch','de',4), ('ch','fr',4)),
  h AS (SELECT doc_id, tagp.lang, max(weight) AS weight, 0 AS k FROM (SELECT doc_id, unnest(string_split(tags, ',')) AS t FROM d) JOIN tagp
      ON tagp.tag = CASE WHEN t = 'czech' THEN t ELSE split_part(t, '-', 1) END GROUP BY 1, 2
    UNION ALL SELECT doc_id, tldp.lang, weight, 1 FROM d JOIN tldp USING (tld)
    UNION ALL SELECT doc_id, enc, 4, 2 FROM d WHERE enc IS NOT NULL
    UNION ALL SELECT doc_id, stated, 8, 3 FROM d WHERE stated IS NOT NULL),
  g AS (SELECT doc_id, lang, (arg_min(weight, k) + 2 * (count(*) - 1))::INTEGER AS weight, min(k) AS k FROM h GROUP BY doc_id, lang),
  pr AS (SELECT doc_id, lang, weight FROM g)"""

# Chunk scores with every positive hint of the text added.
_HINTED = f"""{_PRIORS[5:]}, al AS (SELECT id, chunk, lang, score, hits, bytes FROM cs
      UNION ALL SELECT id, chunk, lang, weight, 0, 0 FROM (SELECT DISTINCT id, chunk FROM cs)
      JOIN pr ON pr.doc_id = id WHERE weight > 0),
    ch AS (SELECT id, chunk, lang, sum(score)::BIGINT AS score, sum(hits)::BIGINT AS hits, sum(bytes)::BIGINT AS bytes
      FROM al GROUP BY ALL)"""

_CHUNK_COLUMNS = "id AS doc_id, chunk, lang1, lang2, score1, score2, grams, bytes, delta, expected, reliability"
_SCORE_COLUMNS = "id AS doc_id, chunk, lang, score, hits, bytes"


def _islands_sql(source: str, lang: str, size: str, key: str, order: str) -> str:
    return f"""i1 AS (SELECT {key} AS k, {order} AS o, {lang} AS lang, {size} AS size FROM {source}),
    i2 AS (SELECT *, CASE WHEN lag(lang) OVER (PARTITION BY k ORDER BY o) IS NOT DISTINCT FROM lang THEN 0 ELSE 1 END AS new FROM i1),
    i3 AS (SELECT *, sum(new) OVER w - 1 AS span, sum(size) OVER w AS upto FROM i2
      WINDOW w AS (PARTITION BY k ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT k AS {key.split(" ")[0]}, span::BIGINT AS span, min(upto - size)::BIGINT AS "offset", sum(size)::BIGINT AS bytes,
      any_value(lang) AS lang FROM i3 GROUP BY k, span"""


_CLOSE = """CASE WHEN lang IN ('es', 'pt', 'gl') THEN 1 WHEN lang IN ('cs', 'sk') THEN 2 WHEN lang IN ('no', 'nn') THEN 3
    WHEN lang = 'id' THEN 4 END"""
_ALT = "CASE lang WHEN 'es' THEN 'gl' WHEN 'gl' THEN 'es' WHEN 'cs' THEN 'sk' WHEN 'sk' THEN 'cs' WHEN 'no' THEN 'nn' WHEN 'nn' THEN 'no' WHEN 'ru' THEN 'bg' WHEN 'bg' THEN 'ru' END"


def _repeated_sql(source: str) -> str:
    return rf"""WITH l AS (SELECT doc_id, string_split(trim(lower(regexp_replace(text, '[^\p{{L}}\p{{M}}]+', ' ', 'g'))), ' ') AS ws FROM ({source})),
        u AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS w, ws FROM l),
        c AS (SELECT doc_id, pos, w, CASE WHEN pos >= 4 THEN array_to_string(ws[pos - 3:pos], ' ') END AS ctx FROM u),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ctx ORDER BY pos) AS n FROM c)
        SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS text FROM r WHERE ctx IS NULL OR n = 1 GROUP BY doc_id"""


_SQUEEZED = """WITH b AS (SELECT doc_id, list_transform(range((length(text) + 47) // 48), lambda i: substr(text, i * 48 + 1, 48)) AS blocks FROM {texts})
    SELECT doc_id, array_to_string(list_filter(blocks, lambda x:
      (length(x) - length(replace(x, ' ', ''))) * 100 / length(x) < 25
      AND CASE WHEN length(x) < 3 THEN true ELSE
        (length(x) - 2 - len(list_distinct(list_transform(range(length(x) - 2), lambda k: substr(x, k + 1, 3))))) * 100 / (length(x) - 2) < 40 END), '') AS text
    FROM b"""
# where a chunk's language begins, by the words' scores for it and for the language before
_BORDERS = """pb AS (SELECT id, chunk, lang1 AS aft, lag(lang1) OVER (PARTITION BY id ORDER BY chunk) AS bef FROM ck),
    pp AS (SELECT *, unnest([chunk - 1, chunk]) AS ofc FROM pb WHERE bef <> aft),
    sc AS (SELECT pp.id, pp.chunk, pos, coalesce(sum(CASE lang WHEN bef THEN weight WHEN aft THEN -weight END), 0) AS lead
      FROM hi JOIN pp ON hi.id = pp.id AND hi.chunk = ofc GROUP BY ALL),
    ru AS (SELECT *, sum(lead) OVER (PARTITION BY id, chunk ORDER BY pos) AS run FROM sc),
    bo AS (SELECT id, chunk, pos + 1 AS border FROM ru
      QUALIFY row_number() OVER (PARTITION BY id, chunk ORDER BY run DESC, pos DESC) = 1)"""
# whole texts and their first words
_BOTH = r"""SELECT doc_id * 2 AS doc_id, text FROM documents
    UNION ALL SELECT doc_id * 2 + 1, regexp_extract(text, '\p{L}+') FROM documents"""
_FIRST = f"""{_verdict_sql(f"SELECT doc_id AS id, '' AS gold, text FROM ({_BOTH})")} SELECT id AS doc_id, lang, reliable, percent1, percent2 FROM s3"""
_WEAK = f"SELECT doc_id FROM ({_FIRST}) WHERE NOT (reliable AND (percent1 >= 70 OR percent1 + percent2 >= 93))"
_AGAIN = f"SELECT doc_id AS id, '' AS gold, text FROM ({_repeated_sql(f'SELECT * FROM ({_SQUEEZED.format(texts=f"({_BOTH})")}) WHERE doc_id IN ({_WEAK})')})"
_REFINED = f"""SELECT a.doc_id, coalesce(b.lang, a.lang) AS lang, coalesce(b.reliable, a.reliable) AS reliable
    FROM ({_FIRST}) a LEFT JOIN ({_verdict_sql(_AGAIN)} SELECT id AS doc_id, lang, reliable FROM s3) b ON a.doc_id = b.doc_id"""

ENTRIES = {
    "script_spans": (
        script_spans,
        r"""SELECT doc_id, 0 AS span_no, 'Latin' AS script, 'many' AS rtype,
        trim(lower(regexp_replace(text, '[^\p{L}\p{M}]+', ' ', 'g'))) AS span
        FROM documents WHERE regexp_matches(text, '\p{L}')""",
    ),
    "word_grams": (
        word_grams,
        f"WITH {_units_sql('u', _DOCS)} SELECT 'w:' || left(unit, 8) AS gram, count(*) AS n FROM u GROUP BY 1",
    ),
    "word_pairs": (
        word_pairs,
        f"""WITH {_units_sql("u", _DOCS)}, p AS (SELECT unit, lag(unit) OVER (PARTITION BY id ORDER BY pos) AS prev FROM u)
        SELECT 'p:' || left(prev, 8) || ' ' || left(unit, 8) AS gram, count(*) AS n FROM p WHERE prev IS NOT NULL GROUP BY 1""",
    ),
    "quad_grams": (
        quad_grams,
        f"""WITH RECURSIVE {_units_sql("u", _DOCS)}, words AS (SELECT unit, count(*) AS n FROM u GROUP BY unit), {_walk_sql("walk", "words")}
        SELECT gram, sum(n)::BIGINT AS n FROM walk JOIN words USING (unit) GROUP BY 1""",
    ),
    "cjk_grams": (
        cjk_grams,
        f"""WITH l AS (SELECT doc_id AS id, string_split(text, '') AS u FROM documents WHERE text <> ''),
        p AS (SELECT id, len(u) AS n, unnest(range(len(u))) AS pos, unnest(u) AS unit FROM l),
        c AS (SELECT id, pos, unit, lag(unit) OVER (PARTITION BY id ORDER BY pos) AS prev,
          {_CHUNK.replace("20", "50").replace("60", "150").replace("40", "100")} AS chunk FROM p)
        SELECT 'u:' AS kind, chunk, count(*) AS n, count(DISTINCT unit) AS grams FROM c GROUP BY chunk
        UNION ALL SELECT 'b:', chunk, count(*), count(DISTINCT prev || unit) FROM c WHERE prev IS NOT NULL GROUP BY chunk""",
    ),
    "lang_train_grams": (lang_train_grams, f"{_model_sql()} SELECT gram, lang, weight, rank, n FROM md"),
    "lang_expected_scores": (lang_expected_scores, f"{_model_sql()} SELECT lang, score_per_kb FROM ex"),
    "chunk_scores": (chunk_scores, f"{_score_sql()} SELECT {_SCORE_COLUMNS} FROM cs"),
    "chunk_reliability": (chunk_reliability, f"{_chunks_sql()} SELECT {_CHUNK_COLUMNS} FROM ck"),
    "lang_byte_totals": (
        lang_byte_totals,
        f"{_chunks_sql()} SELECT id AS doc_id, lang, bytes, score, rel FROM dt",
    ),
    "lang_detect_words": (
        lang_detect_words,
        f"{_verdict_sql()} SELECT id AS doc_id, lang, reliable, {_DETAILS} FROM s3",
    ),
    "lang_detect": (
        lang_detect,
        f"{_verdict_sql(quads=True)} SELECT id AS doc_id, lang, reliable, {_DETAILS} FROM s3",
    ),
    "lang_detect_best_effort": (
        lang_detect_best_effort,
        f"{_verdict_sql(best_effort=True)} SELECT id AS doc_id, lang, reliable FROM s3",
    ),
    "lang_accuracy": (
        lang_accuracy,
        f"""{_verdict_sql()} SELECT documents.lang AS stated, s3.lang, count(*) AS texts FROM documents
        JOIN s3 ON s3.id = doc_id WHERE reliable GROUP BY ALL""",
    ),
    "close_pair_merge": (
        close_pair_merge,
        f"""{_TOTALS}, c AS (SELECT *, coalesce({_CLOSE}::VARCHAR, lang) AS s FROM tot),
        f AS (SELECT *, first_value(lang) OVER (PARTITION BY grp, s ORDER BY bytes DESC, lang) AS top FROM c)
        SELECT grp, top AS lang, sum(bytes)::BIGINT AS bytes, sum(score)::BIGINT AS score, sum(rel)::BIGINT AS rel FROM f GROUP BY 1, 2""",
    ),
    "drop_unreliable": (
        drop_unreliable,
        f"""{_TOTALS}, a AS (SELECT *, rel // bytes AS pct, {_ALT} AS alt FROM tot),
        p AS (SELECT x.grp, x.lang, x.bytes, x.score, x.rel, x.pct, y.lang AS ol, y.bytes AS ob, y.pct AS op FROM a x LEFT JOIN a y
          ON x.grp = y.grp AND x.lang <> y.lang AND ((x.pct < 41 AND x.alt = y.lang) OR (y.pct < 41 AND y.alt = x.lang))),
        r AS (SELECT grp, lang, bytes, score, rel, pct, count(ol) AS others, sum(ob) AS ob, max(op) AS op,
          coalesce(bool_or(op > pct OR (op = pct AND ol < lang)), false) AS lost FROM p GROUP BY ALL),
        v AS (SELECT grp, lang, bytes, CASE WHEN others = 0 THEN score ELSE bytes + ob END AS score,
          CASE WHEN others = 0 THEN rel ELSE greatest(pct, op, 41) * (bytes + ob) END AS rel FROM r WHERE NOT lost)
        SELECT grp, lang, bytes, score::BIGINT AS score, rel::BIGINT AS rel FROM v WHERE rel // bytes >= 41""",
    ),
    "lang_top3_percent": (lang_top3_percent, f"{_TOTALS_TOP} SELECT id AS grp, * EXCLUDE (id) FROM t4"),
    "lang_summary": (
        lang_summary,
        f"{_TOTALS_TOP}, {_summary_sql()} SELECT id AS grp, lang, reliable FROM s3",
    ),
    "lang_summary_best_effort": (
        lang_summary_best_effort,
        f"{_TOTALS_TOP}, {_summary_sql(True)} SELECT id AS grp, lang, reliable FROM s3",
    ),
    "lang_spans": (
        lang_spans,
        f"""{_verdict_sql(_TURNS)}, cv AS (SELECT conv_id, turn, coalesce(s3.lang, 'un') AS vl, strlen(text) AS b
          FROM conversations LEFT JOIN s3 ON s3.id = conv_id * 1000000 + turn),
        {_islands_sql("cv", "vl", "b", "conv_id", "turn")}""",
    ),
    "document_spans": (
        document_spans,
        f"""{_chunks_sql()}, dd AS (SELECT id AS doc_id, chunk, CASE WHEN reliability >= 50 THEN lang1 ELSE 'un' END AS vl, bytes AS b FROM ck),
        {_islands_sql("dd", "vl", "b", "doc_id", "chunk")}""",
    ),
    "text_spans": (
        text_spans_cut,
        rf"""{_chunks_sql(_NEXT)}, {_BORDERS},
        -- where the words stand: running sums over words and the gaps before them
        wg AS (SELECT id, regexp_extract_all(text, '[\p{{L}}\p{{M}}]+') AS ws, regexp_split_to_array(text, '[\p{{L}}\p{{M}}]+') AS gs, text FROM ({_NEXT})),
        wr AS (SELECT id, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS w, unnest(list_slice(gs, 1, len(ws))) AS g FROM wg),
        wp AS (SELECT id, k, lower(w) AS w, sum(length(w) + length(g)) OVER (PARTITION BY id ORDER BY k) AS stop, length(w) AS size FROM wr),
        wf AS (SELECT * FROM wp QUALIFY w IS DISTINCT FROM lag(w) OVER (PARTITION BY id ORDER BY k)
          AND w IS DISTINCT FROM lag(w, 2) OVER (PARTITION BY id ORDER BY k)),
        wn AS (SELECT id, stop - size AS start, stop, row_number() OVER (PARTITION BY id ORDER BY k) - 1 AS pos, count(*) OVER (PARTITION BY id) AS n FROM wf),
        wc AS (SELECT *, {_CHUNK} AS chunk FROM wn),
        cb AS (SELECT id, chunk, min(start) AS start, max(stop) AS stop FROM wc GROUP BY ALL),
        st AS (SELECT ck.id, ck.chunk, CASE WHEN reliability >= 50 THEN lang1 ELSE 'un' END AS vl,
            CASE WHEN bo.border IS NULL THEN cb.start ELSE coalesce(wc.start, cb.stop) END AS beg
          FROM ck JOIN cb ON cb.id = ck.id AND cb.chunk = ck.chunk
          LEFT JOIN bo ON bo.id = ck.id AND bo.chunk = ck.chunk LEFT JOIN wc ON wc.id = bo.id AND wc.pos = bo.border),
        mo AS (SELECT id, chunk, vl, CASE WHEN row_number() OVER (PARTITION BY id ORDER BY chunk) = 1 THEN 0
            ELSE max(beg) OVER (PARTITION BY id ORDER BY chunk) END AS beg FROM st),
        nx AS (SELECT mo.id AS doc_id, chunk, vl, coalesce(lead(beg) OVER (PARTITION BY mo.id ORDER BY chunk), length(text)) - beg AS size
          FROM mo JOIN wg ON wg.id = mo.id),
        sp AS ({_islands_sql("(SELECT * FROM nx WHERE size > 0)", "vl", "size", "doc_id", "chunk").replace("i1 AS", "WITH i1 AS", 1)})
        SELECT doc_id, span, "offset" AS start, bytes AS length, lang, sha256(substr(text, "offset" + 1, bytes)) AS piece
        FROM sp JOIN wg ON wg.id = doc_id""",
    ),
    "span_borders": (
        span_borders,
        f"{_chunks_sql(_NEXT)}, {_BORDERS} SELECT id AS doc_id, chunk, border FROM bo",
    ),
    "language_priors": (priors, f"{_PRIORS} SELECT doc_id, lang, weight FROM pr"),
    "language_priors_pages": (
        page_priors,
        """SELECT page_id, tag AS lang, CASE tag WHEN 'en' THEN 4 ELSE 10 END::INTEGER AS weight
        FROM (SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS tag FROM pages) WHERE tag <> ''""",
    ),
    "lang_detect_hinted": (
        lang_detect_hinted,
        f"{_verdict_sql(hints=_HINTED)} SELECT id AS doc_id, lang, reliable, {_DETAILS} FROM s3",
    ),
    "chunk_scores_with_priors": (
        chunk_scores_with_priors,
        f"{_score_sql()}, {_HINTED} SELECT {_SCORE_COLUMNS} FROM ch",
    ),
    "chunk_scores_with_boost": (
        chunk_scores_with_boost,
        f"""{_score_sql()}, sg AS (SELECT id, chunk, pos, any_value(lang) AS lang, any_value(weight) AS weight FROM hi
          WHERE starts_with(gram, 'w:') AND lang IS NOT NULL GROUP BY id, chunk, pos HAVING count(*) = 1),
        nb AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM sg),
        up AS (SELECT id, chunk, max(k) AS upto FROM (SELECT DISTINCT id, chunk FROM cs) LEFT JOIN nb USING (id, chunk) GROUP BY ALL),
        bf AS (SELECT id, chunk, max(upto) OVER (PARTITION BY id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM up),
        al AS (SELECT * FROM cs UNION ALL SELECT bf.id, bf.chunk, lang, weight, 0, 0 FROM bf JOIN nb ON nb.id = bf.id AND k BETWEEN seen - 3 AND seen)
        SELECT id AS doc_id, chunk, lang, sum(score)::BIGINT AS score, sum(hits)::BIGINT AS hits, sum(bytes)::BIGINT AS bytes
        FROM al GROUP BY ALL""",
    ),
    "repeated_words": (repeated_words, f"{_repeated_sql('SELECT doc_id, text FROM documents')}"),
    "squeezed_text": (squeezed_text, _SQUEEZED.format(texts="documents")),
    "lang_refined": (lang_refined, _REFINED),
}
