"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlloom.llm import (
    decontam, embeddings, langid, linededup, mixing, neardup, packing, quotes, ranking, resampling, secrets, toxicity, urls,
)
from crawlloom.llm.shared import held, table
from crawlloom.session import scratch_path


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held(F.col("doc_id"), 4) == 2
    model = langid.train(docs.filter(~out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), similarity=0.85)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("url")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~out))
    found = toxicity.score(docs, model)
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = secrets.Ledger(spark, scratch_path(spark, "secret-ledger"))
    # an earlier version of the corpus, half of it, and then all: the second scans what is new
    ledger.ingest(docs.filter(held(F.col("doc_id"), 2) == 0))
    ledger.ingest(docs)
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets.findings(docs, ledger).select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


def mailbox(conversations: DataFrame) -> DataFrame:
    """Turns as mails: each quotes the turn before it, and that turn's own quote."""
    turns = conversations.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    last = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("last"))
    older = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("older"))
    both = turns.join(last, ["conv_id", "turn"], "left").join(older, ["conv_id", "turn"], "left")

    def quoted(mark: str, text: str):
        return F.concat(F.lit(mark), F.replace(F.col(text), F.lit("\n"), F.lit("\n" + mark)))

    return both.select("conv_id", "turn", F.concat_ws("\n", quoted(">> ", "older"), quoted("> ", "last"), "text").alias("text"))


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotes.link_quotes(mailbox(table(spark, sf_dir, "conversations")))
    return linked.select(
        "conv_id", "turn", F.coalesce("reply_to", F.lit(-1)).alias("reply_to"), "thread", "depth", "n_quoted",
        F.sha2("body", 256).alias("body_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_row")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _address_sql(url: str) -> str:
    """An address without fragment, scheme and host in lower case, dot segments resolved."""
    bare = f"regexp_replace({url}, '(?s)#.*$', '')"

    def part(n: int) -> str:
        return rf"regexp_extract({bare}, '(?s)^([A-Za-z][A-Za-z0-9+.-]*://)((?:[^/?#]*@)?)([^/?#]*)([^?#]*)(.*)$', {n})"

    path = part(4)
    segments = f"string_split({path}, '/')"
    walked = f"""list_reduce(list_transform({segments}, lambda x: [x]), lambda done, x: CASE WHEN x[1] = '.' THEN done
      WHEN x[1] = '..' THEN list_slice(done, 1, greatest(1, len(done) - 1)) ELSE list_concat(done, x) END)"""
    ended = f"CASE WHEN {segments}[-1] IN ('.', '..') THEN list_concat({walked}, ['']) ELSE {walked} END"
    resolved = rf"CASE WHEN regexp_matches({path}, '/\.\.?(?:/|$)') THEN array_to_string({ended}, '/') ELSE {path} END"
    full = f"concat(translate({part(1)}, {_ABC}), {part(2)}, translate({part(3)}, {_ABC}), {resolved}, {part(5)})"
    return f"CASE WHEN regexp_matches({bare}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {full} ELSE {bare} END"


# Page addresses, the links between them, and the decisions that reach their component.
def _judge_sql(pages: str, redirects: str = "SELECT NULL::VARCHAR AS src, NULL::VARCHAR AS dst WHERE false") -> str:
    return (
        r"""
WITH RECURSIVE the_pages AS (PAGES), given AS (REDIRECTS), rules(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')
), found AS (
  SELECT url AS base, unnest(list_concat(
      list_transform(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
        lambda t: concat(regexp_extract(t, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1),
                    regexp_extract(t, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2),
                    regexp_extract(t, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3))),
      list_transform(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
        lambda t: regexp_extract(t, '(?is)\burl\s*=\s*[''"]?([^''"\s>]+)', 1)))) AS raw
  FROM the_pages WHERE contains(url, '://')
), hrefs AS (
  SELECT base, replace(trim(raw), '&amp;', '&') AS href FROM found WHERE trim(raw) <> ''
), absolute AS (
  SELECT base AS src, CASE
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
    WHEN starts_with(href, '#') THEN base
    WHEN starts_with(href, '//') THEN concat(regexp_extract(base, '(?s)^(.*?)://', 1), ':', href)
    WHEN starts_with(href, '/') THEN concat(regexp_extract(base, '(?s)^(.*?://[^/?#]*)', 1), href)
    WHEN starts_with(href, '?') THEN concat(regexp_extract(base, '(?s)^([^?#]*)', 1), href)
    ELSE concat(rtrim(regexp_extract(base, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/'), '/', href) END AS dst
  FROM hrefs UNION ALL SELECT src, dst FROM given
), edges AS (SELECT DISTINCT SRC AS src, DST AS dst FROM absolute
), ways AS (
  SELECT src AS a, dst AS b FROM edges WHERE src <> dst UNION SELECT dst, src FROM edges WHERE src <> dst
), reach AS (
  SELECT a, a AS b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
), parts AS (
  SELECT DISTINCT u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM (SELECT url AS u FROM the_pages WHERE url IS NOT NULL UNION SELECT b FROM reach)
), ruled AS (
  SELECT u, any_value(host) AS host, any_value(path) AS path, max_by(rule, length(rule)) AS rule,
    max_by(verdict, length(rule)) AS verdict
  FROM parts LEFT JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY u
), carried AS (
  SELECT a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM reach JOIN ruled ON reach.b = ruled.u GROUP BY a
), addressed AS (SELECT page_id, url, OWN AS own FROM the_pages)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(ruled.verdict, carried.verdict, 'allow') AS verdict
FROM addressed LEFT JOIN ruled ON addressed.url = ruled.u
LEFT JOIN carried ON addressed.own = carried.a
"""
        .replace("PAGES", pages).replace("REDIRECTS", redirects)
        .replace("SRC AS", f"{_address_sql('src')} AS").replace("DST AS", f"{_address_sql('dst')} AS")
        .replace("OWN AS", f"{_address_sql('url')} AS")
    )


OP4 = _judge_sql("SELECT page_id, url, html FROM pages")

# Tags that name the next page, or an address that looks like something else, by page_id.
ALIAS_TAGS = """CASE page_id % 7
  WHEN 0 THEN concat('<link rel="canonical" href="', replace(replace(more, 'https://', 'HTTPS://WWW.'), 'http://', 'Http://'), '#top">')
  WHEN 1 THEN concat('<meta http-equiv=refresh content="0; url=', more, '">')
  WHEN 2 THEN concat('<LINK href="', regexp_replace(more, '(://[^/]*)', '\\1/x/./..'), '" rel=canonical>')
  WHEN 3 THEN '<link rel=canonical href="/go?u=http://x.com/de/1">'
  WHEN 4 THEN '<link rel=canonical href="#part">'
  WHEN 5 THEN '<link rel=canonical href="//moved.example.com/de/../de/7">'
  ELSE '' END"""


def url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that name the next page as their address, in other spellings, and redirects between some."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    more = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("more"))
    both = pages.join(more, "page_id", "left")
    tags = F.coalesce(F.expr(ALIAS_TAGS.replace("'\\1", "'$1")), F.lit(""))
    tagged = both.select("page_id", "url", F.concat("html", tags).alias("html"))
    redirects = both.filter("page_id % 7 = 6").select(F.col("url").alias("src"), F.col("more").alias("dst"))
    return urls.judge(tagged, redirects).drop("url")


_TAGGED = f"""SELECT page_id, url, html || coalesce({ALIAS_TAGS}, '') AS html
  FROM pages LEFT JOIN (SELECT page_id - 1 AS page_id, url AS more FROM pages) USING (page_id)"""
_GIVEN = """SELECT p.url AS src, n.url AS dst FROM pages p JOIN pages n ON n.page_id = p.page_id + 1 WHERE p.page_id % 7 = 6"""
URL_ALIASES = _judge_sql(_TAGGED, _GIVEN)

OP7 = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    nullif(trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')), '') AS plain
  FROM conversations
), first AS (
  SELECT conv_id, plain, min(turn) AS turn FROM turns WHERE plain IS NOT NULL GROUP BY ALL
), links AS (
  SELECT t.conv_id, t.turn, t.text, f.turn AS reply_to,
    CAST(CASE WHEN p.turn IS NULL THEN 0 ELSE 1 END + CASE WHEN o.turn IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_quoted
  FROM turns t
  LEFT JOIN turns p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
  LEFT JOIN turns o ON o.conv_id = t.conv_id AND o.turn = t.turn - 2
  LEFT JOIN first f ON f.conv_id = t.conv_id AND f.plain = p.plain
), chain AS (
  SELECT conv_id, turn, turn AS thread, CAST(0 AS BIGINT) AS depth FROM links WHERE reply_to IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, c.thread, c.depth + 1 FROM links l JOIN chain c ON l.conv_id = c.conv_id AND l.reply_to = c.turn
)
SELECT conv_id, turn, coalesce(reply_to, -1) AS reply_to, thread, depth, n_quoted, sha256(text) AS body_sha256
FROM links JOIN chain USING (conv_id, turn)
"""

# Windows of ten words by joining word positions; items here all have ten words or more.
OP8 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rn,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT item_id, unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda i: array_to_string(w[i + 1 : i + 10], ' '))) AS win,
    least(len(w), 10) AS width
  FROM b WHERE len(w) > 0
), widths AS (SELECT DISTINCT width FROM bw
), dw AS (
  SELECT rn, width, unnest(range(len(w) - width + 1)) AS pos,
    unnest(list_transform(range(len(w) - width + 1), lambda i: array_to_string(w[i + 1 : i + width], ' '))) AS win
  FROM d, widths WHERE len(w) >= width
), hits AS (SELECT rn, pos, dw.width, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.width = bw.width
), words AS (
  SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(pos, pos + width)) AS p FROM hits) GROUP BY rn
), items AS (
  SELECT rn, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
  FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY rn
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)
"""

# Both sides strip the same six blanks and lower-case A-Z only.
OP9 = r"""
WITH lines AS (
  SELECT doc_id, rn, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, rn, unnest(parts) AS line, unnest(range(len(parts))) AS pos
    FROM (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  )
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.key = f.key
GROUP BY doc_id, rn
"""

# All pairs of a label in double precision, then reachability.
OP10 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, min(b) AS component_id, min(b) = vec_id AS kept
FROM reach JOIN v ON reach.a = v.vec_id GROUP BY vec_id
"""

# Every pair of an item and a document that share a term, scored in 64-bit integers.
OP12 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rn,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, row_number() OVER () AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), size AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
), asked AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(w) AS term FROM b) GROUP BY ALL
), held AS (
  SELECT rn, term, count(*) AS tf FROM (SELECT rn, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, size GROUP BY term
), m AS (SELECT rn, doc_id, 100 - 75 + ((75 * len(w) * n_docs) // n_terms) AS m FROM d, size WHERE len(w) > 0
), scores AS (
  SELECT item, rn, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN m USING (rn) GROUP BY ALL
), ranked AS (
  SELECT item, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INT) AS rank
  FROM scores JOIN m USING (rn) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN b USING (item) WHERE rank <= 10
"""

ENTRIES = {
    "op1_language": (op1_language, None),
    "op2_near_duplicates": (op2_near_duplicates, None),
    "op3_mixing": (op3_mixing, None),
    "op4_url_filter": (op4_url_filter, OP4),
    "op5_toxicity": (op5_toxicity, None),
    "op6_secrets": (op6_secrets, None),
    "op7_quotes": (op7_quotes, OP7),
    "op8_decontamination": (op8_decontamination, OP8),
    "op9_line_dedup": (op9_line_dedup, OP9),
    "op10_vectors": (op10_vectors, OP10),
    "op11_packing": (op11_packing, None),
    "op12_ranked_search": (op12_ranked_search, OP12),
    "op13_resampling": (op13_resampling, None),
    "url_aliases": (url_aliases, URL_ALIASES),
}
