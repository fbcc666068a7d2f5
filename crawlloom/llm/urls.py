"""URL filters: rules by host and path, and decisions carried over redirects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.components import components
from crawlloom.llm.shared import ascii_lower, cut

#: (host and path, verdict)
RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
#: Scheme, user, host, path and query of an address without fragment.
_PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://)((?:[^/?#]*@)?)([^/?#]*)([^?#]*)(.*)$"
#: Only addresses with a capital before the path or a segment that starts with a dot need more.
_PLAIN = r"(?s)^(?![^/?#]*[A-Z]|[^/?#]*//[^/?#]*[A-Z]|[^?#]*/\.)"
#: Tags that name another address of the page, and where the address stands in them.
_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_TARGET = r"(?is)\burl\s*=\s*['\"]?([^'\"\s>]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def address(url: Column) -> Column:
    """A URL without its fragment, scheme and host in lower case, dot segments resolved."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme, user, host, path, query = (F.regexp_extract(bare, _PARTS, g) for g in range(1, 6))
    full = F.concat(ascii_lower(scheme), user, ascii_lower(host), without_dots(path), query)
    return F.when(bare.rlike(_PLAIN) | ~bare.rlike(_SCHEME), bare).otherwise(full)


def without_dots(path: Column) -> Column:
    """A path that is empty or starts with a slash, without "." and ".." segments (RFC 3986)."""
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, 1, F.greatest(F.lit(1), F.size(acc) - 1)))
        .otherwise(F.concat(acc, F.array(x))),
    )
    end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(F.concat(kept, end), "/")).otherwise(path)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and every subdomain when the path starts with the rule's path.
    Of equally long rules allow goes first.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[1] == "allow")):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _resolved(href: Column, base: Column) -> Column:
    """An address written in a page, made absolute."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("#")), base)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(F.startswith(href, F.lit("?")), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), href))
        .otherwise(F.concat(F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/"))), href))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct (src, dst) addresses from canonical links and refresh redirects of pages."""
    html, url = F.col(html_col), F.col(url_col)
    canonical = F.transform(
        F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(0)),
        lambda tag: F.concat(*[F.regexp_extract(tag, _HREF, g) for g in (1, 2, 3)]),
    )
    refresh = F.transform(
        F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(0)), lambda tag: F.regexp_extract(tag, _TARGET, 1)
    )
    dst = F.explode(F.concat(canonical, refresh)).alias("href")
    # most pages have neither word, and a plain search is much faster than the patterns
    likely = html.rlike("(?i)canonical|refresh") & F.contains(url, F.lit("://"))
    found = pages.filter(likely).select(url.alias("base"), dst).filter(F.btrim("href") != "")
    href = F.replace(F.btrim("href"), F.lit("&amp;"), F.lit("&"))
    return (
        found.select(address(F.col("base")).alias("src"), address(_resolved(href, F.col("base"))).alias("dst"))
        .filter("src <> dst").distinct()
    )


def judge(
    pages: DataFrame,
    redirects: DataFrame | None = None,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, url, host, path, rule, verdict) for every row of ``pages``.

    Redirects (columns ``src``, ``dst``), canonical links and refresh tags make addresses
    equivalent, compared without fragment, with scheme and host in lower case and dot
    segments resolved. A page with a rule of its own gets that rule's verdict. Any other page
    gets allow if a rule allows an address of its component, block if one blocks an
    address and none allows, and allow if no rule fits any. Addresses that are only
    linked to count as well. Rules are a parameter list and become one expression.

    A null URL, or one without "://", has empty host and path, fits no rule, is in no
    component and is allowed. Null and empty HTML has no links. Repeated rows come back
    as often. An empty table gives an empty table. Other columns are not looked at.
    """
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        given = redirects.select(address(F.col("src")).alias("src"), address(F.col("dst")).alias("dst"))
        links = links.union(given.filter("src <> dst")).distinct()
    nodes = components(cut(links), "src", "dst")
    explicit = rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    nodes = cut(nodes.withColumn("own", explicit))
    decided = nodes.groupBy("component").agg(
        F.max(F.when(F.col("own") == "allow", 2).when(F.col("own") == "block", 1).otherwise(0)).alias("best")
    )
    passed_on = nodes.join(decided.filter("best = 1"), "component").select("node")
    passed_on = passed_on.withColumn("aliased", F.lit("block"))

    judged = pages.select(
        F.col(id_col), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"), address(F.col(url_col)).alias("_address"),
    )
    judged = judged.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    judged = judged.join(passed_on, judged["_address"] == passed_on["node"], "left")
    return judged.select(
        id_col, "url", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "aliased", F.lit("allow")).alias("verdict"),
    )
