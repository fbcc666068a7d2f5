"""Chat formatting: quotes of earlier messages become links and leave the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.shared import Scratch, cut

#: One quote mark with the blanks around it, at the start of a line.
_MARKS = r"^(?:[ \t]?>)+"


def quote_level(line: Column) -> Column:
    marks = F.regexp_extract(line, _MARKS, 0)
    return F.length(F.replace(F.replace(marks, F.lit(" "), F.lit("")), F.lit("\t"), F.lit("")))


def unquoted(line: Column) -> Column:
    """A line without its quote marks and the one blank that follows them."""
    return F.regexp_replace(line, _MARKS + "[ \t]?", "")


def passage_hash(text: Column) -> Column:
    """Equal for passages that differ in case, line ends and blanks only; null for blank ones."""
    plain = F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(plain != "", F.sha2(plain, 256))


def passages(messages: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """keys + (level, body, breaks, hash): the lines of each quote level of a message, in order.

    Lines of one level belong together even where replies stand between them; ``breaks``
    tells for each line whether that is so before it.
    """
    lines = F.split(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"\r\n?", "\n"), "\n", -1)
    marked = F.transform(lines, lambda x: F.struct(quote_level(x).alias("level"), unquoted(x).alias("line")))
    rows = messages.select(*keys, marked.alias("_marked"))
    before = F.transform("_marked", lambda m, i: (i > 0) & (F.get("_marked", i - 1)["level"] != m["level"]))
    rows = rows.withColumn("_marked", F.zip_with("_marked", before, lambda m, b: m.withField("cut", b)))
    levels = F.array_sort(F.array_distinct(F.transform("_marked", lambda m: m["level"])))
    rows = rows.select(*keys, "_marked", F.explode(levels).alias("level"))
    mine = F.filter("_marked", lambda m: m["level"] == F.col("level"))
    body = F.array_join(F.transform(mine, lambda m: m["line"]), "\n")
    breaks = F.transform(mine, lambda m: m["cut"])
    out = rows.select(*keys, "level", body.alias("body"), breaks.alias("breaks"))
    return out.withColumn("hash", passage_hash(F.col("body")))


def pieces(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys + (piece, weight): hashes of the runs of lines of a passage and of its lines.

    A run ends at a blank line and where another level begins. ``weight`` is the number
    of characters, so long pieces say more about where a passage is from than short ones.
    """
    lines = F.split("body", "\n", -1)
    parted = F.zip_with(lines, "breaks", lambda x, b: F.when(b, F.concat(F.lit("\n"), x)).otherwise(x))
    runs = F.split(F.array_join(parted, "\n"), r"\n\s*\n", -1)
    piece = F.explode(F.array_distinct(F.concat(runs, lines))).alias("_piece")
    hashed = parts.select(*keys, piece).withColumn("piece", passage_hash(F.col("_piece"))).filter("piece is not null")
    return hashed.groupBy(*keys, "piece").agg(F.max(F.length(F.btrim("_piece"))).cast("long").alias("weight"))


def link_quotes(
    messages: DataFrame,
    scope: Sequence[str] = ("conv_id",),
    turn_col: str = "turn",
    text_col: str = "text",
) -> DataFrame:
    """scope + (turn, body, hash, n_quoted, links, reply_to, thread, depth) for every message.

    ``body`` is the text without quotes, ``n_quoted`` the number of quote levels. Each
    passage is looked up: ``links`` has (level, turn, whole) for every level that is
    found, outermost first. A passage is from the earliest message of the scope whose own
    text has the same normalised hash, if that is before this one. A passage nobody says
    as a whole is looked up by its runs of lines and its lines, each at the earliest
    message that says it; the passage is from the one that holds most of its characters
    (of equals the earliest), and ``whole`` is false. Lines that were cut short or broken
    anew inside a shortened run are not recognised. ``reply_to`` is the turn of the
    outermost level that is found. ``thread`` is the turn the chain of
    replies starts at and ``depth`` its number of links, found by doubling the length
    of known chains each round. Sorted by thread, depth and turn, every message stands
    after the one it answers.

    A message that quotes nothing, or nothing that is known, starts a thread. Null and
    empty texts, and texts of quotes only, have an empty body and are never answered.
    Scopes may be null and are compared as such; a null turn is answered by nobody and
    answers nobody. Rows that repeat a scope and turn are told apart by their text, and
    identical rows come back once. Originals are first reduced to one row a passage, so
    a passage, and to one row a run or line, so what very many messages share makes no
    pairs. An empty table gives an empty
    table. Other columns are not looked at.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    keys = [f"_s{i}" for i in range(len(scope))] + ["_turn", "_row"]
    rows = messages.select(
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(scope)], F.col(turn_col).alias("_turn"),
        F.xxhash64(*scope, turn_col, text_col).alias("_row"), F.col(text_col).alias("_text"),
    )
    parts = scratch.put("passages", passages(rows, keys, "_text").distinct())
    within = F.xxhash64(*keys[:-2])
    own = parts.filter("level = 0").select("_row", "_turn", within.alias("_scope"), "hash")
    first = own.filter("hash is not null and _turn is not null").groupBy("_scope", "hash").agg(F.min("_turn").alias("reply_to"))
    quoted = parts.filter("level > 0 and hash is not null").select(
        "_row", "_turn", within.alias("_scope"), "level", "hash", "body", "breaks"
    )
    looked_up = scratch.put("lookups", quoted.join(first, ["_scope", "hash"], "left"))
    whole = looked_up.filter("reply_to < _turn").select("_row", "level", "reply_to", F.lit(True).alias("whole"))
    rest = looked_up.filter("(reply_to < _turn) is not true and _turn is not null").drop("reply_to")
    # only scopes in which a passage is left are cut into pieces
    said = parts.filter("level = 0 and hash is not null and _turn is not null").select(
        "_turn", within.alias("_scope"), "body", "breaks"
    )
    said = said.join(rest.select("_scope").distinct(), "_scope", "left_semi")
    earliest = pieces(said, ["_scope", "_turn"]).groupBy("_scope", "piece").agg(F.min("_turn").alias("reply_to"))
    votes = pieces(rest, ["_row", "_turn", "_scope", "level"]).join(earliest, ["_scope", "piece"]).filter("reply_to < _turn")
    votes = votes.groupBy("_row", "level", "reply_to").agg(F.sum("weight").alias("weight"))
    partial = votes.groupBy("_row", "level").agg(F.min_by("reply_to", F.struct(-F.col("weight"), "reply_to")).alias("reply_to"))
    found = whole.union(partial.select("_row", "level", "reply_to", F.lit(False).alias("whole")))
    links = found.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("level", F.col("reply_to").alias("turn"), "whole"))).alias("links")
    )
    links = links.withColumn("reply_to", F.col("links")[0]["turn"])

    facts = parts.groupBy(keys).agg(
        F.max(F.when(F.col("level") == 0, F.col("body"))).alias("body"),
        F.max(F.when(F.col("level") == 0, F.col("hash"))).alias("hash"),
        F.sum(F.when(F.col("level") > 0, 1).otherwise(0)).alias("n_quoted"),
    )
    facts = facts.join(links, "_row", "left").withColumn("_scope", within)
    facts = scratch.put("facts", facts)
    chain = _chains(facts.select("_scope", "_turn", "reply_to").filter("reply_to is not null"))
    out = facts.join(chain.select("_scope", "reply_to", "thread", "depth").distinct(), ["_scope", "reply_to"], "left")
    return out.select(
        *[F.col(f"_s{i}").alias(c) for i, c in enumerate(scope)], F.col("_turn").alias(turn_col),
        F.coalesce("body", F.lit("")).alias("body"), "hash", F.col("n_quoted").cast("long").alias("n_quoted"),
        F.coalesce("links", F.array().cast(facts.schema["links"].dataType)).alias("links"), "reply_to", F.coalesce("thread", "_turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def _chains(links: DataFrame) -> DataFrame:
    """(scope, turn, reply_to, thread, depth), each round following twice as many links."""
    # rows that share a turn continue the chain of the one that answers earliest
    hop = links.groupBy("_scope", "_turn").agg(F.min("reply_to").alias("up"))
    active = cut(links.withColumn("up", F.col("reply_to")).withColumn("depth", F.lit(1)).distinct())
    growing, ended, done = cut(hop.withColumn("n", F.lit(1))), [], []
    while True:
        known = growing
        for part in ended:
            known = known.union(part)
        known = known.select("_scope", F.col("_turn").alias("up"), F.col("up").alias("next"), F.col("n").alias("m"))
        moved = cut(active.join(known, ["_scope", "up"], "left"))
        # rows and jumps that have come to the start of their thread take no further part
        done.append(moved.filter("next is null").select("_scope", "_turn", "reply_to", F.col("up").alias("thread"), "depth"))
        active = moved.filter("next is not null").select(
            "_scope", "_turn", "reply_to", F.col("next").alias("up"), (F.col("depth") + F.col("m")).alias("depth")
        )
        if not active.head(1):
            break
        jumps = cut(growing.join(known, ["_scope", "up"], "left"))
        ended.append(jumps.filter("next is null").select("_scope", "_turn", "up", "n"))
        growing = jumps.filter("next is not null").select(
            "_scope", "_turn", F.col("next").alias("up"), (F.col("n") + F.col("m")).alias("n")
        )
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def conversations(linked: DataFrame, scope: Sequence[str] = ("conv_id",), turn_col: str = "turn") -> DataFrame:
    """Linked messages, scope by scope, with replies after what they answer.

    A sort by ranges, so a conversation of any length is spread over as many tasks as it fills.
    """
    return linked.orderBy(*scope, "thread", "depth", turn_col)
