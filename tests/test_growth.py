"""Steps that must hold on larger tables: how their tables are laid out, what a task holds, what is shuffled."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlloom.catalog import files, language
from crawlloom.functions import html, markup
from crawlloom.llm import ranking
from crawlloom.operators.langid import placed, spans
from crawlloom.operators.langid.grams import chunk_units, script_spans, span_chunks, span_units, text_grams, unit_places
from crawlloom.operators.langid.model import train
from crawlloom.operators.langid.refine import distinct_boost, drop_repeated_words, gram_hits
from crawlloom.operators.langid.score import chunk_language, chunk_scores, score_texts
from crawlloom.operators.langid.spans import refine_boundaries, text_spans
from crawlloom.sources import archive
from crawlloom.sources import files as sources
from crawlloom.sources.warc import read_warc


@pytest.fixture
def documents(spark, folder):
    """A folder with the table ``documents``, as one file or as a folder of part files."""

    def write(parts):
        rows = spark.range(0, 40, 1, parts).selectExpr("id AS doc_id", "concat('text ', id % 30) AS text")
        rows.write.parquet(f"{folder}/{parts}/documents.parquet")
        rows.limit(1).write.parquet(f"{folder}/{parts}/documents_more.parquet")
        return f"{folder}/{parts}"

    return write


def test_table_of_part_files_is_streamed(spark, documents):
    got = files.incremental_stream(spark, documents(4)).agg(F.count("*"), F.max("doc_id")).first()
    assert tuple(got) == (30, 29)


def test_table_of_part_files_is_streamed_with_state(spark, documents):
    got = files.incremental_state(spark, documents(4)).agg(F.count("*"), F.max("doc_id")).first()
    assert tuple(got) == (30, 29)


def test_places_look_at_the_whole_text_once_a_span(spark):
    df = spark.createDataFrame([(1, "ein Haus und η γλώσσα"), (2, "12"), (3, None)], "id int, text string")
    places = unit_places(df, ["id"])
    assert sorted((r.span_no, r.pos, r.start, r.stop) for r in places.collect()) == [(0, 0, 0, 3), (0, 1, 4, 8), (0, 2, 9, 12), (1, 0, 13, 21)]
    plan = places._jdf.queryExecution().optimizedPlan().toString()
    # above the explode into words nothing asks for the script of the span again
    assert "RLIKE" not in plan[: plan.rindex("Generate posexplode")].rsplit("Generate posexplode", 1)[0]


def test_western_pages_stay_in_the_jvm(spark, monkeypatch):
    rows = [(bytes(range(256)), " ISO-8859-1"), (b"\xef\xbb\xbfa\x80\x81", "'latin1"), (b"a\xff", "l1\t"), (b"", "ascii"), (None, "cp1252")]
    df = spark.createDataFrame([(i, b and bytearray(b), c) for i, (b, c) in enumerate(rows)], "id int, body binary, charset string")
    monkeypatch.setattr(html, "_decode", lambda body, label: F.when(body.isNotNull(), F.raise_error(F.lit("sent to Python"))).cast("string"))
    got = df.select("id", "body", html.recode(F.col("body"), F.col("charset")).alias("text")).orderBy("id").collect()
    assert [r.text for r in got] == [None if not r.body else markup.decode(bytes(r.body), "cp1252") for r in got][:3] + ["", None]


def test_rows_are_python_strings_a_slice_at_a_time():
    held = []

    def f(x):
        held.append(x)
        return x.upper()

    rows = pa.array([None, *map(str, range(200))])
    assert html._by_slices(f, rows).to_pylist() == rows.to_pylist() and len(held) == 200
    assert html._by_slices(f, pa.array([], pa.string())).to_pylist() == []


def test_words_of_rows_of_one_key_are_looked_at_together(spark):
    df = spark.createDataFrame([(1, "a b c d x a b c d"), (1, "a b c d"), (2, None), (3, "")], "id int, text string")
    repeated = drop_repeated_words(df, ["id"])
    got = {r.id: r.text for r in repeated.collect()}
    assert got == {1: "a a b b c c d x a b c", 2: "", 3: ""}
    plan = repeated._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and "Generate" not in plan


def test_boost_reads_its_hits_once(spark):
    rows = [(1, 0, 0, p // 3, p, f"w:{p}", 0, "en" if p % 2 else "fr", 12, 1, 1) for p in range(12)]
    rows += [(1, 0, 0, 0, 1, "w:x", 0, lang, 6, n, 2) for n, lang in enumerate(("en", "de"), 1)]
    hits = spark.createDataFrame(rows, "id int, span_no int, script_no int, chunk int, pos int, gram string, unit_bytes int, lang string, weight int, rank int, langs long")
    scores = chunk_scores(hits, ["id"])
    boosted = distinct_boost(scores, hits, ["id"])
    got = {(r.chunk, r.lang): r.score for r in boosted.collect()}
    plain = {(r.chunk, r.lang): r.score for r in scores.collect()}
    # chunk 1 has three such words before it, the others four
    assert {k: v - plain.get(k, 0) for k, v in got.items()} == {
        (0, "fr"): 0, (0, "en"): 0, (0, "de"): 0, (1, "fr"): 24, (1, "en"): 12, (2, "fr"): 24, (2, "en"): 24, (3, "fr"): 24, (3, "en"): 24,
    }
    plan = boosted._jdf.queryExecution().optimizedPlan().toString()
    assert "_same" in plan and plan.count("LocalRelation") + plan.count("LogicalRDD") <= 3


def test_postings_bound_what_is_scored_at_a_time(monkeypatch):
    query = ranking.Queries(list(range(50)), ["a b"] * 50)
    bag = np.array([0, 1, 1, 1], dtype="<i4")
    monkeypatch.setattr(ranking, "CELLS", 1000)
    parts = list(ranking._parts(query, [bag] * 20, list(range(20))))
    assert [j for p in parts for j in p] == list(range(20)) and max(map(len, parts)) == 1000 // 150


def test_small_ranges_of_a_file_share_a_task(monkeypatch):
    monkeypatch.setattr(sources, "PACK_BYTES", 100)
    splits = [sources.Split(f, at, at + 30) for f in "ab" for at in range(0, 210, 30)]
    tasks = sources.packed(splits)
    assert [s for t in tasks for s in t.ranges] == splits and [len(t.ranges) for t in tasks] == [3, 3, 1] * 2
    assert all(len({s.path for s in t.ranges}) == 1 for t in tasks)


def test_crawl_archives_grow_in_number(spark, folder, monkeypatch):
    spark.range(0, 300, 1, 3).selectExpr("id AS page_id", "concat('http://x.org/', id) AS url", "repeat(uuid(), 20) AS html").write.parquet(f"{folder}/pages.parquet")
    monkeypatch.setattr(files, "ARCHIVE_BYTES", 1000)
    rows = read_warc(spark, files.warc_archive(spark, folder)).filter("warc_type = 'response'")
    assert rows.select("filename").distinct().count() > 4 and rows.count() == rows.select("record_id").distinct().count() == 300


def test_archives_are_written_at_the_speed_of_their_formats(spark, folder, monkeypatch):
    text = "".join(map(chr, range(32, 127))) * 50
    writer = archive.ArchiveWriter({"path": folder, "codec": "gz"})
    assert writer._compress(text.encode()) and archive.GZIP_LEVEL == 6
    seen = []
    compress = archive.lzma.compress
    monkeypatch.setattr(archive.lzma, "compress", lambda data, **how: seen.append(how) or compress(data, **how))
    packed = archive.ArchiveWriter({"path": folder, "codec": "xz"})._compress(text.encode())
    assert seen == [{"preset": sources.XZ_PRESET}] and archive.lzma.decompress(packed).decode() == text


def test_languages_of_a_gram_are_counted_without_unlabelled_texts(spark):
    labelled = spark.createDataFrame([("fr", "chat noir"), (None, "chat noir"), ("en", "chat room")], "lang string, text string")
    df = spark.createDataFrame([(1, "chat noir room")], "id int, text string")
    hits = gram_hits(df, train(labelled, kinds=("word",)), ["id"]).filter("gram like 'w:%'")
    assert {r.gram: r.langs for r in hits.collect()} == {"w:chat": 2, "w:noir": 1, "w:room": 1}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_are_the_only_grams_made(spark):
    df = spark.createDataFrame([(1, "to be or not to be"), (2, "a"), (3, "日本 be so")], "k int, text string")
    pairs = text_grams(df, ["k"], kinds=("word", "pair"), prefix="p:")
    everything = text_grams(df, ["k"], kinds=("word", "pair")).filter(F.col("gram").startswith("p:"))
    assert sorted(pairs.collect()) == sorted(everything.drop("unit_bytes").collect())
    # one for the spans and one for the words, none for grams
    assert plan_of(pairs).count("Generate ") == 2


def test_characters_are_cut_without_a_call_for_each(spark):
    df = spark.createDataFrame([(1, "日本 語です"), (2, "ein Wort")], "k int, text string")
    units = span_units(script_spans(df, ["k"]), ["k"])
    assert [r.unit for r in units.orderBy("k", "pos").collect()] == ["日", "日本", "本語", "語で", "です", "ein", "wort"]
    assert "transform(" not in plan_of(units.select("k", "unit")).replace("transform(array(", "")


def test_characters_move_to_han_in_one_pass(spark):
    texts = ["", None, "a\x00b", "é\u07ff \n", "\u0800 x", "\U0001d4b3y"]
    moved = spark.createDataFrame([(t,) for t in texts], "text string").select("text", language.moved_to_han("text").alias("han"))
    for text, han in moved.collect():
        # the empty text has one empty character
        assert han == (None if text is None else "".join(chr(19968 + ord(c) % 20000) for c in text) or chr(19968))
    assert "translate(" in plan_of(moved)


def test_chunks_hold_the_units_of_their_span(spark):
    rows = [(n, " ".join(f"{'abcdefg'[i * i % 7]}{'hijkl'[i % 5]}" for i in range(n))) for n in range(1, 125)]
    rows += [(200 + n, "".join("日本語東京"[i * i % 5] for i in range(n))) for n in range(1, 210, 3)]
    rows += [(500, "ab γλώσσα ab 日本 שלום עולם και b"), (501, ""), (502, "1"), (503, None), (None, "a b"), (5, "c d")]
    spans = script_spans(spark.createDataFrame(rows, "k int, text string"), ["k"])
    whole, cut = span_units(spans, ["k"]), chunk_units(span_chunks(spans, ["k"]), ["k"])
    assert whole.columns == cut.columns and whole.count() > 10_000
    assert whole.exceptAll(cut).count() == cut.exceptAll(whole).count() == 0


def test_borders_read_the_chunks_of_one_shuffle(spark, folder):
    english, french = "the red house of my good friend stands near this old road ", "le petit chat noir dort dans une belle maison avec son ami "
    rows = [(i, ("en", "fr")[i % 2], (english, french)[i % 2] * (i % 5 + 1)) for i in range(40)] + [(40, "en", english * 4 + french * 4), (None, "en", english)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    df.write.parquet(f"{folder}/documents.parquet")
    borders = language.span_borders(spark, folder)
    got = {(r.doc_id, r.chunk): r.border for r in borders.collect()}
    plan = borders._jdf.queryExecution().executedPlan().toString()
    # the words of a chunk are made and shuffled once and read a second time
    assert plan.partition("== Initial Plan ==")[0].count("array_join") == 1 and "ReusedExchange" in plan

    model = train(df, kinds=("word",))
    after = df.selectExpr("doc_id - 1 AS doc_id", "text AS more")
    joined = df.join(after, "doc_id").selectExpr("doc_id", "concat_ws('\n', text, more) AS text")
    hits = gram_hits(joined, model, ["doc_id"])
    chunks = chunk_language(chunk_scores(hits, ["doc_id"]), model.expected, ["doc_id"])
    assert got and got == {(r.doc_id, r.chunk): r.border for r in refine_boundaries(hits, chunks, ["doc_id"]).collect()}


def test_most_frequent_words_are_looked_up_whole(spark):
    labelled = [("en", "the house and the garden " * 9 + "rarely"), ("fr", "la maison et le jardin " * 9 + "jamais")]
    model = train(spark.createDataFrame(labelled, "lang string, text string"))
    texts = spark.createDataFrame([(1, "the house rarely jamais unseen"), (2, "le jardin 日本 et the jardin")], "k int, text string")
    rows = model.words.count()
    frequent = model.frequent_words(rows - 1)
    assert {"the", "jardin"} <= {r.unit for r in frequent.collect()} and frequent.filter("unit IN ('rarely', 'jamais')").count() == 0
    assert model.frequent_words(rows).count() == rows and model.frequent_words(0) is None
    everything = score_texts(texts, model, ["k"])
    some = score_texts(texts, model, ["k"], max_rows=rows - 1)
    assert "_word" in plan_of(some) and sorted(map(str, some.collect())) == sorted(map(str, everything.collect()))


def test_best_languages_of_a_chunk_are_not_gathered(spark):
    rows = [(1, 0, 0, 0, lang, score, 2, 10) for lang, score in (("fr", 5), ("en", 9), ("de", 9), (None, 50))]
    rows += [(2, 0, 0, 0, None, 0, 0, 7), (3, 0, 0, 0, "en", 4, 1, 8), (3, 0, 0, 0, None, 0, 0, 2)]
    scores = spark.createDataFrame(rows, "k int, span_no int, chunk int, script_no int, lang string, score long, hits long, bytes long")
    best = chunk_language(scores, None, ["k"])
    got = {r.k: (r.lang1, r.lang2, r.score1, r.score2, r.grams, r.bytes) for r in best.collect()}
    assert got == {1: ("de", "en", 9, 9, 8, 40), 2: ("un", None, 0, 0, 0, 7), 3: ("en", None, 4, 0, 1, 10)}
    assert "collect_list" not in plan_of(best)


ENGLISH, FRENCH = "the red house of my good friend stands near this old road ", "le petit chat noir dort dans une belle maison avec son ami "
JAPANESE, RUSSIAN = "日本語東京漢字仮名", "привет мир да нет слово "


@pytest.fixture
def mixed_texts(spark):
    """A model of words, and texts of several languages and scripts."""
    labelled = [("en", ENGLISH), ("fr", FRENCH), ("fr", "road"), ("ja", JAPANESE), ("zh", "中文大小漢字"), ("ru", RUSSIAN), (None, "мир chat"), ("uk", "нет мир")]
    model = train(spark.createDataFrame(labelled, "lang string, text string"), kinds=("word",))
    texts = [
        ENGLISH * 5 + "-- " + FRENCH * 4 + "\n!", ENGLISH * 9, "1. " + RUSSIAN * 20 + ENGLISH * 3 + JAPANESE * 20 + " a " + "大小中文" * 40, "η Γλώσσα" * 30 + FRENCH,
        # words left out behind the last unit of a chunk, and before a border
        ENGLISH * 3 + "buy now " * 300 + FRENCH * 6 + "buy now " * 50, "İstanbul İ ΟΔΟΣ'Α 漢İ字" * 9 + ENGLISH * 4 + FRENCH * 4, "ᚠᚠ a ᚠ µm " + FRENCH * 3,
        "12 .. 34", "", None, "the the the", "İ", "\U0001d54f é " + JAPANESE * 12,
    ]
    return model, spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_words_of_a_text_are_no_rows_without_a_border(spark, mixed_texts, monkeypatch):
    model, df = mixed_texts
    for refine in (False, True):
        by_units = rows_of(spans._spans_by_units(df, model, ["id"], "text", refine))
        assert len(by_units) > 15
        with monkeypatch.context() as m:
            for name in ("unit_places", "text_chunks", "dealt_chunks"):
                m.setattr(spans, name, lambda *a, **b: pytest.fail("a row for every word"))
            # a slice is a text, or all of them
            for size in (1, placed.SLICE_BYTES):
                m.setattr(placed, "SLICE_BYTES", size)
                assert rows_of(text_spans(df, model, ["id"], refine=refine)) == by_units
    chunks = placed.placed_chunks(df, placed.packed(model), ["id"], 50)
    assert {r.id: r.n for r in chunks.groupBy("id").agg(F.count("*").alias("n")).collect()}[1] == 1


def test_keys_of_several_texts_are_counted_through(spark, mixed_texts, monkeypatch):
    model, df = mixed_texts
    twice = df.union(df.filter("id < 2")).union(df.filter("id = 2").selectExpr("3", "text")).union(df.selectExpr("CAST(NULL AS int)", "text"))
    by_units = rows_of(spans._spans_by_units(twice, model, ["id"], "text", True))
    assert rows_of(text_spans(twice, model, ["id"])) == by_units and "id=0" in str(by_units)


def test_a_model_too_large_for_arrays_is_joined(mixed_texts, monkeypatch):
    model, df = mixed_texts
    whole = rows_of(text_spans(df, model, ["id"]))
    assert placed.packed(model, model.gram_rows) and placed.packed(model, model.gram_rows - 1) is None
    monkeypatch.setattr(spans, "packed", lambda model: None)
    assert rows_of(text_spans(df, model, ["id"])) == whole
