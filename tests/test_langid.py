import random

import pytest
from pyspark.sql import functions as F

from crawlloom.operators.langid import decide as D
from crawlloom.operators.langid import grams as G
from crawlloom.operators.langid import model as M
from crawlloom.operators.langid import score as S
from crawlloom.operators.langid.detect import detect_language, with_language
from crawlloom.operators.langid.dims import language_name
from crawlloom.operators.langid.hints import apply_priors, html_lang_tags, host_tld, language_priors
from crawlloom.operators.langid.refine import drop_repeated_words, refine_pass, squeeze_text
from crawlloom.operators.langid.spans import text_spans, merge_adjacent_spans

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    return M.train(spark.read.parquet(DOCS))


def ints(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.o for r in df.select("i", column.alias("o")).orderBy("i").collect()]


def test_chunk_sizes_against_a_loop(spark):
    def loop(n, size):
        sizes, left = [], n
        while left > 0:
            take = size
            if left * 2 < size * 3:
                take = left
            elif left < 2 * size:
                take = (left + 1) // 2
            sizes.append(take)
            left -= take
        return [c for c, k in enumerate(sizes) for _ in range(k)]

    rows = [(p, n) for n in range(1, 130) for p in range(n)]
    got = ints(spark, rows, "p int, n int", G.chunk_index(F.col("p"), F.col("n"), 20))
    assert got == [c for n in range(1, 130) for c in loop(n, 20)]


def test_reliability_tables(spark):
    # lead needed: 5/8 of the grams, between 3 and 16; at most 12 per gram below 8
    rows = [(20, 4, 40), (19, 4, 40), (5, 5, 40), (3, 9, 40), (3, 0, 2), (100, 0, 3), (2, 0, 8)]
    got = ints(spark, rows, "a long, b long, n long", S.delta_reliability(F.col("a"), F.col("b"), F.col("n")))
    assert got == [100, 93, 0, 0, 24, 36, 40]
    rows = [(100, 100), (150, 100), (200, 100), (100, 200), (400, 100), (401, 100), (0, 100), (5, 0), (5, None)]
    got = ints(spark, rows, "a long, e long", S.expected_reliability(F.col("a"), F.col("e")))
    assert got == [100, 100, 80, 80, 0, 0, 0, 100, 100]


def test_script_spans(spark):
    df = spark.createDataFrame(
        [(1, "12 Hello, wörld! привет мир. 日本語テスト end"), (2, "a β c"), (3, "abc βγδ"), (4, "123"), (5, None)],
        "id int, text string",
    )
    rows = G.script_spans(df, ["id"]).orderBy("id", "span_no").collect()
    got = [(r.id, r.script, r.rtype, r.span) for r in rows]
    assert got == [
        (1, "Latin", "many", "hello wörld"),
        (1, "Cyrillic", "many", "привет мир"),
        (1, "Han", "cjk", "日本語テスト"),
        (1, "Latin", "many", "end"),
        # one foreign letter does not end a span
        (2, "Latin", "many", "a β c"),
        (3, "Latin", "many", "abc"),
        (3, "Greek", "one", "βγδ"),
    ]


def test_grams(spark):
    row = spark.range(1).select(
        G.quad_grams(F.lit("quick")).alias("q"),
        G.quad_grams(F.lit("a")).alias("a"),
        F.transform(F.array(*[F.lit(w) for w in ("brandy", "word", "words", "bbbbbb", "strength", "éaéaé", "übung", "aaaaaaaa")]), G.quad_grams).alias("m"),
        G.words(F.lit("x x y x y z")).alias("w"),
    ).first()
    # two letters on and over a vowel of a-z; a gram that reaches the end is the last
    assert row.q == ["_quic", "ck_"] and row.a == ["_a_"] and row.w == ["x", "y", "z"]
    assert row.m == [
        ["_bran", "ndy_"], ["_word_"], ["_word", "rds_"], ["_bbbb", "bbbb_"], ["_stre", "reng", "ngth_"],
        ["_éaéa", "éaé_"], ["_übun", "ng_"], ["_aaaa", "aaaa", "aa_"],
    ]
    df = spark.createDataFrame([(1, "漢字漢字")], "id int, text string")
    for kinds in (("word", "pair"), ("word", "quad"), ("quad",)):  # the script chooses what CJK text has
        rows = G.text_grams(df, ["id"], kinds=kinds).collect()
        assert sorted(r.gram for r in rows) == ["b:字漢", "b:漢字", "b:漢字", "d:Han", "u:字", "u:字", "u:漢", "u:漢"]
        assert sum(r.unit_bytes for r in rows) == 12


@pytest.mark.parametrize("kinds", [("word",), ("word", "quad")])
def test_pairs_of_characters_tell_languages_apart(spark, kinds):
    """Two languages of the same characters in another order; and one beside a language of words."""
    rng, a, b = random.Random(3), "的一是不了人", "を漢字仮名交"
    chars = list(a + b)

    def text(step):
        at = rng.randrange(len(chars))
        return "".join(chars[(at + step * k) % len(chars)] for k in range(300))

    rows = [("zh", text(1)) for _ in range(20)] + [("ja", text(5)) for _ in range(20)]
    rows += [("en", "plain words of a language in another script " * 5)] * 5
    model = M.train(spark.createDataFrame(rows, "lang string, text string"), kinds=kinds)
    alone = {r.lang for r in model.grams.filter("gram like 'u:%'").collect()}
    pairs = model.grams.filter("gram like 'b:%'").groupBy("gram").agg(F.countDistinct("lang").alias("n")).filter("n > 1").count()
    assert alone == {"zh", "ja"} and pairs == 0  # single characters are in both, no pair is
    df = spark.createDataFrame([(k, text(1 if k % 2 else 5)) for k in range(10)] + [(10, "some plain words of a language here")], "id int, text string")
    got = {r.id: r.lang for r in detect_language(df, model, ["id"]).collect()}
    assert got == {**{k: "zh" if k % 2 else "ja" for k in range(10)}, 10: got[10]} and got[10] in ("en", "un")


def test_one_language_scripts_need_no_model(spark, model):
    df = spark.createDataFrame(
        [(1, "Καλημέρα κόσμε, τι κάνεις;"), (2, "สวัสดีชาวโลก"), (3, "123"), (4, "banana")], "id int, text string"
    )
    verdict = detect_language(df, model, ["id"])
    got = {r.id: (r.lang, r.reliable) for r in with_language(df, verdict, ["id"]).collect()}
    assert got[1] == ("el", True) and got[2] == ("th", True) and got[3] == ("un", False)
    assert got[4] == ("un", False)


def _decide(spark, rows, **options):
    totals = spark.createDataFrame(
        [(i, lang, b, b, b * pct) for i, langs in enumerate(rows) for lang, b, pct in langs],
        "i int, lang string, bytes long, score long, rel long",
    )
    out = D.decide(totals, ["i"], **options).orderBy("i").collect()
    return [(r.lang, r.reliable) for r in out]


DECISIONS = [
    ([("en", 100, 90)], ("en", True)),
    # 17 % of another language beside English wins; 16 % does not
    ([("en", 83, 90), ("hu", 17, 90)], ("hu", True)),
    ([("en", 84, 90), ("hu", 16, 90)], ("en", True)),
    # too few bytes of it
    ([("en", 10, 90), ("hu", 10, 90)], ("en", False)),
    ([("en", 400, 90), ("hu", 600, 90)], ("hu", True)),
    # French, Italian, German, Spanish give way at 20 %
    ([("fr", 80, 90), ("hu", 20, 90)], ("hu", True)),
    ([("fr", 81, 90), ("hu", 19, 90)], ("fr", True)),
    # a second English share is left out of the percentage
    ([("hu", 55, 90), ("en", 45, 90)], ("hu", True)),
    # many languages
    ([("hu", 25, 90), ("fi", 25, 90), ("pl", 25, 90), ("tr", 25, 90)], ("un", False)),
    ([("hu", 40, 90), ("fi", 30, 90), ("pl", 30, 90)], ("hu", False)),
    # a close language moves into the larger one
    ([("cs", 60, 90), ("sk", 40, 90)], ("cs", True)),
    # unreliable: removed, or merged with its neighbour
    ([("hu", 100, 40)], ("un", False)),
    ([("en", 60, 30), ("sco", 50, 60)], ("sco", False)),
]


def test_decision_table(spark):
    got = _decide(spark, [d[0] for d in DECISIONS])
    assert got == [d[1] for d in DECISIONS]
    assert _decide(spark, [[("hu", 100, 40)]], best_effort=True) == [("hu", True)]


def test_percents_round_in_order(spark):
    langs = [("a", 960, 90), ("b", 16, 90), ("c", 14, 90), ("d", 10, 90)]
    totals = spark.createDataFrame([(1, x, b, b, b * p) for x, b, p in langs], "i int, lang string, bytes long, score long, rel long")
    row = D.top3(D.gather(totals, ["i"])).first()
    assert (row.percent1, row.percent2, row.percent3) == (96, 2, 1)


def test_broadcast_and_shuffled_lookup_agree(spark, model):
    docs = spark.read.parquet(DOCS)
    grams = G.text_grams(docs, ["doc_id"])
    small = S.score_grams(grams, model.grams)
    large = S.score_grams(grams, model.grams, max_rows=1)
    assert "Broadcast" in small._jdf.queryExecution().toString()
    columns = ["doc_id", "chunk", "pos", "gram", "lang", "weight"]
    assert small.select(columns).exceptAll(large.select(columns)).count() == 0
    assert large.select(columns).exceptAll(small.select(columns)).count() == 0


def test_word_scores_change_nothing(spark, model):
    docs = spark.read.parquet(DOCS)
    odd = spark.createDataFrame([(-1, "Привет мир the 漢字 γλώσσα the неведомое unheardof")], "doc_id long, text string")
    texts = docs.select("doc_id", "text").unionByName(odd)
    gram_by_gram = M.LangModel(model.grams, model.expected, model.kinds)
    want = S.score_texts(texts, gram_by_gram, ["doc_id"])
    got = S.score_texts(texts, model, ["doc_id"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # no word is left out, and beyond the bound for broadcasts the grams are used
    vocabulary = M.unit_counts(docs).select("unit").distinct().count()
    assert model.words.select("unit").distinct().count() == vocabulary
    assert S.score_texts(texts, model, ["doc_id"], max_rows=10).exceptAll(want).count() == 0


@pytest.mark.parametrize("kinds", [("word", "quad"), ("quad",)])
def test_a_word_seen_in_two_scripts_counts_once(spark, kinds):
    # one foreign letter does not end a span, so both trainings hold the other's script
    rows = [("en", "some plain english words я and more"), ("ru", "обычный русский текст a и слова"), ("en", "я a я a")]
    two = M.train(spark.createDataFrame(rows, "lang string, text string"), kinds=kinds)
    texts = spark.createDataFrame([(1, "a я plain русский a я"), (2, "русский a я words")], "doc_id long, text string")
    want = S.score_texts(texts, M.LangModel(two.grams, two.expected, two.kinds), ["doc_id"])
    got = S.score_texts(texts, two, ["doc_id"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_grams_and_null_rows_stay_out_of_the_shuffle(spark, model):
    """A third of the rows without a gram, a third with one gram, the rest spread over many."""
    known = [r.gram for r in model.grams.filter("gram like 'w:%'").select("gram").distinct().orderBy("gram").limit(50).collect()]
    many = "', '".join(known[1:])
    grams = spark.range(60_000).selectExpr(
        "id AS doc_id", "0 AS chunk", "id AS pos",
        f"CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN '{known[0]}' ELSE CASE WHEN id % 7 = 0 THEN concat('w:', id) ELSE array('{many}')[int(id % 49)] END END AS gram",
    )
    few = grams.withColumn("gram", F.when(F.col("gram").isin(known[1:]), F.concat("gram", "doc_id")).otherwise(F.col("gram")))
    for rows in (grams, few):
        large = S.score_grams(rows, model.grams, max_rows=0)
        small = S.score_grams(rows, model.grams)
        assert large.exceptAll(small.select(large.columns)).count() == 0 and small.select(large.columns).exceptAll(large).count() == 0
        easy, rest, _ = S.split_by_frequency(rows)
        most = rest.groupBy("gram").count().agg(F.max("count"), F.count_if(F.col("gram").isNull())).first()
        assert most[0] <= 8 and most[1] == 0 and easy.count() + rest.count() == 60_000
    # below the exchange of the plan stands the filter that holds them back
    plan = large._jdf.queryExecution().executedPlan().toString()
    joins = plan.split("SortMergeJoin")
    assert len(joins) == 2 and joins[1].index("Exchange") < joins[1].index("NOT") and "isnotnull" in joins[1].lower()
    none = spark.range(2000).selectExpr("id AS doc_id", "0 AS chunk", "id AS pos", "CAST(NULL AS STRING) AS gram")
    assert S.score_grams(none, model.grams, max_rows=1).count() == 2000


def test_detection_shuffles_text_once(spark, model):
    docs = spark.read.parquet(DOCS)
    plan = detect_language(docs, model, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_accuracy_on_unseen_texts(spark):
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = train.filter("doc_id % 2 = 0")
    # texts also seen in training say nothing
    test = train.filter("doc_id % 2 = 1").join(first.select("text"), "text", "left_anti")
    trained = M.train(first)
    found = test.withColumnRenamed("lang", "stated").join(detect_language(test, trained, ["doc_id"]), "doc_id")
    row = found.agg(F.avg((F.col("lang") == F.col("stated")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert row.n > 300 and row.a > 0.97


def test_model_can_be_saved(spark, model, folder):
    model.save(f"{folder}/m")
    back = M.LangModel.load(spark, f"{folder}/m")
    assert set(back.kinds) == set(model.kinds)
    assert back.grams.exceptAll(model.grams).count() == 0


def test_lang_tags(spark):
    pages = {
        '<html lang="en-US" xml:lang="en_US"><body lang=fr>': "en-us,fr",
        '<meta http-equiv="content-language" content="en-GB, de">': "en-gb,de",
        '<meta name="DC.language" content="sr">': "sr",
        '<meta name="author" content="fr">': "",
        '<!-- lang="xx" --><font lang=yy><a hreflang="zz" lang="qq"><p lang=\'it\'>': "it",
        "plain": "",
    }
    assert ints(spark, [(p,) for p in pages], "h string", html_lang_tags(F.col("h"))) == list(pages.values())
    urls = ["https://u@www.Example.FR:80/x.de", "http://a.b", "nonsense"]
    assert ints(spark, [(u,) for u in urls], "u string", host_tld(F.col("u"))) == ["fr", "b", ""]


def test_priors_and_suppression(spark):
    hints = spark.createDataFrame(
        [(1, "de,fr", "de"), (2, "a,b,c,d,e,f", "fr"), (3, "", "cz"), (4, "cs", "")], "id int, tags string, tld string"
    )
    got = {(r.id, r.lang): r.weight for r in language_priors(hints, ["id"], "tags", "tld").collect()}
    assert got == {
        (1, "de"): 12, (1, "fr"): 10, (2, "fr"): 4, (3, "cs"): 4, (3, "sk"): -4, (4, "cs"): 10, (4, "sk"): -4,
    }
    tags = {
        1: "zh-tw", 2: "he", 3: "eng", 4: "deu,fra", 5: "czech", 6: "de-at-long-variant-x", 7: "xx,de,fr,es,it,nl,pt",
        8: "english", 9: "german-ch", 10: "tw",
    }
    many = spark.createDataFrame(list(tags.items()), "id int, tags string")

    def found(**kind):
        out = {}
        for r in language_priors(many, ["id"], "tags", **kind).collect():
            out.setdefault(r.id, {})[r.lang] = r.weight
        return out

    whole, limited = found(), found(reference=True)
    assert whole[1] == {"zh-Hant": 10} and whole[2] == {"iw": 10} and whole[3] == {"en": 4} == whole[8]
    assert whole[4] == {"de": 10, "fr": 10} and whole[5] == {"cs": 10, "sk": -4} and whole[10] == {"ak": 10, "zh-Hant": 10}
    assert whole[6] == {"de": 10} and set(whole[7]) == {"de", "fr", "es", "it", "nl", "pt"} and whole[9] == {"de": 10}
    assert 6 not in limited and 7 not in limited and 9 not in limited and limited[5] == whole[5]
    scores = spark.createDataFrame(
        [(1, 0, 0, 0, "id", 5, 1, 3), (1, 0, 0, 0, "ms", 9, 2, 4)],
        "k int, span_no int, chunk int, script_no int, lang string, score long, hits long, bytes long",
    )
    only_id = spark.createDataFrame([(1, "id", 8)], "k int, lang string, weight int")
    rows = apply_priors(scores, only_id, ["k"]).collect()
    assert {r.lang: (r.score, r.bytes) for r in rows} == {"id": (13, 3), None: (0, 4)}


def test_language_names(spark):
    codes = ["en", "un", "", "fr-CA", "zh-Hant-TW", "sr-Latn-ME", "GERMAN", "xx", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = {r.code: r.name for r in language_name(df).collect()}
    assert [got[c] for c in codes] == [
        "ENGLISH", "UNKNOWN_LANGUAGE", "UNKNOWN_LANGUAGE", "FRENCH", "ChineseT", "MONTENEGRIN",
        "GERMAN", "UNKNOWN_LANGUAGE", "UNKNOWN_LANGUAGE",
    ]


def test_spans_merge(spark):
    rows = [(1, i, lang, 10) for i, lang in enumerate(["en", "en", "fr", "en"])]
    df = spark.createDataFrame(rows, "k int, o int, lang string, bytes long")
    got = merge_adjacent_spans(df, ["k"], ["o"]).orderBy("span").collect()
    assert [(r.offset, r.bytes, r.lang) for r in got] == [(0, 20, "en"), (20, 10, "fr"), (30, 10, "en")]


def test_repetition(spark, model):
    df = spark.createDataFrame([(1, "a b c d e a b c d e f"), (2, "x y"), (3, "")], "id int, text string")
    got = {r.id: r.text for r in drop_repeated_words(df, ["id"]).collect()}
    assert got[1] == "a b c d e a b c f" and got[2] == "x y"
    long = "ab " * 2000
    varied = " ".join(f"w{i}q{i * 7919}" for i in range(600))
    rows = [(long,), (varied,), ("ab " * 10,), (varied + " " * 96,), ("",)]
    # every block is judged alike; with ``reference`` only long texts that begin badly are
    out = ints(spark, rows, "t string", squeeze_text(F.col("t")))
    assert out[:3] == ["", varied, ""] and varied.startswith(out[3].rstrip()) and len(out[3]) > len(varied) - 48 and out[4] == ""
    out = ints(spark, rows, "t string", squeeze_text(F.col("t"), reference=True))
    assert len(out[0]) < 100 and out[1] == varied and out[2] == "ab " * 10 and out[3] == varied + " " * 96
    docs = spark.read.parquet(DOCS)
    refined = refine_pass(docs, model, ["doc_id"])
    assert refined.count() == detect_language(docs, model, ["doc_id"]).count()


def test_second_pass_is_as_careful_as_the_first(spark, model):
    texts = ["banana", "xqz", "the", "zzz " * 400, docs_text(spark), docs_text(spark) + " qx" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for reference in (False, True):
        got = {r.id: (r.lang, r.reliable) for r in refine_pass(df, model, ["id"], reference=reference).collect()}
        assert [got[i] for i in range(4)] == [("un", False)] * 4
        assert got[4] == got[5] == ("en", True)  # repetitions do not hide the language


def test_spans_cut_the_text_itself(spark, model):
    rows = spark.read.parquet(DOCS).filter("n_chars between 1500 and 6000").collect()
    one = {lang: next(r.text for r in sorted(rows, key=lambda r: r.doc_id) if r.lang == lang) for lang in ("en", "fr", "de")}
    greek, thai = "Η γλώσσα είναι ελληνική. " * 30, "ภาษาไทย " * 40
    texts = [
        one["en"], "  ** " + one["fr"] + " -- " + one["en"] + "!!\n", one["de"] + "\n\n" + greek + "(" + one["fr"] + ")", greek, thai + one["en"],
        "12 .. 34", "", "the the the the", "\U0001d54f \U0001f600 " + one["fr"] + "\U0001f600", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for refine in (False, True):
        spans = {}
        for r in text_spans(df, model, ["id"], refine=refine).orderBy("id", "span").collect():
            spans.setdefault(r.id, []).append((r.start, r.length, r.lang))
        assert set(spans) == {0, 1, 2, 3, 4, 7, 8}
        for i, found in spans.items():
            # pieces follow each other from the first character to the last
            assert [s for s, _, _ in found] == [0, *__import__("itertools").accumulate(n for _, n, _ in found)][:-1]
            assert sum(n for _, n, _ in found) == len(texts[i])
        assert {x for _, _, x in spans[0]} == {"en"} and {x for _, _, x in spans[3]} == {"el"}

        def cut(i):
            return [(x, texts[i][s : s + n]) for s, n, x in spans[i] if x != "un"]

        for i, langs in ((1, ["fr", "en"]), (2, ["de", "el", "fr"]), (4, ["th", "en"]), (8, ["fr"])):
            assert [x for x, _ in cut(i)] == langs
        # a border lies within a chunk of where the languages meet, refined within a few words
        border = texts[1].index(one["en"])
        near = 25 if refine else 200
        assert abs(len(cut(1)[0][1]) - border) <= near + 10
        assert cut(2)[1][1].startswith("Η γλώσσα") and cut(2)[2][1].lstrip("(")[:20] == one["fr"][:20]


def docs_text(spark):
    rows = spark.read.parquet(DOCS).filter("lang = 'en' and n_chars > 1500").orderBy("doc_id")
    return rows.first().text
