import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlloom.llm import langid, toxicity
from crawlloom.llm.shared import held


@pytest.fixture(scope="module")
def lang_model(documents):
    return langid.train(documents.filter(held(F.col("doc_id"), 4) != 2))


def test_held_out_languages(documents, lang_model):
    out = langid.identify(documents, lang_model).join(documents.select("doc_id", "lang"), "doc_id")
    rows = out.filter(held(F.col("doc_id"), 4) == 2).collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(make, lang_model):
    rows = [(1, None), (2, ""), (3, "123 !?\n"), (4, "the of and that with " * 20_000), (None, "der die und ist nicht"),
            (6, "слово"), (7, "é"), (7, "é")]
    out = langid.identify(make(rows), lang_model).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[None][0] == "de" and got[6][0] in lang_model.langs and got[7][0] != "und"
    assert langid.identify(make([]), lang_model).collect() == []


def test_family_comes_first(make, lang_model):
    assert lang_model.families == ["germanic", "romance"] and langid.family_of("xx") == "xx"
    assert [m[:2] for m in lang_model.inside["germanic"]] == [("de", "en")]
    only = langid.train(make([(1, "abc", None, "xx"), (2, None, None, "yy"), (3, "t", None, None)]))
    assert only.langs == ["xx"]
    assert langid.identify(make([(9, "anything")]), only).first()["lang_pred"] == "xx"


def brute_kernel(a, b):
    """Gap-weighted common subsequences of three symbols, over spans of at most SPAN."""
    def phi(word):
        s, out = [toxicity._START, *word, toxicity._END], {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    out[s[i], s[j], s[k]] = out.get((s[i], s[j], s[k]), 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = phi(a), phi(b)
    norms = toxicity._norms(60)
    return sum(v * y.get(f, 0) for f, v in x.items()) / norms[len(a) + 2] / norms[len(b) + 2]


def test_kernel_against_brute_force():
    rng = random.Random(6)
    words = [bytes(rng.randrange(1, 8) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    cols, _ = toxicity._landmark_map(words[:15])
    got = toxicity._kernel(words, cols)
    want = np.array([[brute_kernel(a, b) for b in words[:15]] for a in words])
    assert np.allclose(got, want, atol=1e-5)


def letters(words):
    return ["".join(chr(96 + b) for b in w) for w in words]


def test_words_of_a_text():
    def cut(text):
        return letters(toxicity._strings(*toxicity._tokens(text)))

    assert cut("An i.d.i.o.t, 1d!ot\ti d i o t é") == ["an", "idiot", "idiot", "idiote"]
    assert cut("") == cut(" .,\n") == []
    assert cut("a b x") == ["abx"] and cut("a bc x y") == ["a", "bc", "x", "y"]


@pytest.fixture(scope="module")
def more(spark):
    """Labelled English documents; some hundreds of them are toxic.

    In the other languages of this table the toxic words are also parts of clean ones, and
    some hundred texts are too few to learn them.
    """
    at = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{at}/documents.parquet").filter("lang = 'en'"), spark.read.parquet(f"{at}/labels.parquet")


@pytest.fixture(scope="module")
def toxic_model(more):
    documents, labels = more
    return toxicity.train(documents, labels.filter(held(F.col("doc_id"), 5) != 0))


def test_held_out_toxicity(more, toxic_model):
    documents, labels = more
    out = toxicity.score(documents, toxic_model).join(labels.select("doc_id", "toxic"), "doc_id")
    rows = out.filter(held(F.col("doc_id"), 5) == 0).collect()
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in rows]
    assert len(rows) > 400 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_rows(make, toxic_model):
    base = "of the and that was in with "
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, base), (5, base + "idiot"), (6, base + "i.d.i*o-t"), (7, base + "i d i o t"),
            (8, base * 20_000 + "IDIOT " + base), (None, "idiot"), (9, "idiot"), (9, "idiot"), (10, "слово 文")]
    out = toxicity.score(make(rows), toxic_model).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r["score"] for r in out}
    assert all(got[i] < 0.5 for i in (1, 2, 3, 4, 10)) and all(got[i] >= 0.5 for i in (5, 6, 7, 8, 9, None))
    assert toxicity.score(make([]), toxic_model).collect() == []
    kept = toxicity.keep_clean(make(rows), toxic_model)
    assert kept.columns == make(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 10]


def test_insults_with_a_slip(more, toxic_model):
    """Every frequent insult with a letter put in, said twice or gapped; and clean words left alone."""
    documents, labels = more
    sets = documents.join(labels, "doc_id").select("doc_id", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w"))
    words = sets.filter("w <> ''").groupBy("w").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    rows = words.collect()
    insults = [r["w"] for r in rows if r["bad"] >= 80 and not r["good"]]
    assert {"idiot", "loser", "scum", "clown", "worthless"} <= set(insults)

    def caught(texts):
        return float(np.mean([toxic_model.chance(toxic_model.text(t)) >= 0.5 for t in texts]))

    for w in insults:
        coded = bytes(ord(c) - 96 for c in w)
        assert caught([w]) == 1
        assert caught(["of the " + "".join(chr(96 + b) for b in o) + " and" for o in toxicity.odd_copies(coded)]) >= 0.9, w
        assert caught([sign.join(w) for sign in (".", "-", " ", "*", "_")]) == 1, w
        assert caught([w[:a] + w[a] * 2 + w[a:] for a in range(1, len(w))]) >= 0.8, w  # said three times
    clean = [r["w"] for r in rows if r["good"] and not r["bad"]]
    assert len(clean) > 10_000 and caught(clean) < 0.002


def test_nothing_to_learn_from(spark, make, labels):
    none = langid.train(make([]))
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(make([(1, "some text")]), none).collect()] == [("und", 0.0)]
    docs = make([(1, "some text"), (2, None)])
    for rows, want in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, 1)], 0.0), ([(None, 1), (1, None), (1, 7)], 0.0)):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
        assert [round(r["score"], 6) for r in toxicity.score(docs, model).collect()] == [want, want]
