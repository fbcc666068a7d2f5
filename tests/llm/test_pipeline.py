import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_decontam_vectors import brute as brute_windows
from test_lines_mixing import brute_lines, targets
from test_neardup import brute as brute_copies

from crawlloom.llm import toxicity
from crawlloom.llm.shared import Scratch, held

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "pipeline-test")
    before, columns = docs, docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(held(F.col("doc_id"), 5) != 0)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = texts(before)
        after = scratch.put(f"s{k}", stage(spark, before, SF))
        if name == "toxicity":
            score = toxicity.score(before, toxicity.train(before, labels)).filter("score < 0.5")
            clean = {r["doc_id"] for r in score.collect()}
            want = [r for r in rows if r[0] in clean]
            assert 0.8 * len(rows) < len(want) < len(rows)
        elif name == "line dedup":
            want = sorted((i, t) for i, t, *_ in brute_lines(rows, 10))
        elif name == "near duplicates":
            kept = brute_copies(rows, 80)
            want = [r for r in rows if kept[r[0]][2]]
            assert len(want) < len(rows)
        elif name == "decontamination":
            want = [r for r, (_, hit, _) in zip(rows, brute_windows(rows, items), strict=True) if not hit]
        else:
            break
        assert texts(after) == want and after.columns == columns
        before = after
    sizes, source = {}, {r["doc_id"]: r["source"] for r in before.collect()}
    for i, t in rows:
        sizes[source[i]] = sizes.get(source[i], 0) + len(t.split())
    goal, taken, largest = targets(sizes), {}, {}
    out = after.collect()
    assert sorted(r["doc_id"] for r in out) == [i for i, _ in rows]
    for r in out:
        s = r["source"]
        taken[s], largest[s] = taken.get(s, 0) + r["taken"], max(largest.get(s, 0), r["size"])
        assert r["source_size"] == sizes[s] and r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in sizes)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "a b"), (2, ""), (3, "x " * 30_000), (3, "x " * 30_000), (4, "É\n\n")]])
def test_stages_take_odd_rows(spark, make, rows):
    docs = make(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == make([]).columns
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()) == docs.count()


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "decontamination", "mixing",
    ]
