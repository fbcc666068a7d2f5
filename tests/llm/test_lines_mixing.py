import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlloom.llm import linededup, mixing

BLANKS = " \t\n\x0b\x0c\r"
ASCII = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_lines(rows, least, min_chars=1):
    split = [[(x, x.strip(BLANKS).translate(ASCII)) for x in (t or "").split("\n")] for _, t, *_ in rows]
    seen = Counter(k for lines in split for k in {k for _, k in lines} if len(k) >= min_chars)
    return [
        (r[0], "\n".join(x for x, k in lines if seen[k] < least), len(lines), sum(seen[k] >= least for _, k in lines))
        for r, lines in zip(rows, split, strict=True)
    ]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_lines_against_brute_force(make, batches, fanout):
    rng = random.Random(1)
    pool = ["All rights reserved.", " all RIGHTS reserved.\r", "É", "é", "", "  ", "x", "Ünder", "ünder", "ab", "AB\t"]
    rows = [(i, "\n".join(rng.choice(pool + [f"own {i} {j}"]) for j in range(rng.randrange(6)))) for i in range(60)]
    rows += [(None, "AB\nnew"), (1, None), (3, rows[3][1]), (61, "ab\n" * 3000), (62, None)]
    out = linededup.drop_common_lines(make(rows), min_docs=10, batches=batches, fanout=fanout)
    assert out.columns == [*make(rows).columns, "n_lines", "n_dropped"]
    got = sorted((r["doc_id"] or -1, r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect())
    assert got == sorted((i or -1, *rest) for i, *rest in brute_lines(rows, 10))


def test_lines_empty(make):
    assert linededup.drop_common_lines(make([])).collect() == []


def test_settled_lines_are_not_counted_again(spark):
    runs = linededup.LineRuns(spark, min_docs=5, fanout=2)
    for _ in range(2):
        runs.add(spark.createDataFrame([(1, 3), (2, 1)], "key bigint, docs bigint"))
    before = sum(spark.table(n).count() for level in runs.levels for n in level)
    runs.add(spark.createDataFrame([(1, 3), (3, 1)], "key bigint, docs bigint"))
    after = sum(spark.table(n).count() for level in runs.levels for n in level)
    assert (before, after) == (1, 2)  # key 1 is settled; keys 2 and 3 are pending
    assert [r["key"] for r in runs.frequent().collect()] == [1]
    plan = runs._merged([runs.levels[0][0], runs.levels[1][0]])._jdf.queryExecution().executedPlan().toString()
    runs.discard()
    assert "Exchange" not in plan and "SortMergeJoin" in plan  # sorted runs meet without a shuffle


def test_counts_add_up_over_many_batches(spark):
    runs = linededup.LineRuns(spark, min_docs=10, fanout=2)
    rng, want = random.Random(9), Counter()
    for _ in range(7):
        batch = {k: rng.randrange(1, 4) for k in range(60) if rng.random() < 0.6}
        want.update(batch)
        runs.add(spark.createDataFrame(list(batch.items()), "key bigint, docs bigint"))
    got = {r["key"] for r in runs.frequent().collect()}
    runs.discard()
    assert got == {k for k, n in want.items() if n >= 10}


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w, left = {k: weights[i % 3] for i, k in enumerate(names)}, share * sum(sizes.values())
    out, free = {}, set(names)
    while True:
        level = left / sum(w[k] for k in free)
        full = {k for k in free if w[k] * level > most * sizes[k]}
        if not full:
            return out | {k: w[k] * level for k in free}
        for k in full:
            out[k] = most * sizes[k]
            left -= out[k]
        free -= full


def test_mixing(make, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(30), rng.choice(["a", "b", "B", "é", None, "c"] + ["a"] * 5)) for i in range(900)]
    rows += [(None, "x y", "a"), (5, None, "b"), (1, "", None), (7, "q " * 20_000, "c")]
    docs = make([(i, t, s) for i, t, s in rows])
    out = mixing.mix_plan(docs).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken, largest = targets(dict(sizes)), Counter(), Counter()
    for r in out:
        s = r["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_rows_of_one_id_or_none_are_dealt_to_many_blocks(make, monkeypatch):
    """A third of the rows without id, a third under one id: no task gets them all."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    monkeypatch.setattr(mixing, "MANY_ROWS", 100)
    rows = [(None, "a b", "x")] * 400 + [(7, "c d e", "x")] * 400 + [(100 + i, "w " * (i % 9), "y") for i in range(400)]
    tree = mixing._tree

    def dealt(df, *rest):
        most = df.groupBy(F.pmod("_deal", F.lit(1200 // 50))).count().agg(F.max("count")).first()[0]
        assert most < 150
        return tree(df, *rest)

    monkeypatch.setattr(mixing, "_tree", dealt)
    out = mixing.mix_plan(make(rows)).collect()
    assert len(out) == 1200
    sizes, want, taken = Counter(), None, Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 9 for s in sizes)


def test_runs_lie_in_the_shared_folder(spark, make):
    runs = linededup.LineRuns(spark, min_docs=5, fanout=2)
    runs.add(spark.createDataFrame([(1, 3), (2, 1)], "key bigint, docs bigint"))
    (name,) = runs.levels[0]
    at = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    folder = at.removeprefix("file:")
    assert runs.root.removeprefix("file:") in folder and os.listdir(folder)
    runs.discard()
    assert not os.path.exists(folder) and not spark.catalog.tableExists(name)


def test_each_copy_is_as_likely_as_its_share():
    # 400 seeds of one small tree: the mean of every draw is its probability
    p, size = [0.3, 0.7, 0.5, 0.25, 0.9, 0.6], [1.0, 5.0, 2.0, 9.0, 3.0, 4.0]
    total = [0.0] * 6
    for seed in range(400):
        out, at = mixing.pivotal(list(p), size, [11, 22, 33, 44, 55, 66], seed)
        assert abs(sum(a * s for a, s in zip(out, size)) - sum(a * s for a, s in zip(p, size))) < 1e-9
        assert all(x in (0.0, 1.0) or i == at for i, x in enumerate(out))
        total = [a + b for a, b in zip(total, out)]
    assert all(abs(t / 400 - q) < 0.09 for t, q in zip(total, p))


def test_mix_repeats_rows(make):
    docs = make([(1, "a b c", "x"), (2, "d e f", "y"), (3, "g", None)])
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == Counter({k: v for k, v in plan.items() if v})
    assert mixing.mix_plan(make([])).collect() == [] and mixing.mix(docs).columns == docs.columns


