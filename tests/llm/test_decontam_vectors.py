import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from crawlloom.llm import decontam, embeddings

ITEM = "item_id bigint, text string, row string, id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def brute(docs, items, n=10):
    out = []
    for _, text, *_ in docs:
        w, hit, names, spans = words(text), set(), set(), set()
        for i, t in items:
            v = words(t)
            width = min(n, len(v))
            runs = {tuple(v[k : k + width]) for k in range(len(v) - width + 1)} if v else set()
            for p in range(len(w) - width + 1 if runs else 0):
                if tuple(w[p : p + width]) in runs:
                    hit |= set(range(p, p + width))
                    names.add(str(i))
        spans = hit
        out.append((len(w), len(spans), sorted(names)))
    return out


@pytest.mark.parametrize("block,shard", [(1 << 25, 1 << 22), (150, 300)])
def test_windows_against_brute_force(spark, make, monkeypatch, block, shard):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontam, "SHARD_BYTES", shard)
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "Ä", "ä", "x1", "é"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(20, None), (21, "  .,"), (22, "one-two.three"), (3, "B b B b B b B b B b b")]
    docs = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        if i % 3 == 0:
            part = (items[rng.randrange(12)][1]).split()
            w[rng.randrange(len(w) + 1) : 0] = part[rng.randrange(3) :]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 7 == 0 else " ".join(w)))
    docs += [(100, None), (101, ""), (102, "ONE two; Three"), (103, "one two"), (None, items[4][1]), (5, docs[5][1]),
             (104, "z " * 20_000 + items[4][1])]
    bench = spark.createDataFrame([(*x, "r", "i") for x in items], ITEM)
    # upper-casing turns ä into Ä, which is another word; both sides see the same texts
    out = decontam.contamination(make(docs), bench).collect()
    assert len(out) == len(docs)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in out)
    want = sorted((str(d[0]), a, b, tuple(c)) for d, (a, b, c) in zip(docs, brute(docs, items), strict=True))
    assert got == want
    kept = decontam.decontaminate(make(docs), bench)
    assert kept.columns == make(docs).columns
    assert kept.count() == sum(1 for _, b, _ in brute(docs, items) if not b)


def test_no_items_no_documents(spark, make):
    none = spark.createDataFrame([], ITEM)
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in decontam.contamination(make([(1, "a b")]), none).collect()] == [(2, 0, [])]
    some = spark.createDataFrame([(1, "a", "r", "i")], ITEM)
    assert decontam.contamination(make([]), some).collect() == []


def test_longest_match(spark, make):
    item = " ".join(f"w{i}" for i in range(60))
    doc = "x " + " ".join(f"w{i}" for i in range(5, 50)) + " y"
    bench = spark.createDataFrame([(1, item, "r", "i")], ITEM)
    r = decontam.contamination(make([(1, doc)]), bench).first()
    assert (r["n_hit"], r["longest"], [tuple(s) for s in r["spans"]]) == (45, 45, [(1, 46)])


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for n, kinds in ((0, 2), (1, 2), (500, 2), (2000, 50), (64, 1)):
        seq = rng.integers(0, kinds, n).astype(np.uint64)
        suffixes = [tuple(seq[i : i + 27].tolist()) for i in decontam.SuffixArray(seq).sa]
        assert suffixes == sorted(suffixes) and len(suffixes) == n


VEC = "vec_id bigint, embedding array<float>, label int, vec string, cls int, size int"


def brute_vectors(rows, least=0.98):
    ok = {}
    for k, (i, v, label, *_) in enumerate(rows):
        if i is None or v is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(np.float64)
        ok[k] = (label, len(v), x / np.linalg.norm(x))
    links, parent = {k: 0 for k in range(len(rows))}, {k: k for k in range(len(rows))}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(ok)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if ok[a][:2] == ok[b][:2] and ok[a][2] @ ok[b][2] >= least:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    out = []
    for k, row in enumerate(rows):
        mine = [rows[j][0] for j in range(len(rows)) if find(j) == find(k)]
        out.append((row[0], links[k], min(mine) if row[0] is not None else None))
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows, at = [], 0
    for label in (0, 1):
        for size in (1, 1, 2, 30):
            centre = rng.normal(size=16)
            for _ in range(size):
                rows.append((at, [float(x) for x in centre + 0.02 * rng.normal(size=16) * np.linalg.norm(centre) / 4], label))
                at += 1
    rows += [(200 + i, rows[5][1], 0) for i in range(3)]  # exact copies
    rows += [(210, [2 * x for x in rows[5][1]], 0), (211, rows[5][1], 1), (211, rows[5][1], 1)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [1.0, None] * 8, 0), (304, [float("nan")] * 16, 0),
             (305, [float("inf")] + [1.0] * 15, 0), (306, rows[5][1], None), (None, rows[5][1], 0),
             (307, [1.0, 2.0], 0), (308, [1.0, 2.0], 0), (309, [1e-30, 2e-30], 0), (310, [3.0], 0), (311, [5.0], 0)]
    df = spark.createDataFrame([(*r, "v", 1, 2) for r in rows], VEC)
    out = embeddings.near_vectors(df).collect()
    got = sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in out)))
    assert got == sorted(map(str, brute_vectors(rows)))
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in out)
    assert embeddings.near_vectors(df.limit(0)).collect() == []


def test_recall(spark):
    # pairs right above the threshold, the hardest ones: at least 0.9, in practice nearly all
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.9805
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), 0)]
    df = spark.createDataFrame([(*r, "v", 1, 2) for r in rows], VEC)
    found = embeddings.near_vectors(df).filter("n_links > 0").count() / 3000
    assert found > 0.99


def pairs_around_a_mean(rng, n, dim, shared, cosine=0.9805):
    """Unit vectors whose average cosine is ``shared``, and one at ``cosine`` to each."""
    x = rng.normal(size=(n, dim)) / np.sqrt(dim) * np.sqrt(1 - shared)
    x[:, 0] += np.sqrt(shared)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * y


@pytest.mark.parametrize("dim,shared", [(64, 0.0), (64, 0.5), (64, 0.8), (64, 0.9), (128, 0.9)])
def test_the_index_fits_vectors_with_a_common_mean(dim, shared):
    rng = np.random.default_rng(6)
    index = embeddings.fit(pairs_around_a_mean(rng, 3000, dim, shared)[0], dim, group=2e6)
    assert index.bits > 0 and (shared or (index.tables, index.bits) == (embeddings.TABLES, embeddings.BITS))
    x, y = pairs_around_a_mean(rng, 3000, dim, shared)
    assert (index.codes(x) == index.codes(y)).any(axis=1).mean() > 0.99
    # still an index: few of the other pairs meet
    a, b = index.codes(x), index.codes(x[::-1])
    assert (a == b).any(axis=1).mean() < 0.3


@pytest.mark.parametrize("block", [256, 16])
def test_recall_around_a_common_mean(spark, monkeypatch, block):
    # few vectors a label are compared all with all, and by the tables when blocks are dear
    monkeypatch.setattr(embeddings, "BLOCK", block)
    x, y = pairs_around_a_mean(np.random.default_rng(7), 1200, 64, 0.9)
    rows = [(i, v, 0) for i, v in enumerate(np.concatenate([x, y]).tolist())]
    out = embeddings.near_vectors(spark.createDataFrame([(*r, "v", 1, 2) for r in rows], VEC)).collect()
    z = np.concatenate([x, y]).astype(np.float32).astype(np.float64)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    want = (z @ z.T >= 0.98).sum(axis=1) - 1
    got = np.array([r["n_links"] for r in sorted(out, key=lambda r: r["vec_id"])])
    assert (got <= want).all() and got.sum() > 0.99 * want.sum()
    assert block == 16 or (got == want).all()


def test_two_vectors_of_a_length(spark):
    rows = [(1, [1.0, 0.1, 0.0], 0), (2, [1.0, 0.0, 0.1], 0), (3, [2.0, 0.1], 0)]
    out = embeddings.near_vectors(spark.createDataFrame([(*r, "v", 1, 2) for r in rows], VEC)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_codes_are_balanced():
    x = np.random.default_rng(4).normal(size=(3000, 24)) * np.linspace(0.2, 2, 24) + 3
    mean, turns = embeddings.learn_rotations(x, 2)
    for r in turns:
        assert np.allclose(r.T @ r, np.eye(24), atol=1e-8)
        ones = ((x - mean) @ r >= 0).mean(axis=0)
        assert (abs(ones - 0.5) < 0.1).all()


def test_items_without_id_count_as_hits(make, spark):
    words = [f"w{i}" for i in range(30)]
    docs = make([(1, " ".join(words)), (2, "other " * 20), (None, " ".join(words[5:25]))])
    items = spark.createDataFrame([(None, " ".join(words[3:18])), (4, " ".join(words[8:20])), (None, None)], "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["longest"]) for r in decontam.contamination(docs, items).collect()}
    assert got == {1: (17, ["4"], 15), 2: (0, [], 0), None: (15, ["4"], 13)}
    kept = decontam.decontaminate(docs, items).collect()
    assert [r["doc_id"] for r in kept] == [2]
    with pytest.raises(ValueError):
        decontam.contamination(docs, items, window=28)


@pytest.mark.parametrize("pairs", [1 << 20, 50])
def test_repeated_words_cost_no_pairs(spark, make, monkeypatch, pairs):
    """One word many times against items of the same word: matches are followed from their beginnings."""
    monkeypatch.setattr(decontam, "PAIRS", pairs)
    rows = [(1, "a " * 300), (2, "a b " * 200 + "a " * 12), (3, "b " * 25 + "a")]
    asked = [(1, "a " * 30), (2, "b a " * 20), (3, "a " * 11 + "b"), (4, "a " * 11 + "c"), (1, "a " * 30)]
    items = spark.createDataFrame(asked, "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["longest"]) for r in decontam.contamination(make(rows), items).collect()}

    def longest(text):
        d, best = text.split(), 0
        for _, t in asked:
            w = t.split()
            for i in range(len(d)):
                for j in range(len(w)):
                    n = 0
                    while i + n < len(d) and j + n < len(w) and d[i + n] == w[j + n]:
                        n += 1
                    best = max(best, n)
        return best if best >= 10 else 0

    for (i, text), (_, hit, found) in zip(rows, brute(rows, asked), strict=True):
        assert got[i] == (hit, found, longest(text))


def test_memory_of_repeated_words():
    """20,000 times one word against an item of 300 of it."""
    test = decontam.TestItems([1], ["a " * 300], 10)
    data = np.frombuffer(b"a " * 20_000, dtype=np.uint8)
    tracemalloc.start()
    (row,) = decontam._shard(pa.array(["1"]), pa.array([0]), data, np.array([0, len(data)]), test)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row["spans"] == [{"start": 0, "stop": 20_000}] and row["longest"] == 300 and peak < 100 << 20
