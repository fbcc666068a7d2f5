import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlloom.llm import packing, ranking, resampling

ASCII = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(ASCII))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


def check_packing(rows, out, tokenizer, capacity):
    """Every id in exactly one piece, sequences without gaps, padding nowhere."""
    want = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want[i, tuple(ids)] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and r["length"] == len(r["ids"]) > 0
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i in {i for i, _ in rows}:
        mine = sorted(((r["start"], r["ids"], r["doc_tokens"]) for r in pieces[i]), key=lambda x: x[0])
        docs = [list(ids) for (j, ids), n in want.items() if j == i for _ in range(n)]
        assert sum(len(p[1]) for p in mine) == sum(map(len, docs))
        if len(docs) == 1:
            assert [x for p in mine for x in p[1]] == docs[0] and {p[2] for p in mine} == {len(docs[0])}
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [0, *np.cumsum([p[1] for p in parts]).tolist()[:-1]]
        size = sum(p[1] for p in parts)
        assert size == capacity or size < capacity and size.bit_count() == 1


@pytest.mark.parametrize("parts,most_open", [(1, 4096), (3, 4096), (2, 3)])
def test_packing(make, tokenizer, monkeypatch, parts, most_open):
    monkeypatch.setattr(packing, "MOST_OPEN", most_open)
    rng = random.Random(4)
    pool = ["Haanth.", "the", "É́té", "don't", "ΣΣ", "你好", "<|endoftext|>", "<|ENDOFTEXT|>", "a\x1cb", "x y", "﻿", "12,5"]
    rows = [(i, rng.choice([" ", "\n", "\t\x0b", "  "]).join(rng.choice(pool) for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "word " * 3000), (204, "q" * 5000), (None, "no id"), (7, "again"), (7, "again")]
    docs = make(rows).repartition(parts)
    out = packing.pack(docs, capacity=64).collect()
    check_packing(rows, out, tokenizer, 64)
    assert packing.pack(docs, capacity=64, with_ids=False).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]


def test_packing_of_the_table(documents, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    out = packing.pack(documents).collect()
    check_packing(rows, out, tokenizer, 2048)
    short = {i for i, t in rows if len(tokenizer.encode(t or "", add_special_tokens=False).ids) < 2048}
    cut = [i for i, n in Counter(r["doc_id"] for r in out).items() if n > 1 and i in short]
    assert len(cut) < 0.1 * len(short)  # most documents stay whole


def test_windows(make):
    docs = make([(1, "a b c"), (2, None), (3, "d " * 50)])
    out = packing.sequences(packing.pack(docs, capacity=16), capacity=16, pad=9).collect()
    assert all(len(r["ids"]) == 16 and r["pad"] == 0 or len(r["ids"]).bit_count() == 1 for r in out)
    assert sum(d["length"] for r in out for d in r["docs"]) == 4 + 1 + 51
    pieces = packing.pack(docs, capacity=16).filter(F.col("doc_id") == 1)  # half a window: what is missing is padded
    assert {(len(r["ids"]), r["pad"]) for r in packing.sequences(pieces, capacity=16, pad=9).collect()} <= {(4, 0), (16, 13), (16, 14), (16, 15), (1, 0), (2, 0)}
    assert packing.pack(make([])).collect() == []


def squares(open_levels):
    return sum(n * n for n in Counter(open_levels).values())


def test_levels_minimise_squares():
    rng, capacity = random.Random(3), 12
    levels, mine = packing.Levels(capacity), []
    for _ in range(500):
        size = rng.randrange(1, capacity)
        choices = []
        for h in {0, *mine}:
            if h + size <= capacity:
                after = list(mine)
                if h:
                    after.remove(h)
                if h + size < capacity:
                    after.append(h + size)
                choices.append((squares(after), -h, after))
        best = min(choices, key=lambda c: c[:2])
        assert levels.level_for(size) == -best[1]
        levels.add(packing.Piece(0, 0, np.zeros(size, dtype=np.uint32), size))
        mine = best[2]
        assert levels.open == len(mine) == sum(map(len, levels.windows))


# --- ranked search


def brute_search(rows, items, top=10):
    bags = [(i, Counter(words(t))) for i, t in rows]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for k, (item, text) in enumerate(items):
        found = []
        for i, b, n in bags:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                for t in words(text) if t in b
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        found.sort()
        out += [(item, r + 1, None if none else i, -s, k) for r, (s, none, i) in enumerate(found[:top])]
    return out


@pytest.mark.parametrize("block,cells", [(1 << 20, 1 << 20), (60, 7)])
def test_search_against_brute_force(make, spark, monkeypatch, block, cells):
    monkeypatch.setattr(ranking, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranking, "CELLS", cells)
    rng = random.Random(6)
    pool = ["a", "B", "b", "É", "é", "x1", "the", "die", "42", "ñ"] + [f"w{i}" for i in range(30)]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(pool) for _ in range(n))

    rows = [(i, text(rng.randrange(1, 12))) for i in range(300)]
    rows += [(1000 + i, "the a w1") for i in range(60)] + [(None, "the a w1"), (5, "the a w1"), (5, "the a w1")]
    rows += [(400, None), (401, ""), (402, "--"), (403, "the " * 5000), (404, "other words only")]
    items = [(i, text(rng.randrange(1, 9))) for i in range(25)]
    items += [(30, "the a w1"), (30, "THE a W1 the"), (None, "w1"), (31, None), (32, ""), (33, "unknown"), (34, "é " * 200)]
    asked = spark.createDataFrame([(i, t, 1.0, 2) for i, t in items], "item_id bigint, text string, score double, rank int")
    out = ranking.search(make(rows).repartition(4), asked).collect()
    by_item = defaultdict(list)
    for r in out:
        by_item[r["item_row"]].append((r["item_id"], r["rank"], r["doc_id"], r["score"]))
    want = defaultdict(list)
    for *r, k in brute_search(rows, items):
        want[k].append(tuple(r))
    assert sorted(map(str, (sorted(v, key=lambda x: x[1]) for v in by_item.values()))) == sorted(map(str, want.values()))


def test_search_of_empty_tables(make, spark):
    items = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert ranking.search(make([]), items).collect() == []
    assert ranking.search(make([(1, "the")]), items.limit(0)).collect() == []
    assert ranking.search(make([(1, None)]), items).collect() == []


def test_scores_are_exact_beyond_doubles():
    query = ranking.Queries([0, 1], ["a " * 9000, "b a"])
    query.weight[:] = 2**29 + 1
    bag = np.array([0, 1, 3, 5], dtype="<i4")
    got = ranking._scores(query, [bag], np.array([25]))
    part = [(2**29 + 1) * ((10**9 * tf) // (1000 * tf + 200)) for tf in (3, 5)]
    which = {h: k for k, h in enumerate(query.terms.tolist())}
    a, b = (part[which[int(ranking.W.hash_words(np.frombuffer(x, dtype=np.uint8), np.array([0]), np.array([1]))[0])]] for x in (b"a", b"b"))
    assert got.tolist() == [[9000 * a, a + b]]


# --- importance resampling


def brute_resample(rows, target, percent=10, least=20, ngrams=1, buckets=10_000, seed=2024):
    def runs(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]

    source, aim = Counter(), Counter()
    for _, t in rows:
        source.update(runs(t))
    for t in target:
        aim.update(runs(t))
    s_all, t_all = sum(source.values()), sum(aim.values())
    out = []
    for i, t in rows:
        found = runs(t)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, len(words(t)) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted(str((*r[:4], rank.get(id(r)))) for r in out)


@pytest.mark.parametrize("options", [{}, {"percent": 55, "least_words": 0, "ngrams": 3, "buckets": 97}, {"percent": 100, "least_words": 3}])
def test_resampling_against_brute_force(make, spark, options):
    rng = random.Random(8)
    pool = ["Ab", "é", "É", "x1", "Ñandu", "z" * 70, "the", "of"] + [f"w{i}" for i in range(50)]
    rows = [(rng.randrange(10**6), " - ".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for _ in range(300)]
    rows += [(-5, "the " * 30), (2**40, "x " * 3000), (3, None), (4, ""), (9, "same " * 25), (9, "same " * 25), (None, "q w " * 12)]
    target = ["the of w1 w2", None, "", "Ñandu"]
    docs, aim = make(rows).repartition(3), spark.createDataFrame([(t, 1) for t in target], "text string, score int")
    out = resampling.resample(docs, aim, **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    names = {"least_words": "least"}
    assert sorted(str(tuple(r)) for r in out.collect()) == brute_resample(rows, target, **{names.get(k, k): v for k, v in options.items()})


def test_resampling_of_empty_tables(make, spark):
    aim = spark.createDataFrame([], "text string")
    assert resampling.resample(make([]), aim).collect() == []
    assert resampling.resample(make([(1, "a")]), aim).first()["rank"] is None
    assert [r["rank"] for r in resampling.resample(make([(1, "a")]), aim, percent=100, least_words=1).collect()] == [1]


@pytest.mark.parametrize("digit_bits,block_rows", [(2, 50), (3, 64), (12, 1 << 20), (16, 70)])
def test_radix_sort(spark, monkeypatch, digit_bits, block_rows):
    monkeypatch.setattr(resampling, "BLOCK_ROWS", block_rows)
    rng = random.Random(1)
    rows = [(rng.randrange(8), rng.choice([0, 5, 5, 5, 1000]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "low bigint, high bigint, n int").coalesce(2)
    out, _ = resampling.radix_sort(df, [("low", 3), ("high", 10)], digit_bits)
    got = [(r["low"], r["high"], r["n"]) for r in sorted(out.collect(), key=lambda r: r["at"])]
    assert sorted(r["at"] for r in out.collect()) == list(range(200))
    assert got == sorted(rows, key=lambda r: (r[1], r[0]))  # equal rows keep their order


def test_crc32_of_ranges():
    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 5, 64, 65, 300, 2, 2]]
    data, ends = np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(p) for p in parts])
    got = resampling.crc32_ranges(data, ends - np.array([len(p) for p in parts]), ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    *_, found = next(resampling.features(pa.array(["B a", None]), 2, 1 << 32))
    assert found.tolist() == [zlib.crc32(x) for x in (b"b", b"a", b"b a")]
