import random

import numpy as np
import pytest

from crawlloom.llm import neardup
from crawlloom.llm.components import components


def brute(rows, least):
    """Smallest id of each component, all pairs compared as sets of word runs."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= least * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("similarity", [0.85, 0.8])
def test_against_brute_force(documents, similarity):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert found(neardup.near_duplicates(documents, similarity=similarity)) == brute(rows, round(100 * similarity))


def test_hot_group_in_blocks(make, monkeypatch):
    # one group of very many near copies, small blocks: most pairs meet in units of two blocks
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(neardup, "SLOT_SHINGLES", 2000)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words[: 60 - rng.randrange(8)])))
    assert found(neardup.near_duplicates(make(rows), similarity=0.85)) == brute(rows, 85)


def test_odd_rows(make):
    long = " ".join(str(i) for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, "two one"),
        (7, long), (8, long + " end"), (9, "É a b c d e"), (10, "é a b c d e"), (None, "one two"), (5, "ONE  two"),
    ]
    out = neardup.near_duplicates(make(rows)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out}
    for i in (1, 2, 3):
        assert got[i] == (0, i, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6] == (1, 6, True)
    assert got[8] == (29_997, 7, False) and got[7][1] == 7
    assert got[9][1] == 9 and got[10][1] == 10  # only A-Z are lower-cased
    assert got[None] == (1, None, True)
    kept = neardup.keep_one(make(rows))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9, 10]
    assert kept.columns == make(rows).columns


def test_empty(make):
    assert neardup.near_duplicates(make([])).collect() == []


def test_components(spark):
    # a path, a star, a pair, repeated and self links, null ends
    path = [(i, i + 1) for i in range(10, 40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    edges = [*path, *star, (7, 5), (5, 7), (3, 3), (None, 2), (2, None)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    want = {i: 10 for i in range(10, 41)} | {i: 100 for i in range(100, 150)} | {5: 5, 7: 5}
    assert got == want
    assert components(spark.createDataFrame([], "a int, b int")).collect() == []


def test_few_pairs_share_a_band():
    """Pages of one template: sets that share some of their shingles, none of them a link."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(shared, 50, replace=False), rng.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(1500)]
    sizes = np.array([len(x) for x in sets])

    def pairs(bands, rows):
        least = neardup.minima(np.concatenate(sets), sizes, bands * rows, 1).reshape(len(sets), bands, rows)
        out = set()
        for b in range(bands):
            _, key = np.unique(least[:, b], axis=0, return_inverse=True)
            for k in np.flatnonzero(np.bincount(key) > 1):
                at = np.flatnonzero(key == k)
                out |= {(int(x), int(y)) for i, x in enumerate(at) for y in at[i + 1 :]}
        return len(out)

    assert pairs(neardup.bands_for(0.85), 8) * 10 <= pairs(28, 5)


def test_number_of_bands():
    for similarity in (0.5, 0.8, 0.85, 1.0):
        n = neardup.bands_for(similarity)
        assert (1 - similarity**8) ** n <= 1e-6 and (n == 1 or (1 - similarity**8) ** (n - 1) > 1e-6)
