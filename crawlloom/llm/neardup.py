"""Near-duplicate documents: minimum hashes, bands, exact check, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm import words as W
from crawlloom.llm.components import components
from crawlloom.llm.shared import Scratch, cut

WORDS, SIMILARITY, ROWS, SEED = 5, 0.8, 8, 2
#: Chance that a pair at the threshold shares no band; the number of bands follows from it.
MISS = 1e-6
#: Shingles one block of a candidate group may have, and those one compare task gets.
BLOCK_SHINGLES, SLOT_SHINGLES = 500_000, 250_000


def _shingles(w: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of each text, and their number per text.

    A text of fewer words has its whole sequence as one.
    """
    k = W.constants(11, n)
    total = len(w)
    per = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    if not total:
        return np.zeros(0, dtype=np.uint64), per
    runs = np.zeros(total, dtype=np.uint64)
    for i in range(min(n, total)):
        runs[: total - i] += w[i:] * k[i]
    first = np.cumsum(counts) - counts
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        a, c = first[d], counts[d]
        runs[a] = (w[a : a + c] * k[:c]).sum(dtype=np.uint64) + np.uint64(c)
    at = np.arange(per.sum()) + np.repeat(first - (np.cumsum(per) - per), per)
    return W.mix64(runs[at]), per


def shingle_sets(col: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, distinct shingle hashes row by row, number per row)."""
    for a, b, data, offsets in W.slices(col):
        start, end = W.word_bounds(data, offsets[1:], W.BLANK)
        counts = np.diff(np.searchsorted(start, offsets))
        runs, per = _shingles(W.hash_words(data, start, end), counts, n)
        ends = np.cumsum(per)
        sets = [np.unique(runs[e - c : e]) for e, c in zip(ends, per, strict=True)]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        yield a, b, np.concatenate(sets) if sets else runs, sizes


def minima(x: np.ndarray, sizes: np.ndarray, hashes: int, seed: int) -> np.ndarray:
    """(sets with members) x hashes: least value of each universal hash a*x + b mod 2^64."""
    full = sizes[sizes > 0]
    starts = np.cumsum(full) - full
    a, b = W.constants(seed, hashes), W.constants(seed + 1, hashes, odd=False)
    out = np.empty((len(full), hashes), dtype=np.uint64)
    if len(full):
        for k in range(hashes):
            out[:, k] = np.minimum.reduceat(x * a[k] + b[k], starts)
    return out


def _digest(x: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each set, None for an empty one."""
    out: list[bytes | None] = [None] * len(sizes)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        sums = [np.add.reduceat(W.mix64(x ^ c), starts) for c in W.constants(23, 2)]
        for i, raw in zip(full, np.stack(sums, axis=1), strict=True):
            out[i] = raw.tobytes()
    return out


PROFILE = "id string, n_shingles bigint, digest binary, bands array<bigint>"


def _profile(batches, n: int, bands: int, rows: int, seed: int):
    keys = W.constants(31, rows)
    salts = W.constants(37, bands)
    for batch in batches:
        for a, b, x, sizes in shingle_sets(batch.column(1), n):
            least = minima(x, sizes, bands * rows, seed).reshape(-1, bands, rows)
            band = W.mix64((least * keys).sum(axis=2, dtype=np.uint64) ^ salts).view(np.int64)
            offsets = np.zeros(b - a + 1, dtype=np.int32)
            np.cumsum(np.where(sizes > 0, bands, 0), out=offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a), pa.array(sizes),
                    pa.array(_digest(x, sizes), type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.ravel())),
                ],
                names=["id", "n_shingles", "digest", "bands"],
            )


SETS = "id string, digest binary, members binary, n bigint"


def _sets(batches, n: int):
    for batch in batches:
        for a, b, x, sizes in shingle_sets(batch.column(1), n):
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array(_digest(x, sizes), type=pa.binary()),
                    pa.array([x[e - s : e].tobytes() for e, s in zip(ends, sizes, strict=True)], type=pa.binary()),
                    pa.array(sizes),
                ],
                names=["id", "digest", "members", "n"],
            )


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` hashes that a pair of this similarity misses with chance ``miss`` at most."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(similarity, 1 - 1e-9) ** rows)))


def _compare(pdf: pd.DataFrame, least: int) -> pd.DataFrame:
    """Verified links inside each unit that join what it had not joined yet.

    Shared shingles are counted on the full sets: those of one set are marked, and the marks
    summed over the sets of a size that can be linked, which lie side by side.
    """
    edges = []
    for _, unit in pdf.groupby("unit", sort=False):
        unit = unit.drop_duplicates(["id", "digest"]).sort_values(["n", "id"], ignore_index=True)
        n, side, ids = unit["n"].to_numpy(), unit["side"].to_numpy(), unit["id"].to_numpy()
        every = np.concatenate([np.frombuffer(m, dtype=np.uint64) for m in unit["members"]])
        shingle = np.unique(every, return_inverse=True)[1]
        ends = np.cumsum(n)
        marked = np.zeros(int(shingle.max(initial=-1)) + 1, dtype=np.int32)
        root = np.arange(len(n))
        for i in range(len(n) - 1):
            # sorted by size: later sets are larger, so the ratio of sizes bounds the similarity
            end = int(np.searchsorted(n, n[i] * 100 / least, side="right"))
            open_ = root[i + 1 : end] != root[i]
            if side[i] >= 0:
                open_ &= side[i + 1 : end] != side[i]
            if not open_.any():
                continue
            mine = shingle[ends[i] - n[i] : ends[i]]
            marked[mine] = 1
            first, last = i + 1 + int(np.argmax(open_)), end - int(np.argmax(open_[::-1]))
            start = ends[first] - n[first]
            both = np.add.reduceat(marked[shingle[start : ends[last - 1]]], ends[first:last] - n[first:last] - start)
            marked[mine] = 0
            linked = 100 * both >= least * (n[i] + n[first:last] - both)
            for j in (np.flatnonzero(linked & open_[first - i - 1 : last - i - 1]) + first).tolist():
                if root[i] != root[j]:
                    low, high = min(root[i], root[j]), max(root[i], root[j])
                    root[root == high] = low
                    edges.append((ids[i], ids[j]))
    return pd.DataFrame(edges, columns=["a", "b"], dtype=object)


def _units(groups: DataFrame, least: int) -> DataFrame:
    """Where each member of a candidate group is compared: rows of (id, unit, side).

    A group of up to ``BLOCK_SHINGLES`` shingles is one unit. A larger one is split by
    size class, so wide that linked sets are in the same or the next class, and each
    class by hash into blocks of that many shingles; a unit is then one block (side -1)
    or a pair of blocks (side 0 and 1). Every pair that can be linked meets in a unit.
    """
    total = groups.groupBy("grp").agg(F.sum("n").alias("_total"))
    rows = groups.join(total, "grp")
    # half a percent wider than the ratio needs, against rounding
    klass = F.floor(F.log(F.col("n")) / math.log(1.005 * 100 / least)).cast("int")
    big = rows.filter(F.col("_total") > BLOCK_SHINGLES).drop("_total").withColumn("k", klass)
    small = rows.filter(F.col("_total") <= BLOCK_SHINGLES).select(
        "id", "digest", "n", F.xxhash64("grp").alias("unit"), F.lit(-1).alias("side")
    )
    blocks = big.groupBy("grp", "k").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("here"))
    above = blocks.select("grp", (F.col("k") - 1).alias("k"), F.col("here").alias("up"))
    below = blocks.select("grp", (F.col("k") + 1).alias("k"), F.col("here").alias("down"))
    shape = blocks.join(above, ["grp", "k"], "left").join(below, ["grp", "k"], "left")
    big = big.join(shape, ["grp", "k"]).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("here")).cast("int"))

    def unit(kind, k, x, y, side):
        return F.struct(F.xxhash64("grp", F.lit(kind), k, x, y).alias("unit"), side.alias("side"))

    k, blk, one, zero = F.col("k"), F.col("blk"), F.lit(1), F.lit(0)
    same = F.transform(
        F.sequence(zero, F.col("here") - 1),
        lambda o: unit("same", k, F.least(blk, o), F.greatest(blk, o),
                       F.when(o == blk, -1).when(blk < o, 0).otherwise(1)),
    )
    none = F.array().cast(same_type := "array<struct<unit:bigint,side:int>>")
    up = F.when(F.col("up").isNull(), none).otherwise(
        F.transform(F.sequence(zero, F.col("up") - 1), lambda o: unit("next", k, blk, o, zero))
    )
    down = F.when(F.col("down").isNull(), none).otherwise(
        F.transform(F.sequence(zero, F.col("down") - 1), lambda o: unit("next", k - 1, o, blk, one))
    )
    spread = big.withColumn("u", F.explode(F.concat(same.cast(same_type), up.cast(same_type), down.cast(same_type))))
    return small.union(spread.select("id", "digest", "n", "u.unit", "u.side"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    bands: int | None = None,
    rows: int = ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked when their sets of ``words``-word shingles have a Jaccard
    similarity of ``similarity`` (in whole percents) or more, checked on the full sets;
    components follow links. ``bands`` of ``rows`` minimum hashes are so many that a pair at the
    threshold shares none with probability ``MISS`` (44 at 0.85, 76 at 0.8); pairs at a third
    share one with less than 0.012. Equal sets are one class from the start, so
    exact copies are never compared. Classes that share a band form candidate groups;
    inside a group classes are compared in blocks and only the links that join something
    new are returned, so neither bands nor groups of copies turn into rows of pairs.

    Null and empty texts, and texts of blanks, have no shingles and link with nothing.
    Texts of fewer words have one shingle, the whole text. Rows repeated under one id
    are one document and come back as often; a row without id is linked with nothing and
    kept, with a null component. An empty table gives an empty table. Other columns are
    not looked at.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    kind = docs.schema[id_col].dataType
    least, bands = round(similarity * 100), bands or bands_for(similarity, rows)
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    profile = scratch.put(
        "profile", texts.mapInArrow(lambda it: _profile(it, words, bands, rows, seed), PROFILE)
    )
    named = F.col("id").cast(kind)
    classes = scratch.put(
        "classes",
        profile.filter("digest is not null and id is not null")
        .groupBy("digest").agg(F.min(named).alias("rep"), F.first("n_shingles").alias("n"))
    )
    reps = classes.withColumn("id", F.col("rep").cast("string"))
    banded = (
        profile.filter("id is not null").join(reps.select("id", "digest", "rep"), ["id", "digest"])
        .select("rep", F.posexplode("bands").alias("band", "key"))
    )
    banded = scratch.put("bands", banded.distinct())
    least_rep = banded.groupBy("band", "key").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("c"))
    stars = banded.join(least_rep.filter("c > 1"), ["band", "key"]).filter("rep <> least")
    groups = cut(components(stars.select("rep", "least").distinct(), "rep", "least"))
    scratch.drop("bands")

    members = reps.join(groups.withColumnRenamed("component", "grp"), F.col("rep") == F.col("node"))
    units = scratch.put("units", _units(members.select("id", "digest", "n", "grp"), least))
    load = units.agg(F.sum("n")).first()[0] or 0
    slots = max(1, math.ceil(load / SLOT_SHINGLES))
    wanted = units.select("id").distinct()
    sets = texts.join(wanted, "id", "left_semi").mapInArrow(lambda it: _sets(it, words), SETS)
    placed = sets.select("id", "digest", "members").join(units, ["id", "digest"])
    placed = placed.withColumn("slot", F.pmod(F.xxhash64("unit"), F.lit(slots)))
    links = placed.groupBy("slot").applyInPandas(lambda pdf: _compare(pdf, least), "a string, b string")
    links = scratch.put("links", links.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")))
    scratch.drop("units")

    joined = components(links)
    found = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("_component")
    )
    out = profile.withColumn("_named", named).join(found, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "_named"))
    return out.select(
        F.col("_named").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("_named") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id; columns as they were.

    Rows without id stay. Identical rows under the id that stays, stay with it.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.filter("not kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
