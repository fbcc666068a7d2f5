"""Near-duplicate vectors: iterative quantisation, multi-index tables, exact rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.components import components
from crawlloom.llm.shared import Scratch

COSINE, SAMPLE, SEED = 0.98, 8192, 10
#: Substrings of the code that have a table each, and their bits, where they find enough.
TABLES, BITS, ITERATIONS = 20, 16, 40
#: Share of the pairs right at the threshold that the tables must bring together, the
#: most tables and the lengths to choose from where they don't, and the pairs measured.
RECALL, MOST_TABLES, LENGTHS, MEASURED = 0.998, 512, (16, 14, 12, 10, 8, 6), 2048
#: Vectors of a block of a bucket, and rows one compare task gets.
BLOCK, SLOT_ROWS = 256, 20_000


def learn_rotations(x: np.ndarray, codes: int, seed: int = SEED, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotations): orthogonal maps whose signs are balanced codes of the vectors.

    Iterative quantisation (Gong & Lazebnik 2011): principal axes, then by turns the
    nearest vertices of the cube and the rotation that fits them best. Each of the
    ``codes`` rotations starts from another random one, so their codes differ.
    """
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(x.shape[1]))
    projected, out = centred @ axes, []
    for _ in range(codes):
        r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
        for _ in range(iterations):
            u, _, v = np.linalg.svd(np.where(projected @ r >= 0, 1.0, -1.0).T @ projected)
            r = v.T @ u.T
        out.append(axes @ r)
    return mean, np.stack(out)


class Index(NamedTuple):
    """The codes of one vector length; no bits means that all pairs are compared."""

    mean: np.ndarray
    turns: np.ndarray
    tables: int
    bits: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The substring of each table, for unit vectors."""
        if not self.bits:
            return np.zeros((len(x), 1), dtype=np.int16)
        signs = _signs(x, self.mean, self.turns)[:, : self.tables * self.bits]
        return _substrings(signs, self.bits).astype(np.uint16).view(np.int16)


def _signs(x: np.ndarray, mean: np.ndarray, turns: np.ndarray) -> np.ndarray:
    x = x - mean
    return np.concatenate([x @ r >= 0 for r in turns], axis=1)


def _substrings(signs: np.ndarray, bits: int) -> np.ndarray:
    return signs.reshape(len(signs), -1, bits) @ (1 << np.arange(bits))


def _at_threshold(x: np.ndarray, cosine: float, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the threshold: vectors of the sample and others at that angle to them.

    Once turned in any direction, once towards other vectors of the sample.
    """
    a, other = x[rng.integers(0, len(x), MEASURED)], x[rng.integers(0, len(x), MEASURED)]
    out = []
    for to in (rng.normal(size=a.shape), other - x.mean(axis=0)):
        for _ in range(2):  # what the first round leaves of a nearly parallel vector is not orthogonal
            to = to - (to * a).sum(axis=1, keepdims=True) * a
        long = np.linalg.norm(to, axis=1)
        usable = long > 1e-9
        if usable.any():
            turned = to[usable] / long[usable, None]
            out.append((a[usable], cosine * a[usable] + math.sqrt(1 - cosine**2) * turned))
    return out


def _tables_needed(differ: list[np.ndarray], bits: int) -> int | None:
    """Least number of tables that reach RECALL when bits differ at these rates."""
    agree = [(1 - d) ** bits for d in differ]
    low, high = 0, MOST_TABLES + 1
    while high - low > 1:
        mid = (low + high) // 2
        enough = min(1 - ((1 - a) ** mid).mean() for a in agree) >= RECALL
        low, high = (low, mid) if enough else (mid, high)
    return high if high <= MOST_TABLES else None


def fit(x: np.ndarray, dim: int, group: float, cosine: float = COSINE, seed: int = SEED) -> Index:
    """Rotations, number of tables and bits that suit the sample ``x`` of unit vectors.

    Where vectors lie close around their mean, two of them at the threshold are far
    apart as seen from it and many bits differ. So the rate is measured on pairs made
    from the sample. If ``TABLES`` of ``BITS`` don't bring enough of them together, the
    cheapest other length and number of tables that does is taken, or the comparison
    of all pairs if that costs less in groups of ``group`` vectors.
    """
    mean, turns = learn_rotations(x, math.ceil(TABLES * BITS / dim), seed)
    usual = Index(mean, turns, TABLES, BITS)
    if not len(x):
        return usual
    pairs = _at_threshold(x, min(max(cosine, -1.0), 1.0), np.random.default_rng(seed))
    met = [(usual.codes(a) == usual.codes(b)).any(axis=1).mean() for a, b in pairs]
    if min(met, default=1.0) >= RECALL:
        return usual
    differ = [(_signs(a, mean, turns) != _signs(b, mean, turns)).mean(axis=1) for a, b in pairs]
    signs = _signs(x, mean, turns)
    # vectors of blocks a vector meets, each about as dear as a row of the index
    best, cost = Index(mean, turns, 1, 0), 1 + group / BLOCK
    for bits in LENGTHS:
        tables = _tables_needed(differ, bits)
        if tables is None:
            continue
        codes = _substrings(signs[:, : signs.shape[1] // bits * bits], bits)
        share = np.mean([(np.bincount(c, minlength=1).astype(float) ** 2).sum() for c in codes.T]) / len(x) ** 2
        if (price := tables * (1 + group * share / BLOCK)) < cost:
            best, cost = Index(mean, turns, tables, bits), price
    if best.tables * best.bits > signs.shape[1]:
        best = best._replace(turns=learn_rotations(x, math.ceil(best.tables * best.bits / dim), seed)[1])
    return best


def _unit(rows: pa.Array) -> list[np.ndarray | None]:
    """Each vector divided by its length in double precision, None if it can't be compared."""
    out: list[np.ndarray | None] = []
    for v in rows:
        raw = v.values if v.is_valid else None
        if raw is None or raw.null_count or not len(raw):
            out.append(None)
            continue
        x = raw.to_numpy(zero_copy_only=False).astype(np.float64)
        ok = np.isfinite(x).all() and x.any()
        if ok:
            x = x / np.abs(x).max()  # neither very long nor very short vectors leave the range
            x = x / np.linalg.norm(x)
        out.append(x if ok else None)
    return out


CODED = "id string, label string, dim int, vec binary, digest binary, keys array<smallint>"


def _encode(batches, shared) -> Iterator[pa.RecordBatch]:
    models = shared.value
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            units = _unit(part.column(2))
            keys: list[list[int] | None] = [None] * len(units)
            dims = [None if u is None else len(u) for u in units]
            for dim in {d for d in dims if d}:
                rows = [i for i, d in enumerate(dims) if d == dim]
                codes = models[dim].codes(np.stack([units[i] for i in rows]))
                for i, k in zip(rows, codes.tolist(), strict=True):
                    keys[i] = k
            raw = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(dims, type=pa.int32()),
                    pa.array(raw, type=pa.binary()),
                    pa.array([None if r is None else _digest(r) for r in raw], type=pa.binary()),
                    pa.array(keys, type=pa.list_(pa.int16())),
                ],
                names=["id", "label", "dim", "vec", "digest", "keys"],
            )


def _digest(raw: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(raw, digest_size=16).digest()


LINKS = "a bigint, links bigint, b bigint"


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _compare(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Per class and unit, how many vectors it links to there, and links that join classes.

    A pair that several tables bring together counts in the first of them only.
    """
    out = []
    for _, unit in pdf.groupby("unit", sort=False):
        unit = unit.drop_duplicates("cls")
        if len(unit) < 2:
            continue
        x = np.stack([np.frombuffer(v, dtype=np.float64) for v in unit["vec"]])
        keys = np.stack(unit["keys"].to_numpy())
        cls, size = unit["cls"].to_numpy(), unit["size"].to_numpy()
        side, own = unit["side"].to_numpy(), int(unit["tab"].iloc[0])
        close = x @ x.T >= cosine
        close &= np.triu(np.ones(close.shape, dtype=bool), 1) if side[0] < 0 else (side[:, None] == 0) & (side == 1)
        i, j = np.nonzero(close)
        first = (keys[i] == keys[j]).argmax(axis=1) == own if len(i) else np.zeros(0, dtype=bool)
        i, j = i[first], j[first]
        links = np.bincount(i, size[j], len(cls)) + np.bincount(j, size[i], len(cls))
        for a in np.flatnonzero(links):
            out.append((cls[a], int(links[a]), None))
        parent = np.arange(len(cls))
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            p, q = _find(parent, p), _find(parent, q)
            if p != q:
                parent[max(p, q)] = min(p, q)
        for a in range(len(cls)):
            root = _find(parent, a)
            if root != a:
                out.append((cls[a], 0, cls[root]))
    got = pd.DataFrame(out, columns=["a", "links", "b"], dtype=object)
    return got.astype({"a": "Int64", "links": "Int64", "b": "Int64"})


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
    cosine: float = COSINE,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors of equal label and length are linked at a cosine of ``cosine`` or more.
    Rotations are learned on at most about ``sample`` vectors of each length, drawn by a
    hash of the id and the vector; every vector is coded and indexed. Two vectors are
    compared, with their original components, when one of the substrings of their codes
    agrees; pairs whose codes differ in fewer bits than there are tables always are.
    There are ``TABLES`` substrings of ``BITS`` bits if these bring ``RECALL`` of the pairs
    together that ``fit`` makes at the threshold from the sample, else as many of such
    length as it takes, or all pairs of a label are compared if that is cheaper. So what
    is missed depends on how well the sample stands for the vectors; where these lie
    around many centres of very different width, it is more in the narrow ones. Vectors that agree in direction are one class and counted, not paired.
    A bucket is cut into blocks of ``BLOCK`` vectors and each pair of blocks is a unit
    of its own; units return sums of links and a spanning forest, never the pairs.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, nor do rows with a null label. A row without id links with nothing and is
    kept, with a null component. Rows repeated under one id are copies of each other,
    each counted and returned. An empty table gives an empty table. Other columns are not
    looked at.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "vectors")
    kind = vectors.schema[id_col].dataType
    label = F.lit("") if label_col is None else F.col(label_col).cast("string")
    rows = vectors.select(F.col(id_col).cast("string").alias("id"), label.alias("label"), F.col(vec_col).alias("v"))
    models = {}
    counts = rows.filter("size(v) > 0").groupBy(F.size("v").alias("dim"), "label").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.groupBy("dim").agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("c").cast("double")) / F.sum("c")).alias("group"))
    for r in counts.collect():
        draw = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40)) / float(1 << 40)
        drawn = rows.filter((F.size("v") == r["dim"]) & (draw <= sample / r["n"])).select("v").limit(2 * sample)
        x = [u for u in _unit(pa.array([d["v"] for d in drawn.collect()], type=pa.list_(pa.float64()))) if u is not None]
        x = np.stack(x) if x else np.zeros((0, r["dim"]))
        models[r["dim"]] = fit(x, r["dim"], r["group"], cosine, seed)
    shared = spark.sparkContext.broadcast(models)
    coded = scratch.put("coded", rows.mapInArrow(lambda it: _encode(it, shared), CODED))

    named = F.col("id").cast(kind)
    alike = ["label", "dim", "digest"]
    usable = coded.filter("digest is not null and label is not null and id is not null")
    classes = scratch.put(
        "classes",
        usable.groupBy(alike).agg(
            F.min(named).alias("rep"), F.count(F.lit(1)).alias("size"),
            F.min("vec").alias("vec"), F.first("keys").alias("keys"),
        ).withColumn("cls", F.xxhash64("label", "dim", "digest")),
    )
    narrow = classes.select("cls", "label", "dim", F.posexplode("keys").alias("tab", "key"))
    buckets = narrow.groupBy("label", "dim", "tab", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    met = narrow.join(buckets, ["label", "dim", "tab", "key"])
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.xxhash64("label", "dim", "tab", "key", F.least("blk", o), F.greatest("blk", o)).alias("unit"),
            F.when(F.col("blk") == o, -1).when(F.col("blk") < o, 0).otherwise(1).alias("side"),
        ),
    )
    units = scratch.put("units", met.select("cls", "tab", F.explode(pairs).alias("u")).select("cls", "tab", "u.*"))
    slots = max(1, math.ceil(units.count() / SLOT_ROWS))
    placed = units.join(classes.select("cls", "vec", "keys", "size"), "cls")
    placed = placed.withColumn("slot", F.pmod(F.xxhash64("unit"), F.lit(slots)))
    found = scratch.put("links", placed.groupBy("slot").applyInPandas(lambda pdf: _compare(pdf, cosine), LINKS))
    scratch.drop("units")

    sums = found.filter("links > 0").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    reps = classes.select("cls", "rep", "size", *alike)
    ends = found.filter("b is not null").join(reps.select(F.col("cls").alias("a"), F.col("rep").alias("x")), "a")
    ends = ends.join(reps.select(F.col("cls").alias("b"), F.col("rep").alias("y")), "b")
    joined = components(ends.select("x", "y"), "x", "y")
    known = (
        reps.join(sums, "cls", "left").join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            *alike, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = coded.select("id", named.alias("_named"), *alike).join(known, alike, "left")
    linked = F.col("id").isNotNull()
    component = F.when(linked, F.coalesce("component_id", "_named"))
    return out.select(
        F.col("_named").alias(id_col), F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_named") == component, F.lit(True)).alias("kept"),
    )
