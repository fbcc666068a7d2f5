"""Mixing sources to target weights by pivotal dependent rounding in a reduction tree."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlloom.llm.shared import Scratch, cut
from crawlloom.session import broadcast_if_small

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, 20
#: Rows one task rounds at a time, and blocks whose residuals meet in one node.
BLOCK_ROWS, FAN_IN = 50_000, 64
#: Rows of one id beyond which they are dealt to blocks one by one.
MANY_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of their code points, null last, get the weights in turn and share
    ``share`` of all sizes. No target exceeds ``most`` times its source's size; what is
    above is shared out again by weight. With ``share`` > ``most`` all stop there. The
    rank of a source is its place in its range partition plus the rows of the partitions
    before, so the list of sources passes through no single task.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = cut(
        sums.withColumn("nul", F.col("source").isNull())
        .repartitionByRange("nul", "source").withColumn("part", F.spark_partition_id())
    )
    per_part = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, at = {}, 0
    for part in sorted(per_part):
        before[part], at = at, at + per_part[part]
    if not before:
        return sums.withColumn("target", F.lit(0.0))
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    place = F.row_number().over(Window.partitionBy("part").orderBy("nul", "source")) - 1
    ring = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut(
        ranged.withColumn("rank", place + starts[F.col("part")])
        .withColumn("weight", F.get(ring, (F.col("rank") % len(weights)).cast("int")))
        .select("source", "source_size", "weight")
    )
    cap, limit = F.col("source_size") * most, math.inf
    total = ranked.agg(F.sum("source_size")).first()[0] * share
    while True:  # the level rises with each round; a source that is full stays full
        full = F.col("weight") * limit > cap if limit < math.inf else F.lit(False)
        row = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        level = (total - row["full"]) / row["open"] if row["open"] else limit
        if limit < math.inf and level <= limit:
            break
        limit = level
    return ranked.select("source", "source_size", F.least(F.col("weight") * limit, cap).alias("target"))


def _mix64(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def pivotal(p: list[float], size: list[float], key: list[int], seed: int) -> tuple[list[float], int]:
    """Round probabilities pair by pair; returns them and the open place, or -1.

    A pair moves mass along the line that keeps size_i*p_i + size_j*p_j: up for one and
    down for the other until one of them is 0 or 1. The two directions are drawn so that
    each expected probability stays as it was.
    """
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        i, si, sj = at, size[at], size[j]
        up_i, up_j = (1.0 - p[i]) * si, p[j] * sj
        dn_i, dn_j = p[i] * si, (1.0 - p[j]) * sj
        up, down = min(up_i, up_j), min(dn_i, dn_j)
        draw = _mix64(seed ^ _mix64(key[i] ^ _mix64(key[j]))) / 2.0**64
        if draw * (up + down) < down:
            p[i] = 1.0 if up_i <= up_j else p[i] + up / si
            p[j] = 0.0 if up_j <= up_i else p[j] - up / sj
        else:
            p[i] = 0.0 if dn_i <= dn_j else p[i] - down / si
            p[j] = 1.0 if dn_j <= dn_i else p[j] + down / sj
        at = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return p, at


def _round(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["_src", "_node", "_key", "_id"], kind="stable", ignore_index=True)
    frac, still = pdf["_p"].to_numpy(dtype=float).copy(), np.zeros(len(pdf), dtype=bool)
    size, key = pdf["size"].to_numpy(dtype=float), pdf["_key"].to_numpy().astype(np.uint64)
    src, node = pdf["_src"].to_numpy(), pdf["_node"].to_numpy()
    new = np.flatnonzero((src[1:] != src[:-1]) | (node[1:] != node[:-1])) + 1
    for a, b in zip([0, *new], [*new, len(pdf)], strict=True):
        out, at = pivotal(list(frac[a:b]), list(size[a:b]), [int(k) for k in key[a:b]], seed)
        frac[a:b] = out
        if at >= 0:
            still[a + at] = True
    pdf["_p"], pdf["_open"] = frac, still
    return pdf


def _tree(rows: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """Round every row; what stays open in a node meets its neighbours a level higher."""
    total = rows.count()
    nodes, level, decided = max(1, math.ceil(total / BLOCK_ROWS)), 0, []
    work = rows.withColumn("_node", F.pmod("_deal", F.lit(nodes))).drop("_deal")
    open_rows = total
    while True:
        slots = max(1, math.ceil(open_rows / BLOCK_ROWS))
        # level 0: a node's rows of all sources; above: the few residuals of a source
        slot = F.col("_node") if level == 0 else F.pmod(F.xxhash64("_src", "_node"), F.lit(slots))
        grouped = work.withColumn("_slot", slot)
        out = scratch.put(
            f"level{level}",
            grouped.groupBy("_slot").applyInPandas(
                lambda pdf: _round(pdf, seed), grouped.withColumn("_open", F.lit(False)).schema
            ),
        )
        if nodes == 1:
            # the last residual of a source is drawn on its own
            u = F.pmod(F.xxhash64(F.col("_key"), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
            last = out.withColumn("_p", F.when(F.col("_open"), (u < F.col("_p")).cast("double")).otherwise(F.col("_p")))
            decided.append(last)
            break
        decided.append(out.filter(~F.col("_open")))
        work = out.filter("_open").drop("_slot", "_open")
        work = work.withColumn("_node", F.floor(F.col("_node") / FAN_IN))
        open_rows, nodes, level = work.count(), math.ceil(nodes / FAN_IN), level + 1
    whole = decided[0]
    for part in decided[1:]:
        whole = whole.union(part)
    return whole


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    A row is taken floor(r) or floor(r) + 1 times, r = target / source_size. The extra
    copies are drawn by pivotal rounding on words, so what a source gives differs from
    its target by less than one document. Draws depend on ids, sizes and ``seed`` alone.

    Null texts and texts without words have size 0 and are taken floor(r) times. A null
    source is a source of its own, the last one. Rows repeated under one id, or without
    id, are decided one by one; where more than ``MANY_ROWS`` share an id, or
    have none, they are dealt to blocks by row, so no block is too large for one task. An empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.put(
        "sizes",
        docs.select(
            F.col(id_col).cast("string").alias("_id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"), F.monotonically_increasing_id().alias("_row"),
        ),
    )
    targets = source_targets(rows, weights, share, most).withColumnRenamed("source", "_source")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        rows.withColumn("_ratio", ratio)
        .withColumn("_whole", F.floor("_ratio"))
        .withColumn("_p", F.when(F.col("size") > 0, F.col("_ratio") - F.col("_whole")).otherwise(0.0))
        .withColumn("_key", F.xxhash64(F.col("_id"), F.lit(seed)))
        .withColumn("_src", F.xxhash64(F.col("source")))
        .drop("_ratio")
    )
    # rows of an id that very many rows share, or of none, are dealt out by the row as it was written
    often = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MANY_ROWS)
    often = often.select(F.col("_id").alias("_often"), F.lit(True).alias("_hot"))
    few = broadcast_if_small(often)
    rows = rows.join(often if few is None else few, F.col("_id").eqNullSafe(F.col("_often")), "left")
    deal = F.when(F.col("_hot"), F.xxhash64("_key", "_row")).otherwise(F.col("_key"))
    rows = rows.withColumn("_deal", deal).drop("_often", "_hot", "_row")
    copies = (F.col("_whole") + F.col("_p").cast("long")).alias("copies")
    return _tree(rows, seed, scratch).select(
        F.col("_id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("source").alias(source_col), "size", "source_size",
        "target", copies, (copies * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: rows of ``docs`` repeated as ``mix_plan`` says; ids must be unique."""
    plan = mix_plan(docs, id_col, **options).filter("copies > 0").select(F.col(id_col).alias("_id"), "copies")
    whole = docs.select(F.struct(*docs.columns).alias("_doc"))
    whole = whole.join(plan, F.col("_doc")[id_col].eqNullSafe(F.col("_id")))
    return whole.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")
