import random

import pytest

from pyspark.sql import functions as F

from crawlloom.functions.hashing import hash_key
from crawlloom.operators import dedup, order, project, stats
from crawlloom.operators.bloom import bloom_of, maybe_seen, unite
from crawlloom import session
from crawlloom.session import broadcast_if_small


def _copies(spark, n=3000):
    """A third of all rows are copies of one text."""
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"t{rng.randrange(n)}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "i long, text string").withColumn(
        "k", hash_key(F.col("text"))
    )


def test_dedup_first_is_independent_of_partitioning(spark):
    rows, df = _copies(spark)
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    for parts in (1, 7):
        got = dedup.dedup_first(df.repartition(parts), "k", ["i"]).collect()
        assert {(r.text, r.i) for r in got} == set(first.items()) and len(got) == len(first)
    # several order columns
    two = df.withColumn("f", (F.col("i") / 100).cast("int"))
    got = dedup.dedup_first(two, "k", ["f", "i"]).collect()
    assert {(r.text, r.i) for r in got} == set(first.items())


def test_seen_keys(spark):
    rows, df = _copies(spark)
    seen_texts = {"hot"} | {t for _, t in rows[:500]}
    seen = spark.createDataFrame([(t,) for t in seen_texts], "text string").select(
        hash_key(F.col("text")).alias("k")
    )
    left = sorted(i for i, t in rows if t not in seen_texts)
    assert sorted(r.i for r in dedup.drop_seen(df, "k", seen).collect()) == left
    fresh = {t for _, t in rows} - seen_texts
    assert dedup.new_hashes(df, "k", seen).count() == len(fresh)
    kept = dedup.dedup_unseen(df, "k", ["i"], seen).collect()
    assert {r.text for r in kept} == fresh and len(kept) == len(fresh)


def test_drop_seen_scans_each_side_once(spark):
    rows, df = _copies(spark, 300)
    seen = df.select("k").filter("i < 50")
    seen_texts = {t for i, t in rows if i < 50}
    out = dedup.drop_seen(df, "k", seen)
    assert sorted(r.i for r in out.collect()) == sorted(i for i, t in rows if t not in seen_texts)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2


def test_carry_forward_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"f{rng.randrange(3)}", i, rng.random() < 0.05) for i in range(2000)]
    df = spark.createDataFrame(rows, "f string, i long, m boolean")
    value = F.concat(F.lit("v"), F.col("i"))
    want, last = {}, {}
    for f, i, m in rows:
        if m:
            last[f] = f"v{i}"
        want[i] = last.get(f)
    for block in (7, 100, 10_000):
        got = order.carry_forward(df.repartition(5), "f", "i", F.col("m"), value, "o", block)
        assert {r.i: r.o for r in got.collect()} == want


def test_a_marker_may_carry_a_null(spark):
    df = spark.createDataFrame([(1, True, "a"), (2, True, None), (3, False, "x")], "i long, m boolean, v string")
    out = order.carry_forward(df.withColumn("f", F.lit(1)), "f", "i", F.col("m"), F.col("v"), "o", 1)
    assert [r.o for r in out.orderBy("i").collect()] == ["a", None, None]


def test_limit_records(spark):
    df = spark.range(100).withColumn("f", F.col("id") % 3)
    assert order.limit_records(df, "f", "id", -1).count() == 100
    got = order.limit_records(df, "f", "id", 2).orderBy("id").collect()
    assert [r.id for r in got] == [0, 1, 2, 3, 4, 5]
    assert order.limit_records(df, "f", "id", 0).count() == 0


def test_fields(spark):
    df = spark.createDataFrame([("u", "é")], "uri string, text string")
    assert project.extract_field(df).first()[0] == "u"
    assert project.extract_field(df, "text", True).first()[0] == "w6k="
    assert project.extract_field(df, "offset").first()[0] == ""


def test_counters_on_nothing(spark):
    df = spark.createDataFrame([], "n long, f boolean")
    row = stats.run_counters(df, F.col("f"), F.col("f"), F.col("f"), F.col("n")).first()
    assert set(row) == {0}


def test_broadcast_is_size_checked(spark):
    assert broadcast_if_small(spark.range(11), 10) is None
    assert broadcast_if_small(spark.range(10), 10) is not None


def test_only_small_input_is_spread(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert session.spread(pages).rdd.getNumPartitions() == 8
    monkeypatch.setattr(session, "SPREAD_BYTES", 10)
    assert session.spread(pages) is pages


def test_bloom_filter(spark):
    seen = spark.range(20_000).selectExpr("cast(sha2(cast(id as string), 256) as string) AS k").unionByName(spark.createDataFrame([(None,)], "k string"))
    for blocks in (16, 1024):
        bloom = bloom_of(seen, "k", blocks)
        assert bloom.count() <= blocks
        old = maybe_seen(seen, "k", bloom, blocks)
        assert old.filter("not _maybe and k is not null").count() == 0 and old.filter("k is null and _maybe").count() == 0
        fresh = spark.range(20_000, 60_000).selectExpr("sha2(cast(id as string), 256) AS k")
        passed = maybe_seen(fresh, "k", bloom, blocks).filter("_maybe").count() / 40_000
        # 20 keys a block hardly ever say maybe; a filter that is too small says so of everything
        assert passed < 0.001 if blocks == 1024 else passed > 0.9
    parts = [bloom_of(seen.filter(f"hash(k) % 2 = {i}" if i == 0 else "hash(k) % 2 <> 0"), "k", 64) for i in (0, 1)]
    assert unite(parts[0].union(parts[1])).exceptAll(bloom_of(seen, "k", 64)).count() == 0
    assert maybe_seen(seen, "k", bloom_of(seen.limit(0), "k")).filter("_maybe").count() == 0


@pytest.mark.parametrize("blocks", [1, 4, 4096])
def test_bloom_filter_changes_no_row(spark, blocks):
    rows = [(i, f"k{i % 300}" if i % 11 else None) for i in range(1000)] + [(2000 + i, "k7") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string")
    seen = spark.createDataFrame([(f"k{i}",) for i in range(0, 300, 3)] + [("other",), (None,), ("k3",)], "k string")
    bloom = bloom_of(seen, "k", blocks)
    for plain, filtered in (
        (dedup.drop_seen(df, "k", seen), dedup.drop_seen(df, "k", seen, bloom, blocks)),
        (dedup.dedup_unseen(df, "k", ["id"], seen), dedup.dedup_unseen(df, "k", ["id"], seen, bloom, blocks)),
        (dedup.new_hashes(df, "k", seen), dedup.new_hashes(df, "k", seen, bloom, blocks)),
    ):
        assert plain.columns == filtered.columns
        assert sorted(map(str, plain.collect())) == sorted(map(str, filtered.collect()))


def test_new_rows_are_not_shuffled(spark, folder):
    """A run of new texts against many accepted keys: what the exact join still has to shuffle."""
    spark.range(200_000).selectExpr("sha2(cast(id as string), 256) AS k").write.parquet(f"{folder}/seen")
    spark.range(190_000, 240_000).selectExpr("id", "sha2(cast(id as string), 256) AS k").write.parquet(f"{folder}/new")
    seen, df = spark.read.parquet(f"{folder}/seen"), spark.read.parquet(f"{folder}/new")
    bloom_of(seen, "k", 1 << 14).write.parquet(f"{folder}/bloom")
    bloom = spark.read.parquet(f"{folder}/bloom")
    probed = maybe_seen(df, "k", bloom, 1 << 14)
    assert 10_000 <= probed.filter("_maybe").count() < 10_100  # of 50,000 rows a fifth is shuffled, and few for nothing
    out = dedup.drop_seen(df, "k", seen, bloom, 1 << 14)
    assert out.count() == 40_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    fresh, checked = plan.split("SortMergeJoin")[0], plan.split("SortMergeJoin")[1] if "SortMergeJoin" in plan else ""
    assert "Exchange hashpartitioning" not in fresh and "NOT coalesce" in fresh
    keys = dedup.new_hashes(df, "k", seen, bloom, 1 << 14)
    assert keys.count() == 40_000
    # the accepted keys are scanned and meet a broadcast of the unsure ones
    scan = keys._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in scan
