"""Bit filters of keys, and the bitmap of a snapshot's known ids."""

import random

import pytest
from pyspark.sql import functions as F

from dropgate.operators import checks, membership, snapshot
from dropgate.sources.catalog import Catalog, TableSpec


def test_filter_keeps_every_row_that_matches_and_few_others(spark):
    keys = spark.range(0, 4000).select((F.col("id") * 7919).alias("k"))
    side = spark.range(0, 400_000).select(F.col("id").alias("k"), F.lit("x").alias("`odd`.name"))
    kept = membership.reduced(side, ["k"], keys, ["k"])
    assert kept.columns == side.columns
    n, hits = kept.count(), side.join(keys, "k").count()
    assert kept.join(keys, "k").count() == hits and n - hits < 0.1 * side.count()


def test_filter_of_nothing_nulls_and_unlike_types(spark):
    side = spark.createDataFrame([(1, "a"), (None, "b"), (-5, None)], "k int, s string")
    assert membership.reduced(side, ["k"], spark.createDataFrame([], "k long"), ["k"]).count() == 0
    long_keys = spark.createDataFrame([(-5,), (None,), (1,)], "k long")
    assert sorted(r.k for r in membership.reduced(side, ["k"], long_keys, ["k"]).collect()) == [-5, 1]
    text = spark.createDataFrame([("1",)], "k string")       # compared as numbers by the join: no filter
    assert membership.reduced(side, ["k"], text, ["k"]).count() == 3
    assert membership.reduced(side, ["k"], long_keys, ["k"], max_bits=1).count() == 3   # more keys than bits


@pytest.mark.parametrize("kind", ["long", "string", "int", "double", "decimal(10,2)"])
def test_missing_ids_are_the_same_with_and_without_the_filter(spark, kind):
    rng = random.Random(3)
    ids = spark.createDataFrame([(rng.randrange(300),) for _ in range(200)] + [(None,)], "i long").select(F.col("i").cast(kind).alias("i"))
    master = spark.createDataFrame([(rng.randrange(5000),) for _ in range(3000)] + [(None,)], "m long").select(F.col("m").cast(kind).alias("m"))
    small, large = (sorted(r[0] for r in checks.missing_ids(ids, "i", master, "m", max_broadcast_rows=n).collect()) for n in (10**6, 0))
    assert small == large and small
    right = master.select(F.col("m").alias("i"))
    a, b = (checks.key_overlap(ids, right, ["i"], max_broadcast_rows=n).collect() for n in (10**6, 0))
    assert a == b


def test_the_filter_is_in_the_plan_before_the_shuffle(spark):
    ids, master = spark.range(100).select(F.col("id").alias("i")), spark.range(10**6).select(F.col("id").alias("m"))
    plan = checks.missing_ids(ids, "i", master, "m", max_broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan


@pytest.mark.parametrize("published", [False, True])
def test_compacted_snapshot_counts_like_a_set(spark, tmp_root, published):
    cat = Catalog(spark, {"ids": TableSpec(path=f"{tmp_root}/ids", versioned=True, published=published)})
    rng, seen, sizes = random.Random(5), set(), []
    for run in range(12):
        ids = [rng.randrange(-3000, 3000) for _ in range(400)] + [None, -(2**63), 2**63 - 1 - run]
        got = snapshot.append_new_ids(cat, "ids", spark.createDataFrame([(i,) for i in ids], "id long"), "id", version=f"{run:03d}")
        new = {i for i in ids if i is not None} - seen
        seen |= new
        assert (got["n_new"], got["n_total"]) == (len(new), len(seen))
        state = snapshot.known(cat, "ids")
        sizes.append(len(state.rest_versions))
    assert max(sizes) <= snapshot.COMPACT_AFTER and state.lines is not None
    assert {r[0] for r in cat.read("ids").collect()} == seen and cat.read("ids").count() == len(seen)


def test_a_repeated_or_replaced_version_makes_the_bitmap_void(spark, tmp_root):
    cat = Catalog(spark, {"ids": TableSpec(path=f"{tmp_root}/ids", versioned=True)})
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    snapshot.append_new_ids(cat, "ids", frame(1, 2, 3), "id", version="a")
    snapshot.append_new_ids(cat, "ids", frame(3, 4), "id", version="b")
    assert snapshot.compact(cat, "ids") and not snapshot.compact(cat, "ids")
    assert snapshot.known(cat, "ids").rest is None
    again = snapshot.append_new_ids(cat, "ids", frame(4, 5), "id", version="b")
    assert (again["n_new"], again["n_total"]) == (2, 5)
    assert snapshot.known(cat, "ids").lines is None          # 'b' was replaced
    assert snapshot.append_new_ids(cat, "ids", frame(4, 9), "id", version="c") == {"table": "ids", "version": "c", "n_new": 1, "n_total": 6}


def test_only_lines_in_the_range_of_the_ids_are_asked_for(spark):
    lines = membership.lines_of(spark.range(0, 100_000), F.col("id"))
    ids = spark.createDataFrame([(5,), (99_999,), (100_000,), (-1,)], "id long")
    assert sorted(r[0] for r in snapshot.unknown(ids, "id", lines).collect()) == [-1, 100_000]
    assert snapshot.unknown(ids.limit(0), "id", lines).count() == 0
