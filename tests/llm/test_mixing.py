import re

import numpy as np
from pyspark.sql import functions as F

from dropgate.llm import mixing
from llm.conftest import shape


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(rows):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = sum(weight[s] for s in order if s not in capped)
        level = (total - sum(3 * sizes[s] for s in capped)) / free if free else 0
        new = {s for s in order if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not new:
            return sizes, {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= new


def check(got, rows):
    sizes, want = targets(rows)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1, s


def test_op1_matches_targets_and_reruns_agree(odd_docs, odd_rows):
    got = mixing.op1(odd_docs)
    check(got.collect(), odd_rows)
    assert shape(got) == shape(mixing.op1(odd_docs.repartition(5)))


def test_many_small_blocks(odd_docs, odd_rows):
    sizes = odd_docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("row_hash"))
    out = mixing.mix(sizes, block_words=300, block_docs=4, shard_blocks=3)
    out = out.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
    check(out.collect(), odd_rows)
    # a document is drawn once per epoch
    assert out.filter(F.size("draws") != F.size(F.array_distinct(F.transform("draws", lambda d: d["epoch"])))).count() == 0


def test_ranges_of_places_give_the_same_mix(odd_docs):
    sizes = odd_docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("row_hash"))
    one, many = (mixing.mix(sizes, block_words=200, block_docs=2, shard_blocks=3, range_blocks=n) for n in (1 << 16, 3))
    assert one.columns == many.columns and shape(one) == shape(many)


def test_tree_splits_exactly():
    quota = np.array([1000, 3, 0, 477, 20])
    total = np.zeros(5, int)
    for lo in range(0, 37, 10):
        for shard, start, count in mixing._subtree(lo, min(lo + 10, 37), quota, 37, 1):
            assert (start == total).all()  # disjoint and in order
            total += count
            assert count.sum() in (1500 // 37, 1500 // 37 + 1)
    assert (total == quota).all()


def test_mixture_has_the_documents(odd_docs, odd_rows):
    out = mixing.mixture(odd_docs)
    assert out.columns == odd_docs.columns
    _, want = targets(odd_rows)
    words = {}
    for r in out.collect():
        words[r.source] = words.get(r.source, 0) + size(r.text)
        assert any(t is not None and t.lstrip().startswith(r.text.strip()) for i, t, s in odd_rows if i == r.doc_id)
    assert all(abs(words.get(s, 0) - t) <= 1 for s, t in want.items())


def test_cut_text(spark):
    df = spark.createDataFrame([("  a b\n c d ", n) for n in range(1, 5)], "t string, n int")
    assert [r[0] for r in df.select(mixing.cut_text(F.col("t"), F.col("n"))).collect()] == ["a", "a b", "a b\n c", "a b\n c d"]


def test_empty(no_docs):
    assert mixing.op1(no_docs).count() == 0
    assert mixing.mixture(no_docs).count() == 0


def test_no_words(odd_docs):
    got = mixing.op1(odd_docs.filter("text IS NULL OR text = ''")).collect()
    assert got and all(r.taken == 0 and r.target == 0 for r in got)


def test_draws_are_the_trees_split(spark, odd_docs):
    """What op1 returns shows the shards: equal in blocks up to one, all words of a document's draws taken."""
    got = mixing.op1(odd_docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "source", "draws"]
    rows = got.collect()
    assert all(sum(d.words for d in r.draws) == r.taken and len({d.epoch for d in r.draws}) == len(r.draws) for r in rows)
    assert any(r.draws for r in rows) and all(d.shard >= 0 for r in rows for d in r.draws)
