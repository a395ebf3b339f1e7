import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dropgate.llm import quality, toxicity, words
from dropgate.llm.common import held_out
from llm.conftest import SF

BIG = "/root/testdata/sf0.1"


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    length = np.array([3, 1, 5, 2])
    start = np.cumsum(length) - length
    good, step = rng.normal(size=11), rng.normal(size=(2, 2))
    marginal, z, pairs = quality.forward_backward(good, start, length, step)
    want, all_pairs = np.zeros(11), np.zeros((2, 2))
    for s, n, logz in zip(start, length, z):
        total, mass, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(good[s + t] * y[t] for t in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])))
            total += w
            mass += w * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[a, b] += w
        want[s:s + n] = mass / total
        all_pairs += moves / total
        assert np.isclose(logz, np.log(total))
    assert np.allclose(marginal, want) and np.allclose(pairs, all_pairs)


def test_lines_and_neighbours():
    text = "Good line here.\n\n  \nBAD!! BAD!! BAD!!\nGood line here."
    (p,) = words.pieces(pa.array([text.encode(), b"", b"alone"], pa.binary()))
    x, size, owner = quality.line_features(p)
    assert owner.tolist() == [0, 0, 0, 2]
    assert size.tolist() == [13.0, 15.0, 13.0, 5.0]
    assert x[:, 4].tolist() == [0, 0, 1, 0]  # the repeated line
    wide = quality.with_neighbours(x, owner)
    d = x.shape[1]
    assert (wide[1, d:2 * d] == x[0]).all() and (wide[1, 2 * d:] == x[2]).all() and not wide[3, d:].any()


def test_machine_is_pairwise():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    feature, owner = np.array([0, 2, 5, 1]), np.array([0, 0, 0, 2])
    want = [0.3 + m.w[[0, 2, 5]].sum() + sum(m.v[i] @ m.v[j] for i, j in ((0, 2), (0, 5), (2, 5))), 0.3, 0.3 + m.w[1]]
    assert np.allclose(m.score(3, feature, owner), 1 / (1 + np.exp(-np.array(want))))


def test_machine_learns_a_pair_that_weights_cannot():
    """Exclusive-or of two terms: no additive weights separate it."""
    rng = np.random.default_rng(3)
    held = rng.integers(0, 2, (2000, 2)).astype(bool)
    y = (held[:, 0] ^ held[:, 1]).astype(float)
    owner, feature = np.nonzero(held)
    got = toxicity.fit(np.arange(2), feature, owner, y, epochs=40).score(len(y), feature, owner)
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.98


@pytest.mark.parametrize("op,label,modulus,remainder", [(toxicity.op2, "toxic", 3, 1), (quality.op4, "quality", 4, 2)])
def test_held_out_accuracy(spark, op, label, modulus, remainder):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    got = op(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels.select("doc_id", label), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r[label] for r in rows)
    assert right / len(rows) >= 0.97
    ids = docs.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("h")).filter("h").limit(3).collect()
    import zlib
    assert all(zlib.crc32(str(r.doc_id).encode()) % modulus == remainder for r in ids)


@pytest.mark.parametrize("op,label", [(toxicity.op2, "toxic"), (quality.op4, "quality")])
def test_odd_rows(spark, odd_docs, odd_rows, no_docs, op, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = spark.createDataFrame([(i, int(i % 2 == 0), int(i % 2 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None)],
                                "doc_id long, quality int, toxic int")
    got = op(odd_docs, ids).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert op(no_docs, labels).count() == 0
    assert op(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert op(odd_docs, ids.filter("doc_id = 2")).count() == len(odd_rows)  # one label only


def test_labels_are_no_input(spark):
    """A document's score does not depend on its own label where it is held out."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id"), 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in toxicity.op2(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_training_admits_pairs_without_signal_of_their_own(spark):
    """The label is the exclusive-or of two common words among others; it is learned through train()."""
    rng = np.random.default_rng(8)
    others = [f"word{chr(97 + k)}{chr(97 + k % 7)}" for k in range(20)]
    rows, labels = [], []
    for k in range(3000):
        a, b = rng.integers(0, 2, 2)
        text = [w for w, h in (("alpha", a), ("omega", b)) if h] + list(rng.choice(others, 8))
        rows.append((k, " ".join(rng.permutation(text))))
        labels.append((k, int(a ^ b)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.op2(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(((r.score > 0.5) == (r.toxic == 1)) for r in got) / len(got) > 0.95


def test_pairs_counted_as_by_hand(spark):
    rows = spark.createDataFrame([(float(y), t) for y, t in [(1, [1, 2]), (0, [1]), (0, [2]), (1, []), (1, [1, 2]), (0, [1, 3])] * 30], "y double, terms array<int>")
    assert toxicity.uneven_pairs(rows, np.array([1, 2, 3]), 180, 90.0).tolist() == [1, 2]


def test_quality_learns_from_long_documents_only(spark):
    """Every labelled document has more lines than a stretch holds."""
    rng = np.random.default_rng(5)
    good = [" ".join(rng.choice(["clean", "plain", "words", "in", "lines", "of", "text"], 9)) + "." for _ in range(600)]
    bad = [" ".join(rng.choice(["#$%", "&&&", "BUY!!!", "***", "NOW!!!"], 9)) for _ in range(600)]
    rows = [(k, "\n".join(rng.choice(good if k % 2 else bad, 450))) for k in range(40)]
    labels = [(k, k % 2) for k in range(40)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.op4(docs, labels).join(labels, "doc_id").collect()
    assert all(r.predicted == r.quality for r in got)
