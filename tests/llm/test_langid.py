"""Language ID: message passing against enumeration, held-out accuracy, code-switched text, odd input."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dropgate.llm import langid, words as W
from dropgate.llm.common import held_out
from dropgate.llm.toxicity import _LETTERS
from llm.conftest import shape

COLUMNS = ["doc_id", "held_out", "lang_pred", "score"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def field(docs):
    return langid.train(docs)


def test_messages_against_enumeration():
    rng = np.random.default_rng(1)
    length = np.array([1, 5, 3, 6])
    start = np.cumsum(length) - length
    scores, step = rng.normal(0, 2, (length.sum(), 3)), rng.normal(0, 1, (3, 3))
    for segment in (2, 3, 512):
        got = langid.forward_backward(scores, start, length, step, segment)[0]
        for s, n in zip(start, length, strict=True):
            want = np.zeros((n, 3))
            for path in itertools.product(range(3), repeat=int(n)):
                weight = np.exp(sum(scores[s + t, k] for t, k in enumerate(path)) + sum(step[a, b] for a, b in itertools.pairwise(path)))
                for t, k in enumerate(path):
                    want[t, k] += weight
            assert np.allclose(got[s: s + n], want / want.sum(1, keepdims=True), atol=1e-9)


def test_segments_are_exact():
    rng = np.random.default_rng(2)
    length = np.array([5000, 1, 512, 513, 1024])
    start = np.cumsum(length) - length
    scores, step = rng.normal(0, 3, (length.sum(), 4)), rng.normal(0, 1, (4, 4))
    one = langid.forward_backward(scores, start, length, step, 1 << 20)[0]
    assert np.allclose(langid.forward_backward(scores, start, length, step, 64)[0], one, atol=1e-9)


def test_features_depend_on_the_word_alone():
    (p,) = W.pieces(pa.array(["Straße strasse a", "the straße é"]), _LETTERS)
    buckets, at = langid.word_features(p.data, p.start, p.end, p.hashes())
    of = [sorted(buckets[at[i]: at[i + 1]].tolist()) for i in range(len(p.start))]
    assert of[0] == of[4] and of[0] != of[1] and all(of)


def test_gradient_fits_what_it_sees():
    """Words of two languages apart; transitions prefer to stay."""
    rng = random.Random(4)
    spans = [(k % 2, " ".join(rng.choice(("una", "dos", "tres") if k % 2 else ("one", "two", "three")) for _ in range(10))) for k in range(60)]
    (p,) = W.pieces(pa.array([t for _, t in spans]), _LETTERS)
    label = np.repeat([y for y, _ in spans], p.count())
    first = p.first[:-1][::2]
    field = langid.fit(["a", "b"], p.data, p.start, p.end, label, first, np.diff(np.append(first, len(p.start))))
    best, share = field.of(pa.array(["one two", "dos una tres", "", "dos two two two"]))
    assert best.tolist() == [0, 1, -1, 0] and share[2] == 0 and (share[:2] > 0.9).all()
    assert field.step[0, 0] > field.step[0, 1] and field.step[1, 1] > field.step[1, 0]


def test_held_out_accuracy(docs, field):
    out = langid.predicted(docs, field).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out(F.col("doc_id"), 4, 2))
    n, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 150 and right / n >= 0.98


def test_learned_from_the_right_rows(spark, docs, field):
    """Labels of held-out rows, and rows without an id, change nothing."""
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id"), 4, 2), F.lit("xx")).otherwise(F.col("lang")))
    other = other.unionByName(spark.createDataFrame([(None, "noise words here", "yy", "s", 3)], docs.schema))
    again = langid.train(other)
    assert again.langs == field.langs and np.array_equal(again.weights, field.weights) and np.array_equal(again.step, field.step)


def test_code_switched_words(docs, field):
    """In a text of two languages most words get the language around them."""
    texts = {r.lang: r.text for r in docs.filter("n_chars between 1500 and 6000").orderBy("doc_id").limit(200).collect()}
    en, de = (" ".join(texts[k].split()[:60]) for k in ("en", "de"))
    (p,) = W.pieces(pa.array([f"{en} {de}"]), _LETTERS)
    labels = [field.langs[k] for k in field.word_labels(p).argmax(1)]
    middle = len(W_words(en))
    assert labels[:middle].count("en") >= 0.9 * middle and labels[middle:].count("de") >= 0.9 * (len(labels) - middle)


def W_words(text):
    return [w for p in W.pieces(pa.array([text]), _LETTERS) for w in p.start]


def test_odd_rows(spark, odd_docs, odd_rows):
    out = langid.op12(odd_docs)
    assert out.columns == COLUMNS
    rows = shape(out)
    assert len(rows) == len(odd_rows)
    by = {r[0]: r for r in rows}
    assert by[100][2:] == ("und", 0.0) and by[101][2:] == ("und", 0.0) and by[102][2:] == ("und", 0.0)
    assert by[80][2] == "en" and 0 <= by[80][3] <= 1
    assert len({r for r in rows if r[0] == 90}) == 1


def test_texts_without_letters(spark, docs, field):
    rows = [(1, "123 !? —"), (2, "日本語"), (3, "1 a 2"), (4, "é"), (5, "🙂 🙂"), (6, None)]
    got = {r[0]: r for r in langid.predicted(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    assert [got[k][1] == "und" for k in range(1, 7)] == [True, False, False, False, True, True]
    assert all((got[k][2] == 0) == (got[k][1] == "und") for k in got)


def test_nothing_to_learn_from(spark, no_docs):
    assert langid.op12(no_docs).collect() == []
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.op12(docs).collect()} == {"und"}


def test_long_texts_take_part_in_training(spark):
    """A corpus of long texts only: their stretches are learned from."""
    rng = random.Random(6)
    word = {"aa": ["koto", "mira", "sento", "lavu"], "bb": ["strix", "plumb", "grond", "fjord"]}
    rows = [(k, " ".join(rng.choice(word[x]) for _ in range(30_000)), x) for k, x in enumerate(["aa", "bb"] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang_pred) for r in langid.op12(docs).collect()} == {(k, x) for k, _, x in rows}
