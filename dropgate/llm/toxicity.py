"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: words (letters only, lower-cased)
and the first letters of longer words. The machine scores

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms a document holds, so a pair of terms (an insult with the
mention of a group) has a weight of its own even where neither term alone is
toxic. It is fitted on at most ``TRAIN_DOCS`` labelled documents (the bound of
the sample) over at most ``FEATURES`` hashed terms: those that are most unevenly
spread between the labels, and the members of pairs that are, beyond what
either member is alone. Pairs are counted among the ``PAIR_TERMS`` terms that
most documents of the sample hold. All counts are taken over the whole sample,
in tasks.
Scoring reads every text whole and holds only the fitted terms.

Defined results: null and empty texts hold no term and score sigmoid(w0); so
does everything, at 0.5, if there are no labels. Repeated rows score alike.
Labels, lang, source and ids are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm import words as W
from dropgate.llm.common import held_out, labelled, written

TRAIN_DOCS = 40_000   # labelled documents of the training sample, at most
BUCKETS = 1 << 20     # of the term hash
FEATURES = 4096       # hashed terms that are fitted, at most
LEAST_CHI2 = 20.0     # of a fitted term's spread between the labels
LEAST_DOCS = 3        # that hold a fitted term
PAIR_TERMS = 512      # most frequent terms whose pairs are counted
PAIR_TASKS = 16       # that count pairs (each gives two matrices of PAIR_TERMS squared)
PREFIX = 6
FACTORS = 8
EPOCHS = 20

# letters and what lies beyond ASCII stay, the rest separates words
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
for _c in range(ord("a"), ord("z") + 1):
    _LETTERS[_c] = _LETTERS[_c - 32] = _c


def terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, buckets, owners): the hashed terms of the texts lo..hi-1, with repeats."""
    for p in W.pieces(texts, _LETTERS):
        doc = p.doc()
        longer = p.end - p.start > PREFIX
        h = np.concatenate([p.hashes(), p.hashes(prefix=PREFIX)[longer] ^ W.U64(0x51ED)])
        yield p.lo, p.hi, (W.mix(h) % W.U64(BUCKETS)).astype(np.int64), np.concatenate([doc, doc[longer]])


@dataclass
class Machine:
    buckets: np.ndarray  # sorted buckets of the fitted terms
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, n: int, feature: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Scores of n documents from (feature, owner) pairs without repeats, sorted by owner."""
        z = self.w0 + np.bincount(owner, self.w[feature], n)
        s = np.zeros((n, self.v.shape[1]))
        np.add.at(s, owner, self.v[feature])
        z += 0.5 * ((s * s).sum(1) - np.bincount(owner, (self.v[feature] ** 2).sum(1), n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def of(self, texts: pa.Array) -> np.ndarray:
        table = np.full(BUCKETS, -1, np.int32)
        table[self.buckets] = np.arange(len(self.buckets))
        out = np.zeros(len(texts))
        for lo, hi, bucket, owner in terms(texts):
            feature = table[bucket]
            hit = feature >= 0
            pair = np.unique(owner[hit] * len(table) + feature[hit])
            out[lo:hi] = self.score(hi - lo, pair % len(table), pair // len(table))
        return out


def fit(buckets: np.ndarray, feature: np.ndarray, owner: np.ndarray, y: np.ndarray, factors: int = FACTORS,
        epochs: int = EPOCHS, batch: int = 512, rate: float = 0.05, ridge: float = 1e-4, seed: int = 7) -> Machine:
    """Adam on the logistic loss, in mini-batches; (feature, owner) pairs sorted by owner."""
    rng, m, n = np.random.default_rng(seed), len(buckets), len(y)
    share = (y.sum() + 0.5) / (n + 1)
    theta = [np.array([np.log(share / (1 - share))]), np.zeros(m), rng.normal(0, 0.05, (m, factors))]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    cut, step = np.searchsorted(owner, np.arange(n + 1)), 0
    for _ in range(epochs if m else 0):
        for some in np.array_split(rng.permutation(n), max(1, n // batch)):
            count = (cut[some + 1] - cut[some])
            own = np.repeat(np.arange(len(some)), count)
            f = feature[np.repeat(cut[some] - np.cumsum(count) + count, count) + np.arange(count.sum())]
            machine = Machine(buckets, theta[0][0], theta[1], theta[2])
            s = np.zeros((len(some), factors))
            np.add.at(s, own, theta[2][f])
            g = (machine.score(len(some), f, own) - y[some]) / len(some)
            dv = np.zeros_like(theta[2])
            np.add.at(dv, f, g[own, None] * (s[own] - theta[2][f]))
            grads = [np.array([g.sum()]), np.bincount(f, g[own], m) + ridge * theta[1], dv + ridge * theta[2]]
            step += 1
            for t, d, a, b in zip(theta, grads, first, second, strict=True):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                t -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Machine(buckets, float(theta[0][0]), theta[1], theta[2])


def uneven_pairs(rows: DataFrame, frequent: np.ndarray, n: int, positive: float) -> np.ndarray:
    """Those of the ``frequent`` buckets that are members of a pair whose spread between the labels
    is larger than either member's by ``LEAST_CHI2``."""
    m = len(frequent)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(BUCKETS, -1, np.int32)
        table[frequent] = np.arange(m)
        total = np.zeros((2, m, m))
        for b in batches:
            held = np.zeros((len(b), m), np.float32)
            lists = b.column(1)
            owner = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
            place = table[lists.flatten().to_numpy()]
            held[owner[place >= 0], place[place >= 0]] = 1
            total[0] += held.T @ held
            total[1] += held.T @ (held * b.column(0).to_numpy()[:, None].astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = rows.select("y", "terms").coalesce(PAIR_TASKS).mapInArrow(counted, "total binary").toArrow()["total"].to_pylist()
    both, toxic = sum(np.frombuffer(p).reshape(2, m, m) for p in parts)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = n * (toxic * n - both * positive) ** 2 / (both * (n - both) * positive * (n - positive))
    chi2 = np.where((both >= LEAST_DOCS) & (both < n), chi2, 0)
    alone = np.diag(chi2)
    gain = chi2 - np.maximum(alone[:, None], alone[None, :])
    return frequent[(gain >= LEAST_CHI2).any(1)]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, remainder: int = 1,
          train_docs: int = TRAIN_DOCS, features: int = FEATURES) -> Machine:
    """A machine fitted on labelled documents that are not held out."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, bucket, owner in terms(b.column(1)):
                pair = np.unique(owner * BUCKETS + bucket)
                cut = np.searchsorted(pair, np.arange(hi - lo + 1) * BUCKETS)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array((pair % BUCKETS).astype(np.int32)))],
                    names=["y", "terms"])

    sample = labelled(docs, labels, label, modulus, remainder, train_docs)
    rows = written(sample.select("y", F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")).alias("text"))
                   .mapInArrow(hashed, "y double, terms array<int>"), "toxic-terms")
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or not positive or positive == n:
        return Machine(np.zeros(0, np.int64), 0.0 if not n else (20.0 if positive else -20.0), np.zeros(0), np.zeros((0, FACTORS)))
    per = rows.select("y", F.explode("terms").alias("bucket")).groupBy("bucket").agg(F.sum("y").alias("a"), F.count("*").alias("c"))
    # chi-square of the 2 x 2 table of holding the term and the label
    a, c = F.col("a"), F.col("c").cast("double")
    chi2 = n * F.pow(a * n - c * positive, 2) / (c * (n - c) * positive * (n - positive))
    best = (per.filter((c >= LEAST_DOCS) & (c < n)).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
            .orderBy(F.desc("chi2"), "bucket").limit(features).select("bucket"))
    frequent = per.filter(c < n).orderBy(F.desc("c"), "bucket").limit(PAIR_TERMS).select("bucket").collect()
    paired = uneven_pairs(rows, np.array([r[0] for r in frequent], np.int64), n, positive) if frequent else []
    alone = [r[0] for r in best.collect()]
    buckets = np.unique(np.array([*paired, *alone][:features], np.int64))

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(BUCKETS, -1, np.int32)
        table[buckets] = np.arange(len(buckets))
        for b in batches:
            got = [(f := table[x.values.to_numpy()])[f >= 0] for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32()))], names=["y", "features"])

    # at most train_docs rows of at most `features` numbers
    got = rows.mapInArrow(selected, "y double, features array<int>").toArrow()
    lists = got["features"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return fit(buckets, lists.flatten().to_numpy().astype(np.int64), owner, got["y"].to_numpy())


def scored(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(machine.of(b.column(1)))], names=[key, "score"])

    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, score double")


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
