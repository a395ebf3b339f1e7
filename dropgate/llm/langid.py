"""Language of texts by a linear-chain conditional random field over words.

Each word of a text is labelled with a language. A word's potentials are the
sums of learned weights of its features: the word itself (lexicon), its first
and last one to four bytes (affixes) and its n-grams of two to four bytes; all
but the lexicon are hashed. Learned transitions couple neighbouring words, so
in code-switched text a word that looks alike in two languages takes the one
around it. Forward-backward gives each word's distribution over languages;
their mean, weighted by the words' lengths, is the text's distribution: its
highest entry is the prediction and its value the score.

A word is a run of letters: A-Z, a-z (case ignored) and what lies beyond
ASCII. The field is fitted on stretches of labelled texts: the ``TRAIN_DOCS``
documents of each language with the least hash of the id, cut into stretches
of ``SPAN`` words, of which the ``TRAIN_SPANS`` of each language with the least
hash are taken (the bound of the sample: long documents take part with some of
their stretches, none is left out for its length). Stretches of different
documents are laid end to end, so transitions learn to stay and to switch.
Scoring reads every text whole. Long texts are worked on in segments whose
transfer matrices are multiplied up, which is exact.

Defined results: a null text, or one without a letter, is ``und`` with score
0. Without any labelled text everything is. Repeated rows score alike. lang,
source and ids are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropgate.llm import words as W
from dropgate.llm.common import held_out
from dropgate.llm.toxicity import _LETTERS

TRAIN_DOCS = 3000     # labelled documents of a language in the sample, at most
TRAIN_SPANS = 4000    # stretches of a language in the sample, at most
SPAN = 24             # words of a stretch, at most
SPANS_IN_ROW = 4      # stretches laid end to end in training
BUCKETS = 1 << 17     # of the feature hash
ROUNDS = 40
SEGMENT = 512         # words of a long text that advance together
UNKNOWN = "und"

_KINDS = ([("whole", 0)] + [("first", k) for k in (1, 2, 3, 4)] + [("last", k) for k in (1, 2, 3, 4)] + [("gram", k) for k in (2, 3, 4)])


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets): the hashed features of the words data[start:end], word by word; ``whole``: hashes of the words."""
    n, size = len(start), len(data)
    length = end - start
    step = np.zeros((5, size + 4), W.U64)  # hash of the k bytes from each place on
    padded = np.append(data, np.zeros(4, np.uint8)).astype(W.U64)
    for k in range(1, 5):
        step[k, :size] = W.mix(step[k - 1, :size] * W.U64(0x100000001B3) + padded[k - 1: k - 1 + size] + W.U64(k))
    own, buckets = [], []
    for salt, (kind, k) in enumerate(_KINDS):
        if kind == "whole":
            at, h = np.arange(n), whole
        elif kind == "gram":
            many = np.maximum(length - k + 1, 0)
            at = np.repeat(np.arange(n), many)
            h = step[k, np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())]
        else:
            at = np.flatnonzero(length >= k)
            h = step[k, start[at] if kind == "first" else end[at] - k]
        own.append(at)
        buckets.append((W.mix(h + W.U64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % W.U64(BUCKETS)).astype(np.int32))
    own, buckets = np.concatenate(own), np.concatenate(buckets)
    order = np.argsort(own, kind="stable")
    return buckets[order], np.searchsorted(own[order], np.arange(n + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of rows offsets[i]..offsets[i+1]; every word has a feature."""
    return np.add.reduceat(values, offsets[:-1], 0) if len(offsets) > 1 else np.zeros((0, values.shape[1]), values.dtype)


def _sweep(e: np.ndarray, start: np.ndarray, length: np.ndarray, move: np.ndarray, state: np.ndarray) -> np.ndarray:
    """State after each word, scaled to sum 1; sequences advance together, longest first.

    ``e``: words x L potentials; ``state``: before each sequence's first word,
    already moved: a vector, or a matrix whose rows are L states at once.
    """
    order = np.argsort(-length, kind="stable")
    start, length, state = start[order], length[order], state[order]
    out = np.zeros((len(e), *state.shape[1:]))
    top = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, top + 1), side="right")
    for t in range(top):
        at = start[: active[t]] + t
        state = state[: active[t]] @ move if t else state
        state = state * (e[at] if state.ndim == 2 else e[at][:, None, :])
        state = state / state.sum(tuple(range(1, state.ndim)), keepdims=True)
        out[at] = state
    return out


def messages(e: np.ndarray, start: np.ndarray, length: np.ndarray, move: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Forward vector of each word, its potential included, scaled to sum 1."""
    n, many = e.shape[1], -(-length // segment)
    if (many <= 1).all():
        return _sweep(e, start, length, move, np.ones((len(start), n)))
    own = np.repeat(np.arange(len(start)), many)
    k = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
    begin, size = start[own] + k * segment, np.minimum(length[own] - k * segment, segment)
    # where another segment follows: the state after it from each state before it
    inner = np.flatnonzero(k + 1 < many[own])
    across = _sweep(e, begin[inner], size[inner], move, np.tile(np.eye(n), (len(inner), 1, 1)))[begin[inner] + segment - 1]
    enter = np.ones((len(own), n))
    for x, matrix in zip(inner, across, strict=True):
        v = enter[x] @ matrix @ move
        enter[x + 1] = v / v.sum()
    return _sweep(e, begin, size, move, enter)


def forward_backward(scores: np.ndarray, start: np.ndarray, length: np.ndarray, step: np.ndarray, segment: int = SEGMENT):
    """(marginals, forward, backward, move) of sequences of words with log potentials ``scores``.

    Both message arrays include the word's own potential.
    """
    e, move = np.exp(np.maximum(scores - scores.max(1, keepdims=True), -40.0)), np.exp(step - step.max())
    ahead = messages(e, start, length, move, segment)
    back = messages(e[::-1], (len(e) - start - length)[::-1], length[::-1], move.T, segment)[::-1]
    both = ahead * back / e
    return both / both.sum(1, keepdims=True), ahead, back, move


@dataclass
class Field:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x L
    step: np.ndarray     # L x L log transitions

    def word_labels(self, p: W.Words) -> np.ndarray:
        """Distribution over the languages of each word of a piece."""
        whole, first, same = np.unique(p.hashes(), return_index=True, return_inverse=True)
        buckets, offsets = word_features(p.data, p.start[first], p.end[first], whole)
        scores = _sums(self.weights[buckets], offsets).astype(float)[same]
        length = p.count()
        some = np.flatnonzero(length)
        return forward_backward(scores, p.first[some], length[some], self.step)[0]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index of the predicted language, its share) per text; -1 and 0 where there is no word."""
        best, share = np.full(len(texts), -1), np.zeros(len(texts))
        for p in W.pieces(texts, _LETTERS):
            if not len(p.start) or not self.langs:
                continue
            size = (p.end - p.start).astype(float)
            some = np.flatnonzero(p.count())
            mean = np.add.reduceat(self.word_labels(p) * size[:, None], p.first[some], 0)
            mean /= np.add.reduceat(size, p.first[some])[:, None]
            best[p.lo + some] = mean.argmax(1)
            share[p.lo + some] = np.clip(mean.max(1), 0, 1)
        return best, share


def fit(langs: list[str], data: np.ndarray, start: np.ndarray, end: np.ndarray, label: np.ndarray, first: np.ndarray,
        length: np.ndarray, rounds: int = ROUNDS, rate: float = 0.15, ridge: float = 2e-6) -> Field:
    """Maximum conditional likelihood of the words' labels, by Adam on whole-sample gradients.

    Words are data[start:end]; sequences are runs of ``length`` words from ``first``.
    """
    n, words = len(langs), W.Words(0, 1, data, np.array([0, len(data)]), start, end, np.array([0, len(start)]))
    whole, at, same = np.unique(words.hashes(), return_index=True, return_inverse=True)
    buckets, offsets = word_features(data, start[at], end[at], whole)
    seen, place = np.unique(buckets, return_inverse=True)
    many = np.diff(offsets)
    ends = np.zeros(len(start), bool)
    ends[first + length - 1] = True
    inner = np.flatnonzero(~ends)
    truth = np.eye(n)[label]
    pairs = np.zeros((n, n))
    np.add.at(pairs, (label[inner], label[inner + 1]), 1)
    theta = [np.zeros((len(seen), n), np.float32), np.zeros((n, n))]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for r in range(1, rounds + 1):
        scores = _sums(theta[0][place], offsets).astype(float)[same]
        marginal, ahead, back, move = forward_backward(scores, first, length, theta[1])
        joint = ahead[inner][:, :, None] * move * back[inner + 1][:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        off = (marginal - truth) / len(start)
        by_word = np.stack([np.bincount(same, off[:, k], len(at)) for k in range(n)], 1)
        spread = np.repeat(by_word, many, 0)
        g0 = np.stack([np.bincount(place, spread[:, k], len(seen)) for k in range(n)], 1) + ridge * theta[0]
        g1 = (joint.sum(0) - pairs) / len(start) + 1e-3 * theta[1]
        for t, g, a, b in zip(theta, (g0, g1), m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            t -= rate * (a / (1 - 0.9 ** r)) / (np.sqrt(b / (1 - 0.99 ** r)) + 1e-10)
    weights = np.zeros((BUCKETS, n), np.float32)
    weights[seen] = theta[0]
    return Field(langs, weights, theta[1])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, words (joined by blanks) and a hash of place of each stretch of the texts."""
    for b in batches:
        for p in W.pieces(b.column(2), _LETTERS):
            lang, ids = b.column(0).slice(p.lo, p.hi - p.lo), b.column(1).slice(p.lo, p.hi - p.lo).to_numpy().astype(W.U64)
            out, owner, place = [], [], []
            for k in range(p.hi - p.lo):
                for w in range(p.first[k], p.first[k + 1], SPAN):
                    last = min(w + SPAN, p.first[k + 1]) - 1
                    out.append(p.data[p.start[w]: p.end[last]].tobytes())
                    owner.append(k)
                    place.append(w - p.first[k])
            owner = np.array(owner, np.int64)
            order = W.mix(ids[owner] + np.array(place, W.U64) * W.U64(0x9E3779B97F4A7C15)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(owner)), pa.array(out, pa.binary()), pa.array(order)], names=["lang", "words", "place"])


def train(docs: DataFrame, modulus: int = 4, remainder: int = 2, train_docs: int = TRAIN_DOCS, train_spans: int = TRAIN_SPANS) -> Field:
    """A field fitted on texts whose language is known and whose id is not held out.

    Rows without an id take no part. Per language there is one row of the
    threshold table and the bounded sample of stretches.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    known = known.select("lang", F.xxhash64("doc_id").alias("h"), "text")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    bound = (known.select("lang", "h").distinct().withColumn("rank", rank).filter(F.col("rank") <= train_docs)
             .groupBy("lang").agg(F.max("h").alias("bound")))
    sample = known.join(F.broadcast(bound), "lang").filter("h <= bound").select("lang", "h", F.col("text").cast("binary").alias("text"))
    spans = sample.mapInArrow(_spans, "lang string, words binary, place long")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "words"))
    got = spans.withColumn("rank", rank).filter(F.col("rank") <= train_spans).orderBy("lang", "place", "words").toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    if not langs:
        return Field([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)))
    rng = np.random.default_rng(11)
    order = rng.permutation(len(got))
    rows = got.take(pa.array(order))
    (p,) = _whole(rows["words"])
    label = np.repeat(np.array([langs.index(x) for x in rows["lang"].to_pylist()]), p.count())
    first = p.first[:-1][::SPANS_IN_ROW]
    return fit(langs, p.data, p.start, p.end, label, first, np.diff(np.append(first, len(p.start))))


def _whole(texts: pa.ChunkedArray) -> list[W.Words]:
    """All texts of a bounded sample as one piece."""
    parts = list(W.pieces(texts))
    shift = np.cumsum([0, *(len(p.data) for p in parts)])
    words = np.cumsum([0, *(len(p.start) for p in parts)])
    return [W.Words(0, len(texts), np.concatenate([p.data for p in parts]), np.zeros(0),
                    np.concatenate([p.start + s for p, s in zip(parts, shift, strict=False)]),
                    np.concatenate([p.end + s for p, s in zip(parts, shift, strict=False)]),
                    np.concatenate([*(p.first[:-1] + w for p, w in zip(parts, words, strict=False)), [words[-1]]]))]


def predicted(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)  # BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        names = pa.array([*field.langs, UNKNOWN])
        for b in batches:
            best, share = field.of(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), names.take(pa.array(best % len(names))), pa.array(share)], names=[key, "lang_pred", "score"])

    # a text without a letter counts as empty
    letters = F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).otherwise(F.lit(""))
    rows = docs.select(F.col(key).alias(key), letters.cast("binary").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def op12(docs: DataFrame) -> DataFrame:
    out = predicted(docs, train(docs))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
