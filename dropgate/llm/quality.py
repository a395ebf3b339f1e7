"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. A line's potentials come from
its own features and those of the lines before and after it; transitions
couple neighbouring labels. Forward-backward gives each line's marginal of
being good; their mean, weighted by the lines' lengths, is calibrated to the
document's score.

Labels exist per document only, so in training every line of a document has
its label. The field is fitted on stretches of at most ``TRAIN_LINES`` lines of
at most ``TRAIN_DOCS`` labelled documents; the ``TRAIN_STRETCHES`` stretches with
the least hash are taken (the bound of the sample: a long document takes part
with some of its stretches, none is left out for its length). Scoring reads
every text whole.

Defined results: a null or empty text, or one without words, has no line and
scores 0. Without labels everything else scores 0.5. Repeated rows score
alike. Labels, lang, source and ids are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm import words as W
from dropgate.llm.common import held_out, labelled

TRAIN_DOCS = 12_000
TRAIN_LINES = 200
TRAIN_STRETCHES = 16_000
ROUNDS = 150

_LOWER, _UPPER, _DIGIT, _SYMBOL, _STOP, _SHOUT, _MARK, _HIGH = (np.zeros(256, bool) for _ in range(8))
_LOWER[ord("a"):ord("z") + 1] = True
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT[ord("0"):ord("9") + 1] = True
_SYMBOL[list(b"#*$%&|<>~^=+_{}[]\\@")] = True
_STOP[list(b".,;:?")] = True
_SHOUT[list(b"!")] = True
_MARK[list(b"'\"()-/")] = True
_HIGH[0x80:] = True
_CLASSES = (_LOWER, _UPPER, _DIGIT, _SYMBOL, _STOP, _SHOUT, _MARK, _HIGH)
_STEPS = (0.02, 0.1, 0.25, 0.5)


def line_features(p: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x d), lengths in words and text numbers of the lines with a word."""
    doc = p.doc()
    breaks = np.cumsum(p.data == 0x0A)
    line = breaks[p.start] if len(p.start) else np.zeros(0, np.int64)
    first = np.ones(len(line), bool)
    first[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros((0, 1)), np.zeros(0), np.zeros(0, np.int64)
    number = np.cumsum(first) - 1
    n = np.diff(np.append(at, len(line))).astype(float)
    size = np.add.reduceat(p.end - p.start, at).astype(float)
    last = np.append(at[1:], len(line)) - 1
    # bytes of a class in each line: running counts at its ends
    ratios = []
    for c in _CLASSES:
        run = np.concatenate([[0], np.cumsum(c[p.data])])
        ratios.append((run[p.end[last]] - run[p.start[at]]) / size)
    lower, upper, _, symbol, stop, shout, _, high = ratios
    h = p.hashes(lower=True)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & ~first[1:]
    order = np.lexsort((h, number))
    fresh = np.ones(len(h))
    fresh[order[1:]] = (h[order][1:] != h[order][:-1]) | (number[order][1:] != number[order][:-1])
    unique = np.add.reduceat(fresh, at) / n
    # lines equal to an earlier one of the text
    key = np.add.reduceat(W.mix(h + np.arange(len(h)).astype(W.U64) - at[number].astype(W.U64)), at)
    owner = doc[at]
    order = np.lexsort((np.arange(len(at)), key, owner))
    dup = np.zeros(len(at))
    dup[order[1:]] = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    ends_symbol = np.add.reduceat(_SYMBOL[p.data[p.end - 1]].astype(float), at) / n
    long_word = np.maximum.reduceat(p.end - p.start, at).astype(float)
    measured = [*ratios, unique, np.add.reduceat(again, at) / n, ends_symbol,
                upper / np.maximum(upper + lower + high, 1e-9), shout * size / n / 2, stop * size / n]
    columns = [np.ones(len(at)), np.log1p(n) / 5, np.log1p(size / n) / 3, np.log1p(long_word) / 5, dup, n < 4, n > 200, *measured]
    columns += [x > step for x in measured for step in _STEPS]
    return np.stack(columns, 1).astype(np.float32), size, owner


def with_neighbours(x: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after it (0 at a text's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = (owner[1:] == owner[:-1])[:, None]
    before[1:] = x[:-1] * same
    after[:-1] = x[1:] * same
    return np.concatenate([x, before, after], 1)


def forward_backward(good: np.ndarray, start: np.ndarray, length: np.ndarray, step: np.ndarray):
    """Marginals of label 1 per line, log partition per text and expected transitions (2 x 2).

    ``good``: log potential of label 1 against 0 of each line; texts are runs
    of ``length`` lines from ``start``. Texts advance together, longest first.
    """
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    top = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, top + 1), side="right")
    ahead, back = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    for t in range(top):
        at = start[: active[t]] + t
        if t:
            prior = ahead[at - 1]
            ahead[at] = np.logaddexp(prior[:, :1] + step[0], prior[:, 1:] + step[1])
        ahead[at, 1] += good[at]
    pairs = np.zeros((2, 2))
    z = np.logaddexp(*ahead[start + length - 1].T) if top else np.zeros(0)
    for t in range(top - 2, -1, -1):
        at = start[: active[t + 1]] + t
        nxt = back[at + 1].copy()
        nxt[:, 1] += good[at + 1]
        joint = ahead[at][:, :, None] + step[None] + nxt[:, None, :]
        back[at] = np.logaddexp(step[None, :, 0] + nxt[:, :1], step[None, :, 1] + nxt[:, 1:])
        pairs += np.exp(joint - z[: active[t + 1], None, None]).sum(0)
    total = ahead + back
    marginal = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    out = np.empty(len(z))
    out[order] = z
    return marginal, out, pairs


@dataclass
class Field:
    theta: np.ndarray | None  # weights of a line's and its neighbours' features
    step: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray, size: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Length-weighted mean log odds material: mean marginal per text, nan without lines."""
        out = np.full(n, np.nan)
        if not len(x):
            return out
        some, start, length = np.unique(owner, return_index=True, return_counts=True)
        marginal, _, _ = forward_backward(with_neighbours(x, owner) @ self.theta, start, length, self.step)
        out[some] = np.add.reduceat(marginal * size, start) / np.add.reduceat(size, start)
        return out

    def calibrated(self, mean: np.ndarray) -> np.ndarray:
        clipped = np.clip(mean, 1e-6, 1 - 1e-6)
        odds = self.scale * np.log(clipped / (1 - clipped)) + self.shift
        return np.where(np.isnan(mean), 0.0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))

    def of(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for p in W.pieces(texts):
            x, size, owner = line_features(p)
            n = p.hi - p.lo
            if self.theta is None:
                has = np.zeros(n)
                has[owner] = 0.5
                out[p.lo: p.hi] = has
            else:
                out[p.lo: p.hi] = self.calibrated(self.raw(x, size, owner, n))
        return out


def _adam(theta: list[np.ndarray], gradient, rounds: int, rate: float) -> None:
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, rounds + 1):
        for t, d, a, b in zip(theta, gradient(), first, second, strict=True):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            t -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)


def fit(x: np.ndarray, size: np.ndarray, owner: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood with a ridge, then a logistic calibration of the documents' means."""
    wide = with_neighbours(x, owner)
    some, start, length = np.unique(owner, return_index=True, return_counts=True)
    label = y[owner]
    same = owner[1:] == owner[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][same].astype(int), label[1:][same].astype(int)), 1)
    theta, step, n = np.zeros(wide.shape[1]), np.zeros((2, 2)), len(some)

    def gradient():
        # single precision throughout: a mixed product would copy the features
        marginal, _, pairs = forward_backward((wide @ theta.astype(np.float32)).astype(float), start, length, step)
        return [(wide.T @ (marginal - label).astype(np.float32)) / n + ridge * theta, (pairs - seen) / n + 0.05 * step]

    _adam([theta, step], gradient, rounds, 0.1)
    field = Field(theta.astype(np.float32), step)
    mean = np.clip(field.raw(x, size, owner, len(y)), 1e-6, 1 - 1e-6)
    has = ~np.isnan(mean)
    odds, want = np.log(mean[has] / (1 - mean[has])), y[has]
    params = np.array([0.5, 0.0])

    def calibration():
        g = 1 / (1 + np.exp(-np.clip(params[0] * odds + params[1], -30, 30))) - want
        return [np.array([(g * odds).mean() + 1e-3 * (params[0] - 0.5), g.mean()])]

    _adam([params], calibration, 300, 0.05)
    field.scale, field.shift = float(max(params[0], 0.05)), float(params[1])
    return field


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, remainder: int = 2,
          train_docs: int = TRAIN_DOCS, train_stretches: int = TRAIN_STRETCHES) -> Field:

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in W.pieces(b.column(1)):
                x, size, owner = line_features(p)
                cut = np.searchsorted(owner, np.arange(p.hi - p.lo + 1))
                some = [(k, lo, min(lo + TRAIN_LINES, cut[k + 1])) for k in range(p.hi - p.lo) for lo in range(cut[k], cut[k + 1], TRAIN_LINES)]
                ids = b.column(2).slice(p.lo, p.hi - p.lo).to_numpy().astype(W.U64)
                place = np.array([lo - cut[k] for k, lo, _ in some], W.U64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([p.lo + k for k, _, _ in some], pa.int64())),
                     pa.array([x[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                     pa.array([size[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                     pa.array(W.mix(ids[[k for k, _, _ in some]] + place).astype(np.int64))], names=["y", "x", "size", "place"])

    sample = labelled(docs, labels, label, modulus, remainder, train_docs)
    rows = sample.select("y", F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")).alias("text"), F.xxhash64("doc_id").alias("h"))
    stretches = rows.mapInArrow(features, "y double, x binary, size binary, place long")
    got = stretches.orderBy("place", "size", "x").limit(train_stretches).toArrow()  # at most so many times TRAIN_LINES lines
    y = got["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return Field(None, np.zeros((2, 2)))
    sizes = [np.frombuffer(s, float) for s in got["size"].to_pylist()]
    owner = np.repeat(np.arange(len(y)), [len(s) for s in sizes])
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(len(owner), -1)
    return fit(x, np.concatenate(sizes), owner, y)


def scored(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(field.of(b.column(1)))], names=[key, "score"])

    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, score double")


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
