import hashlib

import numpy as np
import pyarrow as pa
import pytest

from dropgate.llm import neardup, substrings, words
from dropgate.llm.components import components
from llm.conftest import shape

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, k):
    ws = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)) if len(ws) >= k else frozenset([tuple(ws)] if ws else [])


def brute_groups(rows, k, num, den):
    sets = [shingles(t, k) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("k,num,small", [(3, 85, False), (5, 80, True)])
def test_groups_match_brute_force(odd_docs, odd_rows, k, num, small):
    # small: every band is one cluster and clusters are cut into many tiles
    limits = {"bucket": 2, "tile_shingles": 400} if small else {}
    got = neardup.groups(odd_docs, k, num, 100, **limits)
    assert shape(got.select("k", "n_shingles", "component_id")) == brute_groups(odd_rows, k, num, 100)


def test_keep_one(odd_docs, odd_rows):
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    want = [(d, c) for d, n, c in brute_groups(odd_rows, 5, 80, 100) if n and d == c]
    got = [(r.doc_id, r.doc_id) for r in kept.collect() if r.text and r.text.split()]
    # of repeated rows one stays
    assert sorted(got, key=repr) == sorted(set(want), key=repr)


def test_no_documents(no_docs):
    assert neardup.op3(no_docs).count() == 0
    assert neardup.keep_one(no_docs).count() == 0
    assert substrings.op10(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(2)
    for j, n in ((0.9, 400), (0.85, 60), (0.5, 3000), (0.0, 200)):
        both = int(round(2 * n * j / (1 + j)))
        est = []
        for _ in range(30):
            x = rng.integers(0, 1 << 63, 2 * n - both).astype(words.U64)
            a, b = x[:n], np.concatenate([x[:both], x[n:]])
            ra, rb = (neardup.sketch(s, np.zeros(len(s), int), 1)[0] for s in (a, b))
            est.append(neardup.likely_similarity(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([float(n)]), np.array([float(n)]))[0])
        assert abs(np.mean(est) - j) < 0.04


def test_sketches_merge():
    x = words._random64(500, 9)
    one, two, all_ = (neardup.sketch(s, np.zeros(len(s), int), 1)[0] for s in (x[:300], x[200:], x))
    assert (np.maximum(one, two) == all_).all()


def test_confirm_loses_no_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 100).astype(words.U64)
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 100, rng.integers(0, 25))), rng.integers(0, 1 << 60, rng.integers(0, 15)).astype(words.U64)]))
            for _ in range(60)]
    got = neardup.confirm(sets, np.arange(60), 85, 100)
    root = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(60):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    root[i] = root[j] = min(root[i], root[j])
        if _ > 3:
            break
    for i in range(60):
        for j in range(60):
            assert (got[i] == got[j]) == (root[i] == root[j])


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    got = dict(components(spark.createDataFrame(path + star + [(200, 200), (300, 299), (299, 300)], "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, window):
    """Reference implementation: every window looked up among the smaller ids."""
    first = {}
    big = 1 << 63
    for d, t, _ in rows:
        ws = (t or "").encode().split()
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            first[key] = min(first.get(key, big), big if d is None else d)
    out = []
    for d, t, _ in rows:
        ws = (t or "").encode().split()
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < (big if d is None else d):
                gone[i:i + window] = [True] * window
        out.append((d, ws, gone))
    return out


def test_substrings_match_brute_force(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH", 50)  # many flushes, so windows meet after them
    want = sorted(((d, len(ws), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(ws, gone) if not g)).hexdigest())
                   for d, ws, gone in brute_repeats(odd_rows, 50)), key=repr)
    assert shape(substrings.op10(odd_docs)) == want
    monkeypatch.setattr(substrings, "BROADCAST_BYTES", 0)  # the joins that shuffle
    assert shape(substrings.op10(odd_docs)) == want


def test_remove_repeats_cuts_texts(odd_docs, odd_rows):
    out = substrings.remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    want = []
    for (d, t, _), (_, ws, gone) in zip(odd_rows, brute_repeats(odd_rows, 50)):
        if not any(gone):
            want.append((d, t))
        elif not all(gone):
            want.append((d, b" ".join(w for w, g in zip(ws, gone) if not g).decode()))
    got = [(r.doc_id, r.text) for r in out.collect()]
    flat = lambda rows: sorted(((d, t if t is None else " ".join(t.split())) for d, t in rows), key=repr)
    assert flat(got) == flat(want)
    untouched = {(d, t) for (d, t, _), (_, _, gone) in zip(odd_rows, brute_repeats(odd_rows, 50)) if not any(gone)}
    assert untouched <= set(got)


@pytest.mark.parametrize("small", [False, True])
def test_rows_of_one_id_or_none_are_documents_of_their_own(spark, monkeypatch, small):
    if small:  # many flushes, and the joins that shuffle
        monkeypatch.setattr(substrings, "FLUSH", 50)
        monkeypatch.setattr(substrings, "BROADCAST_BYTES", 0)
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    five, passage = text("five", 70), text("shared", 60)
    seven = f"{text('seven', 20)} {passage} {text('after', 15)}"
    rows = [(5, five), (7, seven)]
    for d in (None, 9):  # a copy, a clean text, and two with the passage at different places
        rows += [(d, five), (d, text(f"clean{d}", 120)), (d, f"{text(f'c{d}', 40)} {passage}"), (d, f"{passage} {text(f'd{d}', 90)}")]
    rows.append(rows[4])  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = [(d, ws, gone) for d, ws, gone in brute_repeats([(d, t, None) for d, t in rows], 50)]
    want = [(d, len(ws), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(ws, gone) if not g)).hexdigest()) for d, ws, gone in cut]
    assert shape(substrings.op10(docs)) == sorted(want, key=repr)
    left = [(d, b" ".join(w for w, g in zip(ws, gone) if not g).decode()) for d, ws, gone in cut if not all(gone)]
    assert shape(substrings.remove_repeats(docs)) == sorted(left, key=repr)


def test_factors_refer_to_earlier_documents(odd_docs, odd_rows):
    texts = {}
    for d, t, _ in odd_rows:
        texts.setdefault(d, []).append((t or "").split())
    for r in substrings.factored(odd_docs).filter("factors IS NOT NULL").collect():
        k = None if r.k == substrings.LAST else r.k
        for f in r.factors:
            assert f.length >= 50 and f.ref < r.k
            stretch = " ".join(next(ws for ws in texts[k] if len(ws) == r.n_words)[f.start: f.start + f.length])
            assert any(stretch[:200] in " ".join(ws) for ws in texts[f.ref])


def test_sampled_phrases_agree_between_copies():
    rng = np.random.default_rng(3)
    ws = [str(x).encode() for x in rng.integers(0, 1000, 400)]
    a, b = b" ".join(ws), b"other start " + b" ".join(ws[100:300]) + b" end"
    got = [substrings._samples(p, 50, 25)[0] for t in (a, b) for p in words.pieces(pa.array([t]))]
    assert (got[1][2:2 + 151] == got[0][100:251]).all()
