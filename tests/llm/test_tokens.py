import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dropgate.llm import bpe, packing, tokencount, words
from llm.conftest import shape

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a  b", "a\tb", " lead", "trail ", "x\n\ny", "<|endoftext|> a <|endoftext|>", "<|endoftext|>\n", "'s 's don't", "  b ",
         "日本 語 　x", "\n", "\na", "a\n", "  ", "é́ ñ", "😀 a😀b", "1234 12,3", " a a", "a b\nc", "\x1ca b\x85c", "w" * 5000, " " * 3000]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def test_ids_and_counts_equal_the_library(library, odd_rows):
    enc, count = bpe.encoder(PATH), tokencount.counter(PATH).count
    for t in TEXTS + [t or "" for _, t, _ in odd_rows]:
        want = library(t)
        assert enc.ids(t).tolist() == want
        assert count(t) == len(want)


@pytest.mark.parametrize("white", [" ", "\n", "\r\n\t \u3000\x85"])
def test_long_white_space_equals_the_library(library, white):
    enc, count = bpe.encoder(PATH), tokencount.counter(PATH).count
    n = bpe.LONG_RUN
    runs = [white * (k // len(white)) for k in (n - 1, n, n + 7, 3_000_000)]
    texts = [a + r + b for r in runs for a, b in (("", ""), ("one two", "three 's"), ("x\x1c", "\x1cy"), (".", "<|endoftext|>"))]
    texts.append(f"a{runs[2]}b c{runs[1]}1{runs[2]}<|endoftext|>{runs[1]}é<|endoftext|>{runs[1]}")
    for t in texts:
        want = library(t)
        assert enc.ids(t).tolist() == want
        assert count(t) == len(want)


def test_padded_documents_get_rows(spark, library):
    rows = [(1, "a" + " " * 3_000_000 + "b"), (2, "\n" * 2_500_000), (3, "short text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: len(library(t)) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in tokencount.op7(docs, PATH).collect()} == want
    got = {}
    for r in packing.op8(docs, PATH).collect():
        assert r.doc_tokens == want[r.doc_id] + 1
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: n + 1 for i, n in want.items()}


def test_whole_tokens_are_proven(library):
    whole = tokencount.whole_tokens(PATH)
    assert len(whole) > 45_000
    for s in sorted(whole)[::500]:
        assert len(library(s)) == 1


def test_op7(odd_docs, odd_rows, no_docs, library):
    want = sorted(((i, len((t or "").encode()), n := len(library(t)), n > 1024) for i, t, _ in odd_rows), key=repr)
    assert shape(tokencount.op7(odd_docs, PATH)) == want
    assert tokencount.op7(no_docs, PATH).count() == 0


def test_tightest_window():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 65, 300))[::-1]
    where, offset = packing.best_fit_decreasing(lengths, 64)
    room, slow = [], []
    for n in lengths.tolist():
        fits = [r for r in room if r >= n]
        if fits:
            at = room.index(min(fits))
        else:
            room.append(64)
            at = len(room) - 1
        slow.append(room[at] - n)
        room[at] -= n
    assert sorted(64 - offset - lengths) == sorted(slow)
    assert where.max() + 1 == len(room)
    for w in range(where.max() + 1):
        mine = sorted(zip(offset[where == w], lengths[where == w]))
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]


def test_op8_round_trip(odd_docs, odd_rows, no_docs, library, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_IDS", 5_000)  # several groups
    rows = packing.op8(odd_docs, PATH).collect()
    want = {}
    for i, t, _ in odd_rows:
        want.setdefault(i, []).append(np.array([*library(t), 0], "<u4"))
    for i, docs in want.items():
        mine = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        assert mine == sorted((s, len(d[s:s + 1024]), zlib.crc32(d[s:s + 1024].tobytes()), len(d)) for d in docs for s in range(0, len(d), 1024))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    assert packing.op8(no_docs, PATH).count() == 0


def test_sequences_hold_the_ids(odd_docs, odd_rows, library):
    total = 0
    for r in packing.sequences(odd_docs.filter("doc_id IS NOT NULL AND doc_id < 60"), PATH).collect():
        assert len(r.tokens) == 1024 or len(r.tokens) & (len(r.tokens) - 1) == 0
        for p in r.pieces:
            doc = [*library(next(t for i, t, _ in odd_rows if i == p.doc_id)), 0]
            assert r.tokens[p.offset: p.offset + p.length] == doc[p.start: p.start + p.length]
            total += p.length
    assert total == sum(len(library(t)) + 1 for i, t, _ in odd_rows if i is not None and i < 60)


def test_words_and_hashes(odd_rows):
    texts = [(t or "").encode() for _, t, _ in odd_rows]
    seen = {}
    for p in words.pieces(pa.array(texts, pa.binary())):
        h = p.hashes(lower=True)
        for d in range(p.hi - p.lo):
            own = range(p.first[d], p.first[d + 1])
            assert [bytes(p.data[p.start[i]:p.end[i]]) for i in own] == texts[p.lo + d].split()
            for i in own:
                assert seen.setdefault(bytes(p.data[p.start[i]:p.end[i]]).lower(), h[i]) == h[i]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 25, 50])
def test_ngrams(n):
    h = words._random64(200, 3)
    twice = words.ngrams(np.concatenate([h, h]), n)
    assert len(twice) == 401 - n and (twice[:201 - n] == twice[200:]).all() and len(np.unique(words.ngrams(h, n))) == 201 - n


def test_groups_that_hold_ids_are_small(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 1000) AS text")
    total = docs.selectExpr("sum(octet_length(text) + 1)").first()[0]
    held = packing.groups_for(docs, "text", packing.GROUP_IDS_HELD)
    assert held == -(-total // (2 * packing.GROUP_IDS_HELD)) > packing.groups_for(docs) == 1
    got = packing.sequences(docs, PATH).selectExpr("shiftright(sequence_id, 32) AS g", "tokens", "n_tokens", "pieces")
    rows = got.selectExpr("g", "n_tokens", "size(tokens) AS n", "aggregate(pieces, 0L, (a, p) -> a + p.length) AS of").collect()
    assert len({r.g for r in rows}) == held and all(r.n_tokens == r.of for r in rows)
