"""Cross-tokenizer alignment against a brute-force version on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm.conftest import SF
from tokenizers import Tokenizer

from dropgate.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    back = {v: k for k, v in a.get_vocab().items()}
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbol = {chr(x): x for x in plain}
    symbol |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in set(plain))}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def groups(text):
        if not text:
            return []
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        sa = [bytes(symbol[c] for c in back[i]) for i in ia]
        sb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
        raw = (" " + text).encode()
        if b"".join(sa) != raw or b"".join(sb) != raw:
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in sa]), np.cumsum([len(x) for x in sb])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        out, i, j = [], 0, 0
        for c in cuts:
            k, m = int(np.searchsorted(ends_a, c)) + 1, int(np.searchsorted(ends_b, c)) + 1
            out.append((ia[i:k], ib[j:m]))
            i, j = k, m
        return out

    return groups


def brute(rows, groups):
    links, held = [], Counter()
    for _, text in rows:
        g = groups(text)
        mine = Counter((x, y) for a, b in g for x in a for y in b)
        links.append((g, mine))
        held.update(mine.keys())
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (key, _), (g, mine) in zip(rows, links, strict=True):
        digest = hashlib.sha256(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g).encode()).hexdigest() if g else ""
        out.append((key, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(mine.values()),
                    sum(m for p, m in mine.items() if held[p] == top[p[0]]), sum(m * held[p] for p, m in mine.items()), digest))
    return sorted(out, key=repr), held, links


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_texts(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(alignment.op11(docs, A, B)) == brute(rows, library)[0]


ODD = ["a", " ", "\n", "  two  blanks ", "\n\nlines\n\n and \n tabs\there\r\n", "ﬁne ① emoji 🙂🙂 日本語テキスト", "▁mark in it", "nul\x00byte",
       "<|endoftext|> and <s>plain</s> <0x0A> [UNK]", "a b c　d", "x" * 3000, "été " * 500, "don't I'll we've 12345 3.14 !!!???",
       " leading", "trailing\n", "\x1cfs \x1fus", "ab" * 700 + " é" * 300, "wórd combining", "🙂" * 400, "a" + " " * 25_000 + "b\n" + "\n" * 12_000 + "c"]


def test_odd_texts(spark, library, odd_rows):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i, t) for i, t, _ in odd_rows]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, pair int, bitmap string, n_docs int").repartition(3)
    assert got(alignment.op11(docs, A, B)) == brute(rows, library)[0]


def test_small_chunks_blocks_and_parts(spark, library, odd_rows, monkeypatch):
    """Many blocks, long texts in parts and large groups by their distinct pairs give the same rows."""
    rows = [(i, t) for i, t, _ in odd_rows] + [(200, ("some words of it\n" * 40 + "▁ ") * 3), (201, "a b c " * 900), (202, "x" * 3000)]
    want = brute(rows, library)[0]
    for name, value in (("BLOCK_CHARS", 700), ("PART_CHARS", 90), ("LARGE_GROUP", 3)):
        monkeypatch.setattr(alignment, name, value)
    chunk = alignment._Chunk(alignment.pair_of(A, B))
    for k, t in rows:
        chunk.add(k, t)
    chunk.close()
    assert sorted(repr(tuple(r)) for r in chunk.rows) == sorted(repr((*r[:5], r[7])) for r in want)
    key, times = alignment._merged(*map(np.concatenate, zip(*chunk.parts, strict=True)))
    assert int(times.sum()) == sum(r[4] for r in want)
    assert (np.diff(key) > 0).all()


def test_small_chunks(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    chunks = alignment.index(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), A, B)
    assert chunks.select("chunk").distinct().count() == 7
    assert got(alignment.scored(chunks, alignment.pair_counts(chunks, alignment.n_pieces(B)))) == brute(rows, library)[0]


def test_pair_counts(spark, library):
    rows = [(1, "the the cat sat"), (2, "the dog"), (3, "cat"), (4, None), (5, "the"), (5, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, held, links = brute(rows, library)
    total = Counter()
    for _, mine in links:
        total.update(mine)
    found = alignment.pair_counts(alignment.index(docs, A, B), alignment.n_pieces(B)).collect()
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in found} == {p: (held[p], total[p]) for p in held}


@pytest.mark.parametrize("n_docs", [1, 9, 300, 5000])
def test_bitmaps_round_trip(n_docs):
    rng = np.random.default_rng(n_docs)
    for size in {1, max(1, n_docs // 40), n_docs}:
        docs = np.sort(rng.choice(n_docs, size, replace=False))
        times = np.where(rng.random(size) < 0.5, 1, rng.integers(1, 5000, size))
        back = alignment.unpacked(*alignment.packed(docs, times, n_docs))
        assert back[0].tolist() == docs.tolist() and back[1].tolist() == times.tolist()


def test_no_rows(spark, no_docs):
    assert got(alignment.op11(no_docs, A, B)) == []


def test_cuts_are_proven(monkeypatch):
    pair = alignment.pair_of(A, B)
    assert pair.cuts
    monkeypatch.setattr(alignment, "PART_CHARS", 5)
    text = "a  b\tc d\ne\n f é🙂 gg hh" * 3
    parts = list(pair.parts(text))
    assert "".join(parts) == " " + text and len(parts) > 5
    assert [x for p in parts for x in pair.ids(p)[1].tolist()] == pair.b.encode(text)
