"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

from dropgate.llm import variants
from llm.conftest import shape

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
LOWER = str.maketrans(variants.UPPER, variants.LOWER)


def brute(rows):
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    by = {}
    for w in words:
        for i in range(len(w) + 1):
            by.setdefault((w[:i], w[i:]), set()).add(w)
            if i < len(w):
                by.setdefault((w[:i], w[i + 1:], 1), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= by[(w[:i], w[i + 1:], 1)] - {w}
            shorter = w[:i] + w[i + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def checked(spark, rows, parts=3):
    docs = spark.createDataFrame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, n int, word string, hole boolean")
    out = variants.op13(docs.repartition(parts))
    assert out.columns == COLUMNS
    got = shape(out)
    assert got == brute(rows)
    return got


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert shape(variants.op13(docs)) == brute([tuple(r) for r in docs.collect()])


def test_odd_rows(spark, odd_rows):
    checked(spark, [(i, t) for i, t, _ in odd_rows])


def test_chains_ties_and_equal_letters(spark):
    rows = [(k, t) for k, t in enumerate(
        ["recieve receive " + "receive " * 24, "recieve receivee " * 1, "receives receives receives", "receive " * 400 + "received " * 5000,
         "aaaaaaaa aaaaaaaaa aaaaaaa " * 3, "aaabbbccc aabbbccc aaabbccc aaabbbcc " * 2, "ÀÉÎõüç÷ ÀÉÎõüçø ÀÉÎõüç× " * 20, "àéîõüç÷ " * 900,
         "tiebrea tiebreb tiebrec tiebred " * 30, "tiebree tiebree", "word7of a" * 4, "Straße straße STRASSE strasse " * 9])]
    got = {r[0]: r for r in checked(spark, rows)}
    assert got["receive"][1] == "received" and got["recieve"][1] is None  # two code points differ
    assert got["tiebree"][1] == "tiebrea"


def test_long_chain(spark):
    """Forms of forms: every step has ten times the count."""
    steps = ["abcdefgh", "abcdefg", "abcdefx", "abcdexx", "abcdxxx"]
    rows = [(7_000_000 + k, " ".join([w] * 2 * 11 ** k)) for k, w in enumerate(steps)]
    got = {r[0]: r for r in checked(spark, rows)}
    if all(w in got for w in steps):
        assert got["abcdefgh"][2] == "abcdxxx"


def test_prefixes_across_ranges(spark):
    """Words of one stem over many ranges: shared prefixes have one number."""
    rng = random.Random(3)
    vocabulary = ["international" + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 7))) for _ in range(700)] + \
                 ["".join(rng.choice("xy") for _ in range(rng.randrange(7, 12))) + "isation" for _ in range(700)]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(300))) for k in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        checked(spark, rows)
        words = spark.createDataFrame([(w,) for w in sorted(set(vocabulary))], "word string")
        nodes = {w: p for w, p in variants.trie(words, "test-trie").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    number = {}
    for w, path in nodes.items():
        assert len(path) == len(w) + 1
        for i, x in enumerate(path):
            assert number.setdefault(w[:i], x) == x
    assert len(set(number.values())) == len(number)
    assert sorted(nodes, key=lambda w: nodes[w][-1]) == sorted(nodes)


def test_near_pairs(spark, odd_rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in odd_rows], "doc_id long, text string")
    table = variants.entries(variants.words(docs, slip=0, least_length=5))
    word = {r.id: r.word for r in table.collect()}
    got = sorted((word[r.id], word[r.other]) for r in variants.near_pairs(table).collect())

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    some = sorted(word.values())
    want = [(a, b) for a in some for b in some if abs(len(a) - len(b)) < 2 and a != b and one_apart(a, b)]
    assert got == sorted(want)


def test_long_words(spark):
    long = "ab" * 3000
    checked(spark, [(1, long + " " + long), (2, long[:-1] + " " + long[:-1]), (3, (long + "é ") * 25), (4, "z" * 5000 + " " + "z" * 4999), (5, "z" * 5000 + " " + "z" * 4999)])


def test_no_words(spark, no_docs):
    assert variants.op13(no_docs).collect() == []
    checked(spark, [(1, None), (2, ""), (None, "short words only")])
