"""Cross-tokenizer alignment over inverted pair bitmaps.

Both vocabularies cut the bytes of blank + text into tokens. Offsets where a
token of each ends cut them into groups; every token of A in a group is linked
with every token of B in it. Corpus-wide the links live in an inverted index:

* Rows are dealt into *chunks* of at most ``CHUNK_DOCS`` documents and about
  ``CHUNK_KEYS`` postings. Within a chunk each linked pair has one compressed
  bitmap of its documents: two bytes per document, or one bit per document of
  the chunk where that is shorter. How often a document holds the pair beyond
  once stands in multiplicity planes: plane k has bit k of that number for
  each document of the bitmap.
* Bitmaps of the stretches of a chunk are OR-merged when it is closed. The
  bitmaps of different chunks share no document, so popcounts, summed over
  chunks, are the corpus-wide numbers of documents and links of a pair.
* The counts go back to the postings by pair, the scored postings to their
  chunk, and a chunk's task adds them up for its documents. No group is
  larger than a chunk; pairs are never gathered in one place.

Texts are aligned whole. Long ones are encoded in parts between places that no
merge of either vocabulary crosses: before a lone blank or line break between
other characters. For A the pre-token pattern ends there; for B it is proven
on the vocabulary (no piece continues after a blank or holds a line break),
else texts are encoded in one part. The groups of many texts are found at once,
with array operations on the tokens' ends.

Defined results: a null or empty text, or one whose tokens of A or of B do not
give the bytes of blank + text again, has no tokens: zeros and an empty
digest. Every row is a document of its own, also rows that share an id or have
none; repeated rows count each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropgate.llm import bpe
from dropgate.llm.common import written

CHUNK_DOCS = 1 << 16      # documents of a chunk, at most (their numbers have 16 bits)
CHUNK_KEYS = 2_000_000    # postings at which a chunk is closed
BLOCK_CHARS = 1 << 20     # text that is aligned at once
PART_CHARS = 1 << 16      # a longer text is encoded in parts of about this size
LARGE_GROUP = 1 << 12     # links of a group beyond which only its distinct pairs are formed

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Pair:
    """Two vocabularies: ids of parts of texts, and the bytes of ids."""

    def __init__(self, a_path: str, b_path: str):
        self.enc = bpe.encoder(a_path)
        self.n_a = max(self.enc.strings.values()) + 1
        self.a_length = np.zeros(self.n_a, np.int64)
        for string, i in self.enc.strings.items():
            self.a_length[i] = len(string)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.n_b = len(pieces)
        self.b_length = np.array([len(x) for x in self.b_bytes])
        self.cuts = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        # ids as the digest writes them: after the sign that comes before them
        self.written = [sign + str(i) for sign in (";", ",", "") for i in range(self.n_a)] + [sign + str(i) for sign in "|," for i in range(self.n_b)]

    def parts(self, text: str) -> Iterator[str]:
        """blank + text, cut where no merge crosses; all parts but the first start with their own blank or line break."""
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + PART_CHARS) if self.cuts and len(text) - at > 2 * PART_CHARS else None
            end = cut.start() if cut else len(text)
            yield text[at:end] if at else " " + text[:end]
            at = end

    def ids(self, part: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B; None where tokens don't give the part's bytes again."""
        raw, a = part.encode(), self.enc.plain_ids(part).astype(np.int64)
        # B itself puts a blank before what it encodes
        b = self.b.encode(part[1:]) if part[0] == " " else self.b.encode(part)[1:]
        # merges of bytes keep them, so A's can only differ in number
        if self.a_length[a].sum() != len(raw) or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return a, np.array(b, np.int64)


@lru_cache(maxsize=2)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def _merged(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their times."""
    if not len(key):
        return key, times
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(times[order], first)


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted keys and how often they occur."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.append(first, len(key)))


def _places(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... : many[i] numbers for each i, one after the other."""
    return np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())


class _Chunk:
    """Documents in order of arrival with the postings of their links."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.reset()

    def reset(self) -> None:
        self.rows, self.parts, self.size = [], [], 0
        self.waiting, self.chars, self.digests = [], 0, {}

    def add(self, key, text: str | None) -> None:
        """Take a document; its links follow with the block."""
        doc, before = len(self.rows), len(self.parts)
        self.rows.append([key, 0, 0, 0, 0, ""])
        for part in self.pair.parts(text or ""):
            ids = self.pair.ids(part)
            if ids is None:  # no tokens: take back what the text's other parts gave
                self.rows[doc] = [key, 0, 0, 0, 0, ""]
                self.digests.pop(doc, None)
                self.waiting = [w for w in self.waiting if w[0] != doc]
                self.parts[before:] = [_without(p, doc) for p in self.parts[before:]]
                return
            self.waiting.append((doc, *ids))
            self.chars += len(part)
            if self.chars >= BLOCK_CHARS:
                self.work()

    def work(self) -> None:
        """Groups, counts, digests and (pair key, document) postings of the waiting parts."""
        if not self.waiting:
            return
        docs, ids_a, ids_b = zip(*self.waiting, strict=True)
        size_a, size_b, docs = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b]), np.array(docs)
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        # parts have the same bytes in both, so common ends are those of groups, the parts' ends among them
        ends_a, ends_b = np.cumsum(self.pair.a_length[a]), np.cumsum(self.pair.b_length[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = ends_b[at] == ends_a
        last_b = np.zeros(len(b), bool)
        last_b[at[last_a]] = True
        to_a, to_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        many_a, many_b = to_a - from_a, to_b - from_b
        part = np.searchsorted(np.cumsum(size_a), to_a)
        doc = docs[part]
        self._digest(a, b, from_a, from_b, many_a, many_b, part)
        links = many_a * many_b
        for k, (n_a, n_b, n_groups, n_links) in enumerate(zip(size_a.tolist(), size_b.tolist(), np.bincount(part, minlength=len(docs)).tolist(),
                                                              np.add.reduceat(links, np.searchsorted(part, np.arange(len(docs)))).tolist(), strict=True)):
            row = self.rows[docs[k]]
            row[1:5] = [row[1] + n_a, row[2] + n_b, row[3] + n_groups, row[4] + n_links]
        some = np.flatnonzero(links <= LARGE_GROUP)
        tokens = _places(from_a[some], many_a[some])
        each = np.repeat(many_b[some], many_a[some])
        keys = np.repeat(a[tokens] * self.pair.n_b, each) + b[_places(np.repeat(from_b[some], many_a[some]), each)]
        keys = np.sort(keys << 16 | np.repeat(doc[some], links[some]))
        found = [_counted(keys)]
        for g in np.flatnonzero(links > LARGE_GROUP):  # distinct pairs only, with their number
            x, m = np.unique(a[from_a[g]: to_a[g]], return_counts=True)
            y, n = np.unique(b[from_b[g]: to_b[g]], return_counts=True)
            found.append(((x[:, None] * self.pair.n_b + y).ravel() << 16 | doc[g], (m[:, None] * n).ravel()))
        self.parts += found
        self.size += sum(len(keys) for keys, _ in found)
        self.waiting, self.chars = [], 0

    def _digest(self, a, b, from_a, from_b, many_a, many_b, part) -> None:
        """Carry on the documents' digests: the ids in order, A's before B's in each group."""
        n_a = self.pair.n_a
        out = np.empty(len(a) + len(b), np.int64)
        code_a, code_b = a + n_a, b + 3 * n_a + self.pair.n_b
        code_a[from_a] -= n_a
        code_b[from_b] -= self.pair.n_b
        out[np.arange(len(a)) + np.repeat(from_b, many_a)] = code_a
        out[np.arange(len(b)) + np.repeat(from_a + many_a, many_b)] = code_b
        ends = np.cumsum(many_a + many_b)[np.append(np.flatnonzero(part[1:] != part[:-1]), len(part) - 1)]
        at = 0
        for (doc, _, _), end in zip(self.waiting, ends.tolist(), strict=True):
            codes = out[at:end].tolist()
            if doc not in self.digests:
                self.digests[doc] = hashlib.sha256()
                codes[0] += 2 * n_a  # nothing before the document's first id
            self.digests[doc].update("".join(map(self.pair.written.__getitem__, codes)).encode())
            at = end

    def close(self) -> None:
        self.work()
        for doc, digest in self.digests.items():
            self.rows[doc][5] = digest.hexdigest()

    def full(self) -> bool:
        return self.size >= CHUNK_KEYS or len(self.rows) >= CHUNK_DOCS


def _without(part: tuple[np.ndarray, np.ndarray], doc: int) -> tuple[np.ndarray, np.ndarray]:
    keep = (part[0] & 0xFFFF) != doc
    return part[0][keep], part[1][keep]


def packed(docs: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[bool, bytes, bytes]:
    """(dense, bitmap, planes) of one pair in a chunk of ``n_docs`` documents."""
    dense = 2 * len(docs) > -(-n_docs // 8)
    if dense:
        bits = np.zeros(n_docs, bool)
        bits[docs] = True
        bitmap = np.packbits(bits).tobytes()
    else:
        bitmap = docs.astype("<u2").tobytes()
    more = times - 1
    planes = [np.packbits((more >> k) & 1 == 1).tobytes() for k in range(int(more.max()).bit_length())]
    return dense, bitmap, b"".join(planes)


def unpacked(dense: bool, bitmap: bytes, planes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Documents and times of one pair of a chunk."""
    docs = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8))) if dense else np.frombuffer(bitmap, "<u2").astype(np.int64)
    times = np.ones(len(docs), np.int64)
    width = -(-len(docs) // 8)
    for k in range(len(planes) // width):
        bits = np.frombuffer(planes, np.uint8, width, k * width)
        times += np.unpackbits(bits, count=len(docs)).astype(np.int64) << k
    return docs, times


def _index_rows(chunk: _Chunk, number: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    rows, n = chunk.rows, len(chunk.rows)
    columns = list(zip(*rows, strict=True))
    none = lambda t, k: pa.nulls(k, t)
    names = ["chunk", "doc", "key", "n_a", "n_b", "n_groups", "n_links", "digest", "pair", "dense", "bitmap", "planes"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number)), pa.array(np.arange(n, dtype=np.int32)), pa.array(columns[0], kind),
         *[pa.array(c, pa.int64()) for c in columns[1:5]], pa.array(columns[5], pa.string()),
         none(pa.int64(), n), none(pa.bool_(), n), none(pa.binary(), n), none(pa.binary(), n)], names=names)
    if not chunk.parts:
        return
    key, times = _merged(*map(np.concatenate, zip(*chunk.parts, strict=True)))  # OR-merge of the blocks' postings
    pairs, docs = key >> 16, key & 0xFFFF
    cut = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    cut = np.append(cut, len(pairs))
    top = np.maximum.reduceat(times, cut[:-1])
    length = np.diff(cut)
    plain = (top == 1) & (2 * length <= -(-n // 8))  # short lists without planes need no work of their own
    for lo in range(0, len(length), 1 << 16):
        hi = min(lo + (1 << 16), len(length))
        bitmaps, dense, planes = [], np.zeros(hi - lo, bool), []
        raw = docs[cut[lo]: cut[hi]].astype("<u2").tobytes()
        for k in range(lo, hi):
            a, b = cut[k], cut[k + 1]
            if plain[k]:
                bitmaps.append(raw[2 * (a - cut[lo]): 2 * (b - cut[lo])])
                planes.append(b"")
            else:
                dense[k - lo], bitmap, plane = packed(docs[a:b], times[a:b], n)
                bitmaps.append(bitmap)
                planes.append(plane)
        m = hi - lo
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, number)), none(pa.int32(), m), none(kind, m), *[none(pa.int64(), m)] * 4, none(pa.string(), m),
             pa.array(pairs[cut[lo:hi]]), pa.array(dense), pa.array(bitmaps, pa.binary()), pa.array(planes, pa.binary())], names=names)


def index(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index, written: one row per document and one per (chunk, pair)."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, number = _Chunk(pair_of(a_path, b_path)), None
        for b in batches:
            if number is None and len(b):
                number = b.column(2)[0].as_py() << 32
            for lo in range(0, len(b), 256):
                some = b.slice(lo, 256)
                for k, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    chunk.add(k, t)
                    if chunk.full():
                        chunk.close()
                        yield from _index_rows(chunk, number, b.column(0).type)
                        number += 1
                        chunk.reset()
                column = b.column(0).type
        if chunk.rows:
            chunk.close()
            yield from _index_rows(chunk, number, column)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.spark_partition_id().cast("long").alias("part"))
    schema = (f"chunk long, doc int, key {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, digest string, "
              "pair long, dense boolean, bitmap binary, planes binary")
    return written(rows.mapInArrow(run, schema), "align-index")


def _times_total(n: Column, planes: Column) -> Column:
    """Links of a posting: one per document and what its planes add (popcount of plane k, times 2^k)."""
    width = F.ceil(n / 8).cast("int")
    one = lambda total, k: total + F.bitmap_count(F.substring(planes, k * width + 1, width)) * F.pow(F.lit(2), k).cast("long")
    levels = F.sequence(F.lit(0), (F.octet_length(planes) / width).cast("int") - 1)
    return n + F.when(F.octet_length(planes) > 0, F.aggregate(levels, F.lit(0).cast("long"), one)).otherwise(0)


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """pair, a, b, n_docs, n_links and whether n_docs is the highest of its A id, for every linked pair."""
    bits = F.when(F.col("dense"), F.bitmap_count("bitmap")).otherwise(F.octet_length("bitmap") / 2).cast("long")
    per = (rows.filter(F.col("pair").isNotNull()).select("pair", "planes", bits.alias("n"))
           .select("pair", "n", _times_total(F.col("n"), F.col("planes")).alias("links"))
           .groupBy("pair").agg(F.sum("n").alias("n_docs"), F.sum("links").alias("n_links")))
    per = written(per.withColumn("a", F.floor(F.col("pair") / n_b).cast("int")).withColumn("b", (F.col("pair") % n_b).cast("int")), "align-pairs")
    top = per.groupBy("a").agg(F.max("n_docs").alias("top"))  # at most one row per id of A
    return per.join(F.broadcast(top), "a").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("top")).alias("best"))


def _sums(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per document of a chunk: links that are their A id's best, and the sum of the links' counts."""
    docs = table.filter(table["doc"].is_valid())
    n = len(docs)
    count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    postings = table.filter(table["pair"].is_valid())
    for b in postings.select(["dense", "bitmap", "planes", "n_docs", "best"]).to_batches():
        parts = [unpacked(*x) for x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)]
        if parts:
            length = [len(d) for d, _ in parts]
            where, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            np.add.at(count_sum, where, times * np.repeat(b.column(3).to_numpy(), length))
            np.add.at(n_best, where, times * np.repeat(b.column(4).to_numpy(zero_copy_only=False), length))
    return n_best, count_sum


def scored(rows: DataFrame, pairs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document its counts and digest, with what the scored postings of its chunk add up to."""
    kind = rows.schema["key"].dataType.simpleString()
    names = ["chunk", "doc", "key", "n_a", "n_b", "n_groups", "n_links", "digest", "pair", "dense", "bitmap", "planes"]
    postings = rows.filter(F.col("pair").isNotNull()).join(pairs.select("pair", "n_docs", "best"), "pair")
    plain = rows.filter(F.col("pair").isNull()).select("*", F.lit(None).cast("long").alias("n_docs"), F.lit(None).cast("boolean").alias("best"))
    both = postings.select(*names, "n_docs", "best").unionByName(plain.select(*names, "n_docs", "best"))

    def run(table: pa.Table) -> pa.Table:
        docs = table.filter(table["doc"].is_valid()).sort_by("doc")
        n_best, count_sum = _sums(table)
        return pa.Table.from_arrays(
            [docs["key"], docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_links"], pa.array(n_best), pa.array(count_sum), docs["digest"]],
            names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return both.groupBy("chunk").applyInArrow(
        run, f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def n_pieces(b_path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def op11(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    rows = index(docs, a_path, b_path)
    return scored(rows, pair_counts(rows, n_pieces(b_path)))
