"""Substring dedup by relative Lempel-Ziv factors.

Every document is a reference block for the documents with larger ids. The
index keeps sampled phrases: of the 25-word phrases inside any 50-word window
the one with the smallest hash, so a window and its copy sample the same
phrase. A document is factored against all blocks at once: windows whose
sampled phrase is indexed for a second document are looked up whole (128 bits
of hash over 50 words), and runs of windows found in an earlier block are its
factors. A factor may end inside a window that another block holds; as every
window is looked up, also those across factor boundaries, such factors
overlap instead of losing words. Words inside factors of 50 words or more are
duplicates.

Exact copies are settled first, by the SHA-256 of their words; only the
smallest id of a copy group is indexed. A window that many documents share is
settled inside each batch first: all but the batch's smallest document have
their reference there, so one row per window and batch is matched among
batches, and no window, however frequent, makes a large group.

Defined results: ids are integers; a null id counts as larger than all, and
rows with equal ids are never each other's reference. Rows of one id (or of
none) with different texts are documents of their own, told apart by a hash of
the text (``tag``); ids alone say which document is earlier. A null or empty
text has no words; texts under 50 words lose nothing. Repeated rows (equal id
and text) are treated alike. Very long texts are hashed in one piece each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dropgate.llm import words as W
from dropgate.llm.common import free_names, written

WINDOW = 50
PHRASE = 25
FLUSH = 500_000             # windows that a task settles at a time
BROADCAST_BYTES = 48 << 20  # side tables up to this size are broadcast, others shuffled
LAST = (1 << 63) - 1        # stands for a null id


def _sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours."""
    out, width, left = h, 1, n
    while width * 2 <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    left = n - width
    return np.minimum(out[: len(out) - left], out[left:]) if left else out


def _samples(piece: W.Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled phrase of each window, with the window's first word and text; windows lie inside texts."""
    h = piece.hashes()
    if len(h) < window:
        return np.zeros(0, W.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _sliding_min(W.ngrams(h, phrase), window - phrase + 1)
    doc = piece.doc()
    at = np.flatnonzero(doc[: len(least)] == doc[window - 1:])
    return least[at], at, doc[at]


def _signatures(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """k, tag, n_words, sha (of the words) and the sampled phrases of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha, phrases, texts = [], [], [], b.column(1)
            for p in W.pieces(texts):
                n.append(p.count())
                raw = p.data.tobytes()
                sha += [hashlib.sha256(b" ".join(raw[i:j].split())).digest() for i, j in zip(p.offsets[:-1], p.offsets[1:], strict=True)]
                least, _, doc = _samples(p, window, phrase)
                new = np.ones(len(least), bool)  # neighbours mostly share their sample
                new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
                least, cuts = least[new].view(np.int64), np.searchsorted(doc[new], np.arange(p.hi - p.lo + 1))
                phrases += [np.unique(least[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in phrases])]).astype(np.int32)
            flat = np.concatenate(phrases) if phrases else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.concatenate(n) if n else [], pa.int64()), pa.array(sha, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int64()))],
                names=["k", "tag", "n_words", "sha", "phrases"])

    return docs.mapInArrow(run, "k long, tag long, n_words long, sha binary, phrases array<long>")


def _windows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Looked-up windows of documents with indexed ``phrases``: a row per window and
    id of a batch, with the places (``tags`` and ``starts``) where documents of that
    id have it.

    Rows without ``ref`` are to be settled among batches; with it, the batch
    itself holds the window in the smaller document ``ref``. Those get a hash of
    their own, so they meet no other row.
    """

    def settle(held: list[tuple]) -> pa.RecordBatch:
        h1, h2, k, tag, start = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, tag, k, h2, h1))
        h1, h2, k, tag, start = h1[order], h2[order], k[order], tag[order], start[order]
        other = np.ones(len(k), bool)
        other[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new = other.copy()
        new[1:] |= k[1:] != k[:-1]
        row = np.flatnonzero(new)
        least = k[np.maximum.accumulate(np.where(other, np.arange(len(k)), 0))][row]
        h1, h2, k = h1[row], h2[row], k[row]
        known = least < k
        h1[known] = W.mix(h1[known] ^ W.mix(k[known].view(W.U64)))
        cuts = pa.array(np.append(row, len(start)).astype(np.int32))
        tags, starts = (pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (tag, start.astype(np.int32)))
        return pa.RecordBatch.from_arrays(
            [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(k), tags, starts, pa.array(least, pa.int64(), mask=~known)],
            names=["h1", "h2", "k", "tags", "starts", "ref"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            keys, shared, tags = b.column(0).to_numpy(), b.column(2), b.column(3).to_numpy()
            for p in W.pieces(b.column(1)):
                least, at, doc = _samples(p, window, phrase)
                mine = shared.slice(p.lo, p.hi - p.lo)
                values = mine.flatten().to_numpy().view(W.U64)
                # a phrase is indexed by value, so one set serves the whole piece
                hit = np.isin(least, values)
                at, doc = at[hit], doc[hit]
                if not len(at):
                    continue
                h = p.hashes()
                held.append((W.ngrams(h, window)[at], W.ngrams(W.mix(h ^ W.U64(0x5BD1E995)), window)[at],
                             keys[p.lo: p.hi][doc], tags[p.lo: p.hi][doc], at - p.first[:-1][doc]))
                size += len(at)
                if size >= FLUSH:
                    yield settle(held)
                    held, size = [], 0
        if held:
            yield settle(held)

    return docs.mapInArrow(run, "h1 long, h2 long, k long, tags array<long>, starts array<int>, ref long")


def _factors(rows: DataFrame, window: int) -> DataFrame:
    """k, tag and the document's factors: (start, length, ref) of maximal runs of found windows, sorted."""
    found = rows.groupBy("k", "tag").agg(F.sort_array(F.collect_set(F.struct("start", "ref"))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, lengths, refs, cuts = [], [], [], [0]
            found = b.column(2)
            at = found.offsets.to_numpy()
            flat = found.values
            s, r = flat.field("start").to_numpy(), flat.field("ref").to_numpy()
            for i, j in zip(at[:-1], at[1:], strict=True):
                x, y = s[i:j], r[i:j]
                new = np.ones(len(x), bool)
                new[1:] = (np.diff(x) > 1) | (y[1:] != y[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(x)) - 1
                starts.append(x[first]), lengths.append(x[last] - x[first] + window), refs.append(y[first])
                cuts.append(cuts[-1] + len(first))
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(v), t) for v, t in
                                               ((starts, pa.int32()), (lengths, pa.int32()), (refs, pa.int64()))],
                                              names=["start", "length", "ref"])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)],
                                             names=["k", "tag", "factors"])

    return found.mapInArrow(run, "k long, tag long, factors array<struct<start:int,length:int,ref:long>>")


def _side(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast a written table whose measured size is within bounds; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def factored(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """k (the id, nulls as LAST), tag (a hash of the text), n_words, sha of all words,
    copy_of (the smallest id with the same words, if another), and factors."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("k"),
                       F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")).alias("text"), F.xxhash64(F.col(text)).alias("tag"))
    signed = written(_signatures(rows, window, phrase), "rlz-signatures")
    long_enough = signed.filter(F.col("n_words") >= window)
    # copy groups: the smallest id stands for the group
    same = long_enough.groupBy("sha").agg(F.min("k").alias("one"), F.max("k").alias("most")).filter("one < most").drop("most")
    marked = written(signed.join(same, "sha", "left").withColumn("copy_of", F.when(F.col("one") < F.col("k"), F.col("one"))).drop("one"),
                     "rlz-marked")
    single = marked.filter(F.col("copy_of").isNull() & (F.col("n_words") >= window))
    indexed = single.select("k", "tag", F.explode("phrases").alias("phrase"))
    shared = indexed.groupBy("phrase").agg(F.min("k").alias("a"), F.max("k").alias("z")).filter("a < z").select("phrase")
    hits = indexed.join(shared, "phrase").groupBy("k", "tag").agg(F.collect_set("phrase").alias("phrases"))
    hits = written(hits, "rlz-hits")
    n_bytes = hits.agg(F.sum(56 + 8 * F.size("phrases"))).first()[0] or 0
    if n_bytes <= BROADCAST_BYTES:
        to_look = rows.join(F.broadcast(hits), ["k", "tag"]).select("k", "text", "phrases", "tag")
    else:  # sorted, so that a task that runs again settles the same batches
        to_look = rows.join(hits, ["k", "tag"]).select("k", "text", "phrases", "tag").sortWithinPartitions("k", "tag")
    looked = _windows(to_look, window, phrase)
    least = F.min("k").over(Window.partitionBy("h1", "h2"))
    settled = (looked.withColumn("least", least).withColumn("ref", F.coalesce(F.when(F.col("least") < F.col("k"), F.col("least")), F.col("ref")))
               .filter(F.col("ref").isNotNull()).select("k", "ref", F.inline(F.arrays_zip(F.col("tags").alias("tag"), F.col("starts").alias("start")))))
    factors = written(_factors(settled, window), "rlz-factors")
    return marked.select("k", "tag", "n_words", "sha", "copy_of").join(factors, ["k", "tag"], "left")


def _covered(factors, n: int) -> np.ndarray:
    cover = np.zeros(n, bool)
    for f in factors or ():
        cover[f["start"]: f["start"] + f["length"]] = True
    return cover


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, digest: bool = False) -> DataFrame:
    """``docs`` without the words that an earlier document holds in a window.

    Untouched documents keep their text as it is; from others the covered
    stretches are cut, and documents with nothing left go. ``digest`` instead
    returns k, n_words, n_removed, kept_sha256 of every document.
    """
    found = factored(docs, window, phrase)
    if digest:
        plain = found.filter(F.col("copy_of").isNotNull() | F.col("factors").isNull()).select(
            "k", "n_words", F.when(F.col("copy_of").isNotNull(), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
            F.when(F.col("copy_of").isNotNull(), F.sha2(F.lit(""), 256)).otherwise(F.lower(F.hex("sha"))).alias("kept_sha256"))
        todo = found.filter(F.col("copy_of").isNull() & F.col("factors").isNotNull()).select("k", "tag", "factors").dropDuplicates(["k", "tag"])
        todo = written(todo, "rlz-todo")
        rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k"), F.xxhash64("text").alias("tag"),
                           F.col("text").cast("binary").alias("text"))
        touched = rows.join(_side(todo, 168), ["k", "tag"]).select("k", "text", "factors")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n, gone, sha = [], [], []
                for t, fs in zip(b.column(1), b.column(2), strict=True):
                    ws = (t.as_py() or b"").split()
                    cover = _covered(fs.as_py(), len(ws))
                    n.append(len(ws)), gone.append(int(cover.sum()))
                    sha.append(hashlib.sha256(b" ".join([w for w, c in zip(ws, cover.tolist(), strict=True) if not c])).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
                                                 names=["k", "n_words", "n_removed", "kept_sha256"])

        return plain.unionByName(touched.mapInArrow(cut, "k long, n_words long, n_removed long, kept_sha256 string"))

    k, tag, row = free_names(docs, "_k", "_tag", "_row")
    todo = written(found.filter(F.col("copy_of").isNotNull() | F.col("factors").isNotNull()).select(
        F.col("k").alias(k), F.col("tag").alias(tag), F.col("copy_of").isNotNull().alias("copied"), "factors").dropDuplicates([k, tag]), "rlz-todo")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(k), F.xxhash64("text").alias(tag),
                       F.struct(*[F.col(c) for c in docs.columns]).alias(row))
    rows = rows.join(_side(todo, 168), [k, tag], "left")
    same = rows.filter(F.col("copied").isNull()).select(*[F.col(row)[c].alias(c) for c in docs.columns])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, fs in zip(b.column(1), b.column(2), strict=True):
                raw = t.as_py() or b""
                (p,) = W.pieces(pa.array([raw], pa.binary()))
                cover = _covered(fs.as_py(), len(p.start))
                gone = np.zeros(len(raw), bool)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(np.int8), [0]])))
                for i, j in edge.reshape(-1, 2):  # up to the next kept word
                    gone[p.start[i]: p.start[j] if j < len(p.start) else len(raw)] = True
                out.append(p.data[~gone].tobytes().strip().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["row", "text"])

    touched = rows.filter(~F.col("copied")).select(F.col(row).alias("row"), F.col(f"{row}.text").cast("binary").alias("text"), "factors")
    kind = touched.schema["row"].dataType.simpleString()
    cut_rows = touched.mapInArrow(keep, f"row {kind}, text string").filter(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    columns = [F.col("text").alias(c) if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
               else F.col("row")[c].alias(c) for c in docs.columns]
    return same.unionByName(cut_rows.select(*columns))


def op10(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs, digest=True)
    return out.select(F.when(F.col("k") != LAST, F.col("k")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
