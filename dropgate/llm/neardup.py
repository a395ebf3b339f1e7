"""Near-duplicate groups by SetSketch registers, confirmed on full sets.

A document is the set of its word shingles. Each distinct set (128 bits of
hash) gets a SetSketch: register j holds, on an exponential scale, the least
of the elements' exponential values for j. Registers of a union are the
maxima of the registers, and equal registers are about as likely as the Jaccard
similarity, so groups of registers serve as bands.

Sets that share a band are compared by the maximum-likelihood similarity of
their registers and known sizes; those that may be similar (five standard
errors below the threshold) form candidate clusters, a superset of the
groups. Inside a cluster links are confirmed on the full shingle sets. A
pivot is compared with all others at once and sets that are already connected
are not compared again, so a large group of copies costs a few passes, not
all pairs. Clusters beyond one task's memory are cut into tiles: tiles first,
then their main groups against each other, then only what is not in the main
group of its cluster against every tile. No link is lost: a pair is skipped
only when its sets are known to be connected.

With 24 bands of 4 registers, a pair at 0.85 shares no band with probability
2e-8, at 0.80 with 3e-6.

Defined results: null and empty texts (and texts without words) have no
shingles, link with nothing and are their own component. Ids are integers; a
component's id is its least non-null id. Repeated rows are copies of each
other. Very long texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm import words as W
from dropgate.llm.common import free_names, written
from dropgate.llm.components import components

REGISTERS, BANDS = 96, 24
BASE, RATE, TOP = 1.001, 20.0, 65535  # register scale: 1 - log_BASE(value), clipped to 0..TOP
BUCKET = 1500                # sets of a band compared by sketch in one step; larger bands are one cluster
TILE_SHINGLES = 2_000_000    # shingles of a cluster that a task holds, 16 MB
BROADCAST_ROWS = 1_000_000   # of narrow tables (under 40 MB)
ERRORS = 5.0                 # standard errors below the threshold that a sketch may fall

_STEPS = np.array([s for s in range(1, REGISTERS) if np.gcd(s, REGISTERS) == 1], np.int64)


def shingle_sets(piece: W.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a piece: hashes and text numbers, sorted by text and hash."""
    h, first, n = piece.hashes(lower=True), piece.first, piece.count()
    doc = piece.doc()
    grams = W.ngrams(h, k)
    inside = doc[: len(grams)] == doc[k - 1:] if len(grams) else np.zeros(0, bool)
    parts, owners = [grams[inside]], [doc[: len(grams)][inside]]
    for length in range(1, k):  # shorter texts: their whole sequence is one shingle
        short = np.flatnonzero(n == length)
        if len(short):
            parts.append(W.ngrams(h, length)[first[:-1][short]] ^ W.U64(length))
            owners.append(short)
    s, d = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    return s[new], d[new]


def sketch(s: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """SetSketch registers (uint16, n x REGISTERS) of n sets given as hashes and owners.

    Every element's values come in rising order, one register each; an element
    stops as soon as its values exceed all of its set's registers.
    """
    least = np.full(n * REGISTERS, np.inf)
    value = np.zeros(len(s))
    place = (W.mix(s ^ W.U64(0xA0761D64)) % W.U64(REGISTERS)).astype(np.int64)
    step = _STEPS[(W.mix(s ^ W.U64(0xE7037ED1)) % W.U64(len(_STEPS))).astype(np.int64)]
    for r in range(REGISTERS):
        u = (W.mix(s + W.U64((r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> W.U64(11)).astype(np.float64)
        value = value - np.log((u + 1.0) * 2.0 ** -53) / (RATE * (REGISTERS - r))
        if r:
            live = value < least.reshape(n, REGISTERS).max(1)[d]
            s, d, value, place, step = s[live], d[live], value[live], place[live], step[live]
            if not len(s):
                break
        np.minimum.at(least, d * REGISTERS + place, value)
        place = (place + step) % REGISTERS
    with np.errstate(divide="ignore"):
        k = np.floor(1.0 - np.log(least) / np.log(BASE))
    return np.clip(k, 0, TOP).astype("<u2").reshape(n, REGISTERS)


def likely_similarity(above: np.ndarray, below: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from counts of larger and smaller registers and set sizes."""
    u, v = na / (na + nb), nb / (na + nb)
    top = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    grid = np.linspace(0.0, 1.0, 101)
    j = grid[None, :] * top[:, None]
    a = np.clip(p(u[:, None] - v[:, None] * j), 1e-12, 1)
    b = np.clip(p(v[:, None] - u[:, None] * j), 1e-12, 1)
    same = (REGISTERS - above - below)[:, None]
    score = above[:, None] * np.log(a) + below[:, None] * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1))
    return j[np.arange(len(j)), score.argmax(1)]


def _signatures(rows: DataFrame, k: int) -> DataFrame:
    """k, tag, n, h1, h2 (hash of the set) and registers of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h1, h2, regs = [], [], [], []
            for p in W.pieces(b.column(2)):
                s, d = shingle_sets(p, k)
                count = np.bincount(d, minlength=p.hi - p.lo)
                sums = np.zeros((2, p.hi - p.lo), W.U64)
                some = np.flatnonzero(count)
                if len(some):
                    at = (np.cumsum(count) - count)[some]
                    for q, salt in enumerate((0x1234567, 0x7654321)):
                        sums[q, some] = np.add.reduceat(W.mix(s ^ W.U64(salt)), at)
                n.append(count), h1.append(sums[0]), h2.append(sums[1])
                regs += [r.tobytes() for r in sketch(s, d, p.hi - p.lo)]
            cat = np.concatenate
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cat(n) if n else [], pa.int64()),
                 *[pa.array(cat(x).view(np.int64) if x else [], pa.int64()) for x in (h1, h2)], pa.array(regs, pa.binary())],
                names=["k", "tag", "n", "h1", "h2", "regs"])

    return rows.mapInArrow(run, "k long, tag long, n long, h1 long, h2 long, regs binary")


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal leading columns, also across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        keys = np.stack([b.column(i).to_numpy() for i in range(n_keys)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), len(b)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(keys[:, i])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _similar_in_band(threshold: float):
    """mapInArrow body: (band, nid, n, regs) sorted by band -> candidate edges (a, b)."""
    floor = threshold - ERRORS * np.sqrt(threshold * (1 - threshold) / REGISTERS)

    def near(regs: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = len(n)
        out = np.eye(m, dtype=bool)
        for lo in range(0, m, 32):
            x = regs[lo: lo + 32, None, :]
            same = (x == regs[None]).sum(2)
            fits = np.minimum(n[lo: lo + 32, None], n) >= threshold * np.maximum(n[lo: lo + 32, None], n)
            i, j = np.nonzero((same >= 0.5 * REGISTERS) & fits)
            i, j = i[i + lo < j], j[i + lo < j]
            if len(i):
                above = (regs[i + lo] > regs[j]).sum(1)
                below = REGISTERS - same[i, j] - above
                ok = likely_similarity(above, below, n[i + lo].astype(float), n[j].astype(float)) >= floor
                out[i[ok] + lo, j[ok]] = out[j[ok], i[ok] + lo] = True
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for t in _groups(batches, 1):
            nid, n = t["nid"].to_numpy(), t["n"].to_numpy()
            regs = np.frombuffer(b"".join(t["regs"].to_pylist()), "<u2").reshape(len(n), REGISTERS)
            if len(n) < 2:
                continue
            link = near(regs, n)
            label = np.arange(len(n))
            while True:
                least = np.where(link, label[None, :], len(n)).min(1)
                if (least == label).all():
                    break
                label = least
            own = label != np.arange(len(n))
            a += nid[own].tolist()
            b += nid[label[own]].tolist()
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def confirm(sets: list[np.ndarray], label: np.ndarray, num: int, den: int, pivots: np.ndarray | None = None) -> np.ndarray:
    """Labels after linking sets with den * intersection >= num * union.

    Pivots (all sets unless given) are compared with every set of another
    label; linked sets take one label.
    """
    m, label = len(sets), label.copy()
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, at = np.unique(flat, return_inverse=True)
    start = np.cumsum(size) - size
    mark = np.zeros(at.max() + 1, bool)
    done = np.zeros(m, bool)
    for p in (np.argsort(-size, kind="stable") if pivots is None else pivots):
        todo = (label != label[p]) & ~done & (den * np.minimum(size, size[p]) >= num * np.maximum(size, size[p]))
        done[p] = pivots is None
        if not todo.any():
            continue
        own = at[start[p]: start[p] + size[p]]
        mark[own] = True
        both = np.add.reduceat(mark[at].astype(np.int32), start)
        mark[own] = False
        linked = todo & (den * both >= num * (size + size[p] - both))
        if linked.any():
            names = np.unique(np.append(label[linked], label[p]))
            label[np.isin(label, names)] = names[0]
    return label


def _sets_of(texts: pa.ChunkedArray, k: int) -> list[np.ndarray]:
    out = []
    for p in W.pieces(texts):
        s, d = shingle_sets(p, k)
        cuts = np.searchsorted(d, np.arange(p.hi - p.lo + 1))
        out += [s[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def _confirm_tiles(k: int, num: int, den: int, n_keys: int):
    """mapInArrow body over groups of (keys, label, pivot, text): links (a, b) of labels.

    Where a group has pivots only they are compared with the others, else all are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for t in _groups(batches, n_keys):
            label = t["label"].to_numpy()
            if len(label) < 2 or (label == label[0]).all():
                continue
            pivots = np.flatnonzero(t["pivot"].to_numpy())
            new = confirm(_sets_of(t["text"], k), label, num, den, pivots if len(pivots) else None)
            moved = new != label
            a += label[moved].tolist()
            b += new[moved].tolist()
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _narrow(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _links(members: DataFrame, shingle: int, num: int, den: int, tile_shingles: int) -> DataFrame:
    """Confirmed links (a, b) between sets, from (nid, cluster, n, text) of all candidate sets.

    A link may join any two sets of the groups it connects.
    """
    weights = members.groupBy("cluster").agg(F.sum("n").alias("weight"))
    members = members.join(weights, "cluster").withColumn("tiles", F.ceil(F.col("weight") / tile_shingles).cast("long"))
    members = members.withColumn("tile", F.pmod(F.xxhash64("nid"), "tiles"))

    def confirmed(rows: DataFrame, *keys: str) -> DataFrame:
        return written(rows.select(*keys, "label", "pivot", "text").repartition(*keys).sortWithinPartitions(*keys, "label")
                       .mapInArrow(_confirm_tiles(shingle, num, den, len(keys)), "a long, b long"), "near-links")

    alone = members.withColumn("label", F.col("nid")).withColumn("pivot", F.lit(False))
    links = confirmed(alone, "cluster", "tile")
    large = members.filter("tiles > 1")
    if large.isEmpty():
        return links

    def labelled() -> DataFrame:
        roots = components(links)
        return written(large.select("nid", "cluster", "tile", "tiles", "n").join(roots, large["nid"] == roots["node"], "left")
                       .select("nid", "cluster", "tile", "tiles", "n", F.coalesce("root", "nid").alias("label")), "near-labels")

    # the main group of each tile against those of the other tiles
    now = labelled()
    main = (now.groupBy("cluster", "tile", "tiles", "label").agg(F.count("*").alias("size")).groupBy("cluster", "tile", "tiles")
            .agg(F.max_by("label", F.struct("size", "label")).alias("nid")))
    main = main.join(members.select("nid", "text"), "nid").select(
        "cluster", F.pmod(F.xxhash64("nid"), F.ceil(F.col("tiles") / 1000)).alias("part"), F.col("nid").alias("label"),
        F.lit(False).alias("pivot"), "text")
    links = links.union(confirmed(main, "cluster", "part"))
    # what is not in its cluster's main group against every tile
    now = labelled()
    best = (now.groupBy("cluster", "label").agg(F.count("*").alias("size")).groupBy("cluster")
            .agg(F.max_by("label", F.struct("size", "label")).alias("best")))
    others = now.join(best, "cluster").filter("label <> best")
    chunks = others.groupBy("cluster").agg(F.ceil(F.sum("n") / tile_shingles).cast("long").alias("chunks"))
    others = others.join(chunks, "cluster").join(members.select("nid", "text"), "nid").select(
        "cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"),
        F.pmod(F.xxhash64("nid"), "chunks").alias("chunk"), "label", F.lit(True).alias("pivot"), "text")
    inside = now.join(chunks, "cluster").join(members.select("nid", "text"), "nid").select(
        "cluster", "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "label",
        F.lit(False).alias("pivot"), "text")
    return links.union(confirmed(others.union(inside), "cluster", "tile", "chunk"))


def groups(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text",
           bucket: int = BUCKET, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """k (the id), tag (a hash of the text), n_shingles, component_id and copies (rows with the same set) of every row."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("tag"),
                       F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")).alias("text"))
    signed = written(_signatures(rows, shingle), "near-signatures")
    distinct = signed.filter("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("k", "tag")).alias("one"), F.min("k").alias("least"), F.max("n").alias("n"),
        F.count("*").alias("copies"), F.max("regs").alias("regs"))
    sets = written(distinct.withColumn("nid", F.monotonically_increasing_id()), "near-sets")

    # sets that share a band
    width = REGISTERS // BANDS * 2
    bands = sets.select("nid", F.explode(F.array(*[
        F.xxhash64(F.substring("regs", i * width + 1, width), F.lit(i)) for i in range(BANDS)])).alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.min("nid").alias("first")).filter("members > 1")
    shared = written(bands.join(shared, "band"), "near-bands")
    large = shared.filter(F.col("members") > bucket).select(F.col("nid").alias("a"), F.col("first").alias("b"))
    compared = shared.filter(F.col("members") <= bucket).select("band", "nid").join(sets.select("nid", "n", "regs"), "nid")
    near = (compared.select("band", "nid", "n", "regs").repartition("band").sortWithinPartitions("band", "nid")
            .mapInArrow(_similar_in_band(num / den), "a long, b long"))
    clusters = components(large.union(near))

    # one text of each candidate set
    wanted = written(clusters.join(sets.select(F.col("nid").alias("node"), "one", "n"), "node").select(
        F.col("node").alias("nid"), F.col("root").alias("cluster"), "n", F.col("one.k").alias("wk"), F.col("one.tag").alias("wt")), "near-wanted")
    texts = rows.join(_narrow(wanted), rows["k"].eqNullSafe(F.col("wk")) & (rows["tag"] == F.col("wt"))).select("nid", "cluster", "n", "text")
    texts = written(texts.dropDuplicates(["nid"]), "near-texts")
    roots = components(_links(texts, shingle, num, den, tile_shingles))

    # groups of more than one row, by set
    linked = sets.select("nid", "h1", "h2", "least", "copies").join(roots, F.col("nid") == F.col("node"), "left")
    linked = linked.filter(F.col("root").isNotNull() | (F.col("copies") > 1)).withColumn("root", F.coalesce("root", "nid"))
    ids = linked.groupBy("root").agg(F.min("least").alias("component"))
    known = written(linked.join(ids, "root").select("h1", "h2", "component", "copies"), "near-groups")
    return signed.select("k", "tag", "n", "h1", "h2").join(_narrow(known), ["h1", "h2"], "left").select(
        "k", "tag", F.col("n").alias("n_shingles"), F.coalesce("component", "k").alias("component_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"))


def keep_one(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the documents of a group but its smallest id (of repeated rows, one)."""
    found = groups(docs, shingle, num, den)
    kept = F.col("k").eqNullSafe(F.col("component_id"))
    k, tag, row = free_names(docs, "_k", "_tag", "_row")
    special = written(found.filter(~kept | (F.col("copies") > 1)).select(
        F.col("k").alias("sk"), F.col("tag").alias("st"), kept.alias("stays")).distinct(), "near-decisions")
    rows = docs.select(F.col("doc_id").cast("long").alias(k), F.xxhash64("text").alias(tag), F.struct(*[F.col(c) for c in docs.columns]).alias(row))
    joined = rows.join(_narrow(special), rows[k].eqNullSafe(F.col("sk")) & (rows[tag] == F.col("st")), "left").select(k, tag, row, "stays")
    out = joined.filter(F.col("stays").isNull()).unionByName(joined.filter("stays").dropDuplicates([k, tag]))
    return out.select(*[F.col(row)[c].alias(c) for c in docs.columns])


def op3(docs: DataFrame) -> DataFrame:
    found = groups(docs, shingle=3, num=85, den=100)
    return found.select(F.col("k").alias("doc_id"), "n_shingles", "component_id",
                        F.col("k").eqNullSafe(F.col("component_id")).alias("kept"))
