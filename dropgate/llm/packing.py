"""Packing of tokenised documents into windows of a fixed length.

A document is its token ids and an end id. Overlong ones are first cut into
full windows; what is left goes to open windows by best-fit decreasing: pieces
in order of falling length, each into the open window with the least room that
still holds it. A segment tree indexed by remaining room finds that window in
O(log window) steps.

The pieces are dealt by a hash over groups of a bounded number of ids, one
task each, so neither a source nor a long document makes a large group; a
group's last windows are the only loss against packing all pieces at once.

Defined results: a null or empty text is just the end id. Repeated rows are
packed each. Very long texts give many pieces, which spread over the groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm import bpe

GROUP_IDS = 8_000_000  # ids of a packing group, at most
GROUP_IDS_HELD = 1_000_000  # where the group's task holds the ids themselves, several times over


class RoomTree:
    """How many open windows have each amount of room; finds the least room >= need."""

    def __init__(self, window: int):
        self.size = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, need: int) -> int:
        """The least room of an open window that holds ``need``, or -1."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:  # a right neighbour holds larger rooms
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, for lengths in falling order."""
    tree, open_by_room = RoomTree(window), [[] for _ in range(window + 1)]
    where, offset, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, need in enumerate(lengths.tolist()):
        room = tree.tightest(need)
        if room < 0:
            w, room, n = n, window, n + 1
        else:
            w = open_by_room[room].pop()
            tree.add(room, -1)
        where[k], offset[k] = w, window - room
        if room > need:
            open_by_room[room - need].append(w)
            tree.add(room - need, 1)
    return where, offset


def pieces(docs: DataFrame, path: str, window: int, end_id: int, groups: int, ids: bool, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Documents as pieces of at most ``window`` ids, each with its packing group."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        end = np.array([end_id], "<u4")
        for b in batches:
            for lo in range(0, len(b), 512):
                part, of, rows = b.slice(lo, 512), [], []
                for k, t in enumerate(part.column(1).to_pylist()):
                    doc = np.concatenate([enc.ids(t), end]).astype("<u4", copy=False)
                    for s in range(0, len(doc), window):
                        raw = doc[s: s + window].tobytes()
                        of.append(k)
                        rows.append((s, len(raw) // 4, zlib.crc32(raw), len(doc), raw if ids else b""))
                start, length, crc, total, raw = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(of)), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)],
                     pa.array(raw, pa.binary())], names=["key", "start", "length", "crc", "total", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cutted = rows.mapInArrow(cut, f"key {kind}, start long, length long, crc long, total long, ids binary")
    dealt = cutted.withColumn("hash", F.xxhash64("key", "start", "crc"))
    return dealt.withColumn("group", F.pmod("hash", F.lit(groups)))


def groups_for(docs: DataFrame, text: str = "text", group_ids: int = GROUP_IDS) -> int:
    """Enough groups that each has about half of ``group_ids`` ids (a text has at most one id per byte, mostly one per four)."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1)).first()[0] or 0
    return max(1, -(-int(total) // (2 * group_ids)))


def _placed(t: pa.Table, window: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A group's pieces by falling length, with window number and offset of each."""
    order = np.lexsort((t["hash"].to_numpy(), -t["length"].to_numpy()))  # the same order in every run
    t = t.take(pa.array(order))
    return t, *best_fit_decreasing(t["length"].to_numpy(), window)


def pack(docs: DataFrame, path: str, window: int = 1024, end_id: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces with their place: key, start, length, crc, total, sequence_id, offset."""
    kind = docs.schema[key].dataType.simpleString()
    cutted = pieces(docs, path, window, end_id, groups_for(docs, text), False, text, key)

    def place(group: tuple, t: pa.Table) -> pa.Table:
        t, where, offset = _placed(t, window)
        base = group[0].as_py() << 32
        return (t.drop_columns(["ids", "hash", "group"]).append_column("sequence_id", pa.array(where + base))
                .append_column("offset", pa.array(offset)))

    return cutted.groupBy("group").applyInArrow(
        place, f"key {kind}, start long, length long, crc long, total long, sequence_id long, offset long")


def sequences(docs: DataFrame, path: str, window: int = 1024, end_id: int = 0, pad_id: int = 0, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """One row per packed window: its ids (padded to ``window`` unless their number is a
    power of two), how many are real, and which documents lie where.

    A group's task places its pieces and puts their ids together, so the ids are
    shuffled once.
    """
    kind = docs.schema[key].dataType.simpleString()
    cutted = pieces(docs, path, window, end_id, groups_for(docs, text, GROUP_IDS_HELD), True, text, key)

    def join(group: tuple, t: pa.Table) -> pa.Table:
        t, where, offset = _placed(t, window)
        order = np.lexsort((offset, where))
        t, where, offset = t.take(pa.array(order)), where[order], offset[order]
        length = t["length"].to_numpy()
        first = np.flatnonzero(np.diff(where, prepend=-1))
        n_ids = np.add.reduceat(length, first) if len(first) else np.zeros(0, np.int64)
        size = np.where(n_ids & (n_ids - 1) == 0, n_ids, window)
        raw, full = t["ids"].to_pylist(), np.full(size.sum(), pad_id, np.int32)
        upto = np.append(first[1:], len(t))
        for at, n, lo, hi in zip((np.cumsum(size) - size).tolist(), n_ids.tolist(), first.tolist(), upto.tolist(), strict=True):
            full[at: at + n] = np.frombuffer(b"".join(raw[lo:hi]), "<u4")
        cuts = np.append(0, np.cumsum(size)).astype(np.int32)
        keys = t["key"].combine_chunks()
        parts = pa.StructArray.from_arrays([keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys,
                                            *[pa.array(x, pa.int64()) for x in (t["start"].to_numpy(), offset, length)]],
                                           names=["doc_id", "start", "offset", "length"])
        return pa.table({"sequence_id": pa.array(where[first] + (group[0].as_py() << 32)),
                         "tokens": pa.ListArray.from_arrays(pa.array(cuts), pa.array(full)),
                         "n_tokens": pa.array(n_ids, pa.int64()),
                         "pieces": pa.ListArray.from_arrays(pa.array(np.append(first, len(t)).astype(np.int32)), parts)})

    return cutted.groupBy("group").applyInArrow(
        join, "sequence_id long, tokens array<int>, n_tokens long, "
              f"pieces array<struct<doc_id:{kind},start:bigint,offset:bigint,length:bigint>>")


def op8(docs: DataFrame, path: str) -> DataFrame:
    return pack(docs, path).select(
        F.col("key").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"), "sequence_id", "offset")
