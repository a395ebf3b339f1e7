"""Parallel scan of quoted CSV files: records, their numbers and byte offsets.

Spark splits a text file at line breaks, but a quoted value may hold line
breaks, so a range of lines cannot tell alone where its first record starts.
Two passes settle it exactly:

1. Every range of lines is read from both possible states, outside and inside
   a quoted value, and reports for each the state it ends in and how many
   records start in it. A quote opens a value only at the start of a field,
   doubled quotes inside stand for one, and whatever follows the closing quote
   belongs to the field up to the next separator, as in Spark's CSV parser.
   The two states mostly become one at the first quoted line, so this costs
   one look at each line with a quote.
2. Folding the reports of a file's ranges in order gives each range's true
   state, its first record's number and its byte offset. With them every range
   is cut into records on its own. A record that goes on in the next range is
   put together from its pieces.

Both passes must see the same ranges. Their size must therefore not follow from
the set of files or the cores at hand: ``fixed_ranges`` sets that for the
session, and keeps them small: a MB of short records takes a third of a second. A second pass that meets a range it has no state for stops with an
error; it never guesses.

A file with a quote that is never closed is known after the first pass, with
the record and the offset where it opens. Record 0 is the header; empty lines
outside of quotes are no records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.session import scratch_path

PATH, START, NUMBER, OFFSET, TEXT = "path", "start", "number", "offset", "text"

# Range tables up to this many rows (about 100 bytes each) are broadcast.
MAX_BROADCAST_RANGES = 500_000

_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
_CLOSE = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')


# Ranges are at most this long: records are parsed row by row, and a task is to take seconds.
MAX_RANGE_BYTES = 8 << 20


def _bytes(size: str) -> int:
    """The bytes of a Spark size setting, such as 134217728b, 32m or 1g."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


def fixed_ranges(spark: SparkSession) -> None:
    """Ranges end at multiples of ``spark.sql.files.maxPartitionBytes``, ``MAX_RANGE_BYTES`` at most, whichever files are read together."""
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    if _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) > MAX_RANGE_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(MAX_RANGE_BYTES))


def escape_glob(path: str) -> str:
    """``path`` as a pattern that matches only itself (Spark reads paths as globs)."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a quoted value is open after ``line``, given whether one was before it."""
    at = 0
    if not inside:
        if not line.startswith(b'"'):
            at = line.find(sep + b'"')
            if at < 0:
                return False
            at += len(sep)
        at += 1
    while True:
        closed = _CLOSE.match(line, at)
        if closed is None:
            return True
        at = line.find(sep + b'"', closed.end())
        if at < 0:
            return False
        at += len(sep) + 1


def _lines(spark: SparkSession, paths: list[str], **options: str) -> DataFrame:
    """Lines of the files with the file and the start of the range they are in, in order within a range."""
    return spark.read.options(**options).option("lineSep", "\n").text([escape_glob(p) for p in paths]).select(
        F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias(START), F.col("value").cast("binary").alias("line"))


@dataclass
class _Batch:
    """The lines of one range that came in one batch."""

    lines: pa.Array
    size: np.ndarray    # bytes of each line without its line break
    quoted: np.ndarray  # lines with a quote
    filled: np.ndarray  # whether a line is not empty

    @classmethod
    def of(cls, lines: pa.Array, quotes: bool) -> "_Batch":
        _, offs, data = lines.buffers()
        off = np.frombuffer(offs, np.int32)[lines.offset: lines.offset + len(lines) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
        size = np.diff(off)
        at = np.flatnonzero(raw == 0x22) if quotes else np.zeros(0, np.int64)
        quoted = np.unique(np.searchsorted(off - off[0], at, side="right") - 1)
        first = raw[np.minimum(off[:-1] - off[0], max(len(raw) - 1, 0))] if len(raw) else np.zeros(len(size), np.uint8)
        return cls(lines, size, quoted, (size > 1) | ((size == 1) & (first != 0x0D)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(number of the range in this task, rows): batches cut where the range changes."""
    before, number = None, -1
    for b in batches:
        if not len(b):
            continue
        path, start = b.column(0).dictionary_encode().indices.to_numpy(), b.column(1).to_numpy()
        cuts = np.flatnonzero((path[1:] != path[:-1]) | (start[1:] != start[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)], strict=True):
            key = (b.column(0)[lo].as_py(), b.column(1)[lo].as_py())
            number += key != before
            before = key
            yield number, b.slice(lo, hi - lo)


class _Reading:
    """One state's way through a range: records started, and where the open one started."""

    def __init__(self, inside: bool):
        self.inside, self.records = inside, 0
        self.open_record, self.open_offset = (-1, -1) if inside else (None, None)  # -1: before this range

    def plain(self, many: int) -> None:
        self.records += 0 if self.inside else many

    def quoted(self, line: bytes, offset: int, sep: bytes) -> None:
        before, self.inside = self.inside, ends_inside(line, self.inside, sep)
        if not before:
            if self.inside:
                self.open_record, self.open_offset = self.records, offset
            self.records += 1


RANGE_SCHEMA = ("path string, start long, n_lines long, bytes long, header binary, in0 boolean, records0 long, record0 long, offset0 long, "
                "in1 boolean, records1 long, record1 long, offset1 long")


class _Range:
    """A range's report in the making: read from both states."""

    def __init__(self, path: str, start: int):
        self.path, self.start, self.lines, self.size = path, start, 0, 0
        self.header, self.header_done = [], False
        self.ways = _Reading(False), _Reading(True)

    def feed(self, lines: pa.Array, sep: bytes, quotes: bool) -> None:
        x = _Batch.of(lines, quotes)
        if self.start == 0 and not self.header_done:
            self._read_header(lines, x, sep, quotes)
        offsets, filled, done = self.size + np.cumsum(x.size + 1) - x.size - 1, np.append(0, np.cumsum(x.filled)), 0
        for q in x.quoted.tolist():
            for w in self.ways:
                w.plain(int(filled[q] - filled[done]))
                w.quoted(lines[q].as_py(), int(offsets[q]), sep)
            done = q + 1
        for w in self.ways:
            w.plain(int(filled[-1] - filled[done]))
        self.lines += len(lines)
        self.size += int(x.size.sum()) + len(lines)

    def _read_header(self, lines: pa.Array, x: _Batch, sep: bytes, quotes: bool) -> None:
        """The file's first record."""
        inside = bool(self.header)
        for k in range(len(lines)):
            if inside or x.filled[k]:
                self.header.append(lines[k].as_py())
                inside = quotes and ends_inside(self.header[-1], inside, sep)
                if not inside:
                    self.header_done = True
                    return

    def row(self) -> list:
        return [self.path, self.start, self.lines, self.size, b"\n".join(self.header) if self.header_done else None,
                *(v for w in self.ways for v in (w.inside, w.records, w.open_record, w.open_offset))]


def _report(sep: bytes, quotes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = -1, []
        for number, b in _runs(batches):
            if number != at:
                at = number
                out.append(_Range(b.column(0)[0].as_py(), b.column(1)[0].as_py()))
            out[-1].feed(b.column(2), sep, quotes)
        rows, names = [r.row() for r in out], [f.split() for f in RANGE_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS[t]) for k, (_, t) in enumerate(names)], names=[n for n, _ in names])

    return run


START_SCHEMA = ("path string, start long, inside boolean, number long, offset long, n_ranges long, spans boolean, n_bytes long, header binary, "
                "n_records long, open_record long, open_offset long")


def _fold(table: pa.Table) -> pa.Table:
    """The true state at the start of each range of one file; the file's own facts stand at its first range."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    inside, number, offset, opened, out = False, 0, 0, (None, None), []
    for r in rows:
        k = "1" if inside else "0"
        out.append({"path": r["path"], "start": r["start"], "inside": inside, "number": number, "offset": offset})
        if r["in" + k] and r["offset" + k] != -1:
            opened = number + r["record" + k], offset + r["offset" + k]
        inside, number, offset = r["in" + k], number + r["records" + k], offset + r["bytes"]
    out[0] |= {"n_ranges": len(rows), "spans": any(r["inside"] for r in out), "n_bytes": offset, "header": rows[0]["header"], "n_records": number,
               "open_record": opened[0] if inside else None, "open_offset": opened[1] if inside else None}
    names = [f.split() for f in START_SCHEMA.split(", ")]
    return pa.Table.from_arrays([pa.array([r.get(n) for r in out], _KINDS[t]) for n, t in names], names=[n for n, _ in names])


def range_starts(spark: SparkSession, paths: list[str], sep: str, quotes: bool = True) -> DataFrame:
    """First pass, written: per range its state, first record's number and offset; per file (at its first
    range) its header, number of records (header included) and, if a quote stays open, where."""
    # a file that cannot be read (whole) shows in its number of bytes, and only it fails
    reports = _lines(spark, paths, ignoreCorruptFiles="true", ignoreMissingFiles="true").mapInArrow(_report(sep.encode(), quotes), RANGE_SCHEMA)
    out = scratch_path(spark, "csv-ranges")
    reports.groupBy(PATH).applyInArrow(_fold, START_SCHEMA).write.parquet(out)
    return spark.read.schema(START_SCHEMA).parquet(out)


class _Cutter:
    """Cuts the lines of one range, batch by batch, into records."""

    def __init__(self, sep: bytes, quotes: bool):
        self.sep, self.quotes = sep, quotes

    def enter(self, inside: bool, number: int, offset: int) -> None:
        self.inside, self.number, self.offset, self.held = inside, number, offset, []
        # number and offset of the open record; one that came in from the range before has no offset here
        self.mark = (number - 1, None) if inside else None

    def feed(self, lines: pa.Array):
        """(mask of lines that are records, numbers, offsets) by line, and the closed records of several lines."""
        x = _Batch.of(lines, self.quotes)
        offsets = self.offset + np.cumsum(x.size + 1) - x.size - 1
        single, first = x.filled.copy(), x.filled.copy()
        closed, opened, done = [], None, 0
        for q in [*x.quoted.tolist(), len(lines)]:
            if self.inside:
                single[done:q] = first[done:q] = False
                self.held += lines.slice(done, q - done).to_pylist()
            if q == len(lines):
                break
            line = lines[q].as_py()
            after = ends_inside(line, self.inside, self.sep)
            if self.inside or after:
                single[q], first[q] = False, not self.inside
                if not self.inside:
                    opened = q
                self.held.append(line)
                if not after:
                    closed.append((opened, self.mark, b"\n".join(self.held)))
                    self.held, self.mark, opened = [], None, None
            self.inside, done = after, q + 1
        numbers = self.number + np.cumsum(first) - 1
        if opened is not None:
            self.mark = int(numbers[opened]), int(offsets[opened])
        self.number, self.offset = self.number + int(first.sum()), int(offsets[-1] + x.size[-1] + 1)
        return single, numbers, offsets, [(*(m if k is None else (int(numbers[k]), int(offsets[k]))), t) for k, m, t in closed]


RECORD_SCHEMA = "path string, number long, offset long, piece long, text binary"


def _rows(path: str, number, offset, piece, text) -> pa.RecordBatch:
    n = len(text)
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(path, pa.string()), n), pa.array(number, pa.int64()), pa.array(offset, pa.int64()),
                                       pa.repeat(pa.scalar(piece, pa.int64()), n), text if isinstance(text, pa.Array) else pa.array(text, pa.binary())], names=names)


def _cut(sep: bytes, quotes: bool, pieces: bool):
    """The records that lie whole in a range, or the pieces of those that do not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, key, cutter = -1, (None, None), _Cutter(sep, quotes)

        def rest():
            if pieces and at >= 0 and cutter.held:  # goes on in the next range
                yield _rows(key[0], [cutter.mark[0]], [cutter.mark[1]], key[1], [b"\n".join(cutter.held)])

        for number, b in _runs(batches):
            if number != at:
                yield from rest()
                at, key = number, (b.column(0)[0].as_py(), b.column(1)[0].as_py())
                inside, first, offset = (b.column(k)[0].as_py() for k in (3, 4, 5))
                if inside is None:
                    raise RuntimeError(f"no state is known for the range of {key[0]} at byte {key[1]}: "
                                       "spark.sql.files.maxPartitionBytes or minPartitionNum has changed since the file was scanned")
                cutter.enter(inside, first, offset)
            single, numbers, offsets, closed = cutter.feed(b.column(2))
            if not pieces:
                lone = np.flatnonzero(single)
                yield _rows(key[0], numbers[lone], offsets[lone], None, b.column(2) if len(lone) == len(b) else b.column(2).take(pa.array(lone)))
            mine = [c for c in closed if (c[1] is None) == pieces]
            if mine:
                yield _rows(key[0], [c[0] for c in mine], [c[1] for c in mine], key[1], [c[2] for c in mine])
        yield from rest()

    return run


def records(spark: SparkSession, paths: list[str], starts: DataFrame, n_ranges: int, spanning: list[str], sep: str, quotes: bool = True) -> DataFrame:
    """Second pass: path, number, offset and text of every record; ``spanning``: the files in which some reach over ranges."""
    state = starts.select(PATH, START, "inside", NUMBER, OFFSET)

    def cut(some: list[str], pieces: bool) -> DataFrame:
        rows = _lines(spark, some)
        if n_ranges <= MAX_BROADCAST_RANGES:  # the stream's side keeps its order
            rows = rows.join(F.broadcast(state), [PATH, START], "left")
        else:
            order = F.monotonically_increasing_id().alias("order")
            rows = rows.select("*", order).join(state, [PATH, START], "left").repartition(PATH, START).sortWithinPartitions(PATH, START, "order")
        return rows.select(PATH, START, "line", "inside", NUMBER, OFFSET).mapInArrow(_cut(sep.encode(), quotes, pieces), RECORD_SCHEMA)

    out = cut(paths, False).select(PATH, NUMBER, OFFSET, F.col("text").cast("string").alias(TEXT))
    if spanning:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"].cast("string"))
        out = out.union(cut(spanning, True).groupBy(PATH, NUMBER).agg(F.max(OFFSET).alias(OFFSET), F.array_join(ordered, "\n").alias(TEXT)))
    return out
