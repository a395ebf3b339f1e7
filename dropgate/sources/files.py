"""Reading a drop of files as ONE dataset with a ``_source_file`` column.

* ``list_files``: a listing through the Hadoop FileSystem API on the driver, as
  Spark's own file index makes one; no file content is read. Empty files are
  listed too (they have no rows to show up anywhere else).
* CSV files may have different headers (or the same columns in a different
  order). Reading them in one ``spark.read.csv`` would misalign columns by
  position, so a first pass in tasks (``csvscan``) gives every file's header
  record, files are grouped by header, each group is read with an explicit
  all-string schema and the groups are combined with ``unionByName``. Quotes are
  doubled inside quoted values; quoted values and headers may hold separators
  and line breaks, and Spark splits large files all the same (``multiline``
  off states that no value has a line break; quotes are then not looked at).
  Every row carries its record number and byte offset in its file; a quote
  that is never closed is a read error that names both.
* Parquet files are grouped by their schema; where groups disagree on a
  column's type, the union holds that column as text.
* A file that cannot be read, or that has duplicate or reserved column names,
  carries the reason as ``error`` and stays out of the read: only it fails.
* Raw CSV values stay strings; typing is an explicit, checked step
  (``typed``) so a bad value is a finding instead of depending on which rows
  a type inference happened to sample.
* Every file keeps its own column list (``files.__columns``), so schema checks
  are decided per file even though the rows are one DataFrame.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.functions.names import col
from dropgate.operators.joins import HIDDEN
from dropgate.sources import csvscan

SOURCE = "_source_file"
COLUMNS = "__columns"
CORRUPT = f"{HIDDEN}corrupt"
RECORD = f"{HIDDEN}record"  # number of a row in its file, from 1
OFFSET = f"{HIDDEN}offset"  # byte at which a CSV record starts

# How the library reads named CSV tables and writes CSV: quotes doubled, values as they are.
CSV_READ = {"header": "true", "escape": '"', "multiLine": "true"}
CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# File suffix -> reader format.
FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}


@dataclass
class FileInfo:
    """Driver-side metadata of one input file (bytes per file, like Spark's file index)."""

    source: str
    path: str | None = None
    size: int | None = None
    columns: list[str] | None = None
    format: str | None = None
    error: str | None = None  # why the file cannot be read (S5), if it cannot
    url: str | None = None  # the path as Spark's file metadata gives it (escaped), without the scheme
    rows: int | None = None  # records after the header, where a scan counted them


def files_frame(spark: SparkSession, infos: list[FileInfo]) -> DataFrame:
    """The file table as a local relation: ``_source_file, path, size, __columns``."""
    return spark.createDataFrame(
        [(f.source, f.path, f.size, list(f.columns or [])) for f in infos],
        f"{SOURCE} string, path string, size long, {COLUMNS} array<string>")


@dataclass
class Dataset:
    """Rows of all files of one dataset + one row per file.

    ``df`` carries ``_source_file`` (path relative to the drop root).
    ``files`` has ``_source_file``, ``__columns`` (array<string>) and ``size``.
    """

    df: DataFrame
    files: DataFrame
    name: str = ""
    key: str = SOURCE
    # rows of the given source files only, reading nothing else
    reader: Callable[[list[str]], DataFrame] | None = None
    # the same file table on the driver (one entry per file)
    infos: list[FileInfo] | None = None

    def rows_of(self, sources: list[str]) -> DataFrame:
        """Rows of ``sources`` only. With a reader only their files are scanned."""
        if self.reader is not None:
            return self.reader(sources)
        return self.df.filter(col(self.key).isin(list(sources)))


def _empty_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(SOURCE, T.StringType())]))


def union_by_name(frames: list[DataFrame], spark: SparkSession) -> DataFrame:
    """Union by column name, case ignored (the first spelling stays); a column whose
    types in the frames have no common lossless one becomes text."""
    kinds: dict[str, list] = {}
    for f in frames:
        for field in f.schema.fields:
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    to = {c: t for c, k in kinds.items() if any(x != k[0] for x in k) for t in [common_type(k)]}
    out = None
    for f in frames:
        cast = {c: _as_text(f, c) if to[c.lower()] is None else col(c).cast(to[c.lower()]) for c in f.columns if c.lower() in to}
        f = f.withColumns(cast) if cast else f
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out if out is not None else _empty_rows(spark)


# Bits of whole numbers; digits of the largest value of each type.
_WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _two_types(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds every value of ``a`` and of ``b`` unchanged."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for x, y in ((a, b), (b, a)):
        kx, ky = type(x), type(y)
        if kx in _WHOLE_BITS and ky in _WHOLE_BITS:
            return x if _WHOLE_BITS[kx] >= _WHOLE_BITS[ky] else y
        if kx in _WHOLE_BITS and (ky is T.DoubleType and _WHOLE_BITS[kx] <= 32 or ky is T.FloatType and _WHOLE_BITS[kx] <= 16):
            return y
        if kx is T.FloatType and ky is T.DoubleType:
            return y
        if kx in _WHOLE_DIGITS and ky is T.DecimalType:
            x = T.DecimalType(_WHOLE_DIGITS[kx], 0)
        if type(x) is T.DecimalType and ky is T.DecimalType:
            scale = max(x.scale, y.scale)
            digits = max(x.precision - x.scale, y.precision - y.scale) + scale
            return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def common_type(kinds: list[T.DataType]) -> T.DataType | None:
    """The least type that holds every value of all ``kinds`` unchanged; None where only text does."""
    out = kinds[0]
    for k in kinds[1:]:
        out = _two_types(out, k)
        if out is None:
            return None
    return out


def _as_text(df: DataFrame, c: str) -> Column:
    nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(col(c)) if nested else col(c).cast("string")


def column_names_error(names: list[str]) -> str | None:
    """Why a file with these columns cannot be read, if so (names are compared as Spark does)."""
    seen: set[str] = set()
    for n in names:
        low = n.lower()
        if low in seen:
            return f"column name '{n}' occurs more than once"
        if low.startswith(HIDDEN) or low == SOURCE:
            return f"column name '{n}' is reserved"
        seen.add(low)
    return None


def _strip_scheme(path: str) -> str:
    p = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", path)
    p = re.sub(r"^/+", "/", p)
    return p.rstrip("/")


def _rel_regex(root: str) -> str:
    r = re.escape(_strip_scheme(root))
    return rf"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?/*{r.lstrip('/')}/(.*)$"


def relative_name(path: str, root: str) -> str:
    """Driver-side twin of ``relative_path`` for one path string."""
    m = re.match(_rel_regex(root), path)
    return m.group(1) if m else ""


def relative_path(path: Column, root: str, prefix: str | None = None) -> Column:
    """Relative name below ``root`` of a path from Spark's file metadata.

    Such paths are escaped as in URIs; the escapes are resolved once here.
    With ``prefix`` (the literal text before the relative part, as the file
    listing shows it) a plain ``substring`` does the work per row; the regex
    is only the fallback for paths that do not start with it.
    """
    # a plus sign stands for itself in a path
    path = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    rx = F.regexp_extract(path, _rel_regex(root), 1)
    if not prefix:
        return rx
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(rx)


def common_prefix(infos: list["FileInfo"]) -> str | None:
    """The listing-path text before the relative name, if all files share it."""
    prefixes = {f.path[: len(f.path) - len(f.source)] for f in infos if f.path and f.path.endswith(f.source)}
    return prefixes.pop() if len(prefixes) == 1 else None


def list_file_infos(spark: SparkSession, root: str, glob: str | None = None,
                    recursive: bool = True) -> list[FileInfo]:
    """Every file under ``root`` with its relative name, size and format.

    Listed through the Hadoop FileSystem API, as Spark's own file index
    does, so zero-length files are included (file sources make no split for
    them, so they would never show up as rows). Hidden files and folders
    (``_*``, ``.*``) are skipped like Spark does.
    """
    import fnmatch as _fn

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    out: list[FileInfo] = []
    if not fs.exists(base):
        return out
    it = fs.listFiles(base, recursive)
    while it.hasNext():
        st = it.next()
        path = str(st.getPath().toString())
        rel = relative_name(path, root)
        # Spark's rule: hidden unless a "_" name is a partition folder (k=v)
        if any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in rel.split("/")):
            continue
        if glob and not _fn.fnmatch(rel.rsplit("/", 1)[-1], glob):
            continue
        m = re.search(r"(\.[^./]+)$", path)
        fmt = FORMATS.get(m.group(1).lower()) if m else None
        out.append(FileInfo(source=rel, path=path, size=int(st.getLen()), format=fmt, url=_strip_scheme(str(st.getPath().toUri().toString()))))
    return sorted(out, key=lambda f: f.source)


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """``_source_file, path, size, format`` for every file under root (local relation)."""
    infos = list_file_infos(spark, root, glob, recursive)
    return spark.createDataFrame([(f.source, f.path, f.size, f.format) for f in infos],
                                 f"{SOURCE} string, path string, size long, format string")


HEADER_THREADS = 16


def header_names(record: str | None, sep: str) -> list[str] | None:
    """Column names of a CSV header record (byte order mark removed, quotes resolved)."""
    import csv
    import io

    if record is None:
        return None
    csv.field_size_limit(max(csv.field_size_limit(), len(record) + 1))  # a name may be as long as its record
    return next(csv.reader(io.StringIO(record.lstrip("\ufeff"), newline=""), delimiter=sep, quotechar='"', doublequote=True), [""])


def _safe_call(fn, *args):
    try:
        return fn(*args), None
    except Exception as e:  # noqa: BLE001 - reported as the file's read error
        return None, f"cannot read file: {e}"


# The 4-byte marker at both ends of every Parquet file.
PARQUET_MAGIC = b"PAR1"


def _parquet_columns(spark: SparkSession, path: str, size: int) -> list[tuple[str, str]] | None:
    """Top-level column names and types from a Parquet file's footer; None if not Parquet.

    Reads the magic bytes and the footer only (a few KB), through the Hadoop
    FileSystem API; pyarrow parses the footer's schema on the driver.
    """
    import struct

    import pyarrow as pa
    import pyarrow.parquet as pq

    if size < 12:
        return None
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(sc._jsc.hadoopConfiguration()).open(p)

    def read_at(pos: int, n: int) -> bytes:
        stream.seek(pos)
        return bytes(stream.readNBytes(n))

    try:
        if read_at(0, 4) != PARQUET_MAGIC:
            return None
        tail = read_at(size - 8, 8)
        if tail[4:] != PARQUET_MAGIC:
            return None
        (n,) = struct.unpack("<I", tail[:4])
        if n <= 0 or n > size - 12:
            return None
        footer = read_at(size - 8 - n, n)
    finally:
        stream.close()
    meta = pq.ParquetFile(pa.BufferReader(PARQUET_MAGIC + footer + tail))
    return [(f.name, str(f.type)) for f in meta.schema_arrow]


def parquet_schemas(spark: SparkSession, infos: list[FileInfo]) -> dict[str, tuple]:
    """path -> (columns and their types, error) for Parquet files, from their footers."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=HEADER_THREADS) as pool:
        res = list(pool.map(lambda f: _safe_call(_parquet_columns, spark, f.path, f.size or 0), infos))
    out = {}
    for f, (cols, err) in zip(infos, res):
        if cols is None and err is None:
            err = "cannot read file: not a Parquet file"
        out[f.path] = (cols, err or column_names_error([c for c, _ in cols]))
    return out


# Fixed value: bytes of the UTF-8 byte order mark, which Spark's line reader leaves out.
BYTE_ORDER_MARK = 3


def _skipped(f: FileInfo, facts) -> int:
    """Bytes before the first line that a scan saw."""
    return BYTE_ORDER_MARK if facts["n_bytes"] < f.size else 0


def _csv_facts(f: FileInfo, facts, sep: str) -> FileInfo:
    """What the scan found out about a CSV file."""
    out = FileInfo(f.source, f.path, f.size, [], f.format, url=f.url, rows=0)
    if not f.size:
        return out
    if facts is None or facts["n_bytes"] < f.size - BYTE_ORDER_MARK:
        out.error = f"cannot read file: {facts['n_bytes'] if facts else 0} of {f.size} bytes were read"
        return out
    if facts["open_offset"] is not None:
        at = facts["open_offset"] + _skipped(f, facts)
        out.error = f"a quote is never closed: in record {facts['open_record']}, which starts at byte {at}"
        out.rows = None
    if facts["header"] is not None:
        names, error = _safe_call(header_names, facts["header"].rstrip(b"\r").decode("utf-8", "replace"), sep)
        out.columns, out.rows = list(names or []), facts["n_records"] - 1 if out.rows is not None else None
        out.error = out.error or error or column_names_error(out.columns)
    return out


def read_csv_files(spark: SparkSession, root: str, infos: list[FileInfo], sep: str = ";",
                   keep_corrupt: bool = True, multiline: bool = True) -> Dataset:
    """Read the CSV files of ``infos`` as one Dataset.

    Files are grouped by header and every group is read with its own
    all-string schema, so columns are matched by name, never by position. Rows
    carry their record number and byte offset (``RECORD``, ``OFFSET``); with
    ``keep_corrupt`` the text of a record with the wrong number of fields
    (``CORRUPT``). ``Dataset.rows_of`` re-reads only the requested files.
    """
    csv = [f for f in infos if f.format == "csv"]
    filled = [f for f in csv if f.size]
    starts, facts = None, {}
    if filled:
        csvscan.fixed_ranges(spark)
        starts = csvscan.range_starts(spark, [f.path for f in filled], sep, multiline)
        facts = {_strip_scheme(r["path"]): r for r in starts.filter(F.col("n_ranges").isNotNull()).collect()}  # one row per file
    out_infos = [_csv_facts(f, facts.get(f.url), sep) for f in csv]
    groups: dict[tuple, list[FileInfo]] = {}
    for f in out_infos:
        if f.columns and not f.error:
            groups.setdefault(tuple(f.columns), []).append(f)
    prefix = common_prefix(csv)

    def read_group(header: tuple, some: list[FileInfo]) -> DataFrame:
        n_ranges = sum(facts[f.url]["n_ranges"] for f in some)
        spanning = [f.path for f in some if facts[f.url]["spans"]]
        rows = csvscan.records(spark, [f.path for f in some], starts, n_ranges, spanning, sep, multiline).filter("number > 0")
        # neutral names while parsing: a header may hold any character
        kinds = ", ".join([*(f"c{k} string" for k in range(len(header))), "bad string"])
        text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
        parsed = F.from_csv(text, kinds, {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
        marked = [f.source for f in some if _skipped(f, facts[f.url])]
        source = relative_path(F.col("path"), root, prefix)
        offset = F.col("offset") + F.when(source.isin(marked), BYTE_ORDER_MARK).otherwise(0) if marked else F.col("offset")
        rows = rows.select(parsed.alias("r"), "number", offset.alias("offset"), source.alias(SOURCE))
        bad = [F.col("r.bad").alias(CORRUPT)] if keep_corrupt else []
        return rows.select(*[F.col(f"r.c{k}").alias(c) for k, c in enumerate(header)], *bad, F.col("number").alias(RECORD), F.col("offset").alias(OFFSET),
                           SOURCE)

    def rows_of(sources: list[str]) -> DataFrame:
        wanted = set(sources)
        return union_by_name([read_group(h, mine) for h, some in groups.items() if (mine := [f for f in some if f.source in wanted])], spark)

    df = union_by_name([read_group(h, some) for h, some in groups.items()], spark)
    return Dataset(df=df, files=files_frame(spark, out_infos), reader=rows_of, infos=out_infos)


def read_parquet_files(spark: SparkSession, root: str, infos: list[FileInfo]) -> Dataset:
    pq = [f for f in infos if f.format == "parquet"]
    schemas = parquet_schemas(spark, pq)  # each file's own columns, from its footer
    out_infos, groups = [], {}
    for f in pq:
        cols, err = schemas[f.path]
        out_infos.append(FileInfo(f.source, f.path, f.size, [c for c, _ in cols or []], f.format, err, f.url))
        if not err:  # unreadable files stay out of the Spark read
            groups.setdefault(tuple(sorted(cols)), []).append(f.path)
    src_of = {f.path: f.source for f in pq}
    prefix = common_prefix(pq)

    def read(paths: list[str]) -> DataFrame:
        wanted = set(paths)
        parts = [spark.read.parquet(*map(csvscan.escape_glob, mine))
                 .select("*", relative_path(F.col("_metadata.file_path"), root, prefix).alias(SOURCE), (F.col("_metadata.row_index") + 1).alias(RECORD))
                 for ps in groups.values() if (mine := [p for p in ps if p in wanted])]
        return union_by_name(parts, spark)

    def rows_of(sources: list[str]) -> DataFrame:
        wanted = set(sources)
        return read([p for p, s in src_of.items() if s in wanted])

    return Dataset(df=read(list(src_of)), files=files_frame(spark, out_infos), reader=rows_of, infos=out_infos)


def read_drop(spark: SparkSession, root: str, glob: str | None = None, sep: str = ";",
              recursive: bool = True, multiline: bool = True) -> Dataset:
    """All CSV and Parquet files under ``root`` as one Dataset.

    Files of other formats are kept in the file table (with no columns), so
    they get a verdict too.
    """
    infos = list_file_infos(spark, root, glob, recursive)
    parts = [read_csv_files(spark, root, infos, sep, multiline=multiline), read_parquet_files(spark, root, infos)]
    df = union_by_name([p.df for p in parts], spark)
    other = [FileInfo(f.source, f.path, f.size, [], f.format, url=f.url) for f in infos if f.format is None]
    all_infos = sorted(parts[0].infos + parts[1].infos + other, key=lambda f: f.source)

    def rows_of(sources: list[str]) -> DataFrame:
        return union_by_name([p.rows_of(sources) for p in parts], spark)

    return Dataset(df=df, files=files_frame(spark, all_infos), reader=rows_of, infos=all_infos)


def typed(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Cast declared columns with ``try_cast`` (bad values become null).

    Run ``column_types`` first to report the values that do not cast.
    """
    casts = {c: col(c).try_cast(t) for c, t in schema.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Whole-column type inference for string columns: long, double or string.

    One aggregation over all rows (no sampling), so the result does not
    depend on where a bad value sits in a file.
    """
    cols = columns or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, T.StringType) and not f.name.startswith(HIDDEN) and f.name != SOURCE]
    if not cols:
        return {}
    aggs = []
    for c in cols:
        v = col(c)
        aggs.append(F.count_if(v.isNotNull() & v.try_cast("long").isNull()).alias(f"{c}__l"))
        aggs.append(F.count_if(v.isNotNull() & v.try_cast("double").isNull()).alias(f"{c}__d"))
        aggs.append(F.count(v).alias(f"{c}__n"))
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        if row[f"{c}__n"] == 0:
            out[c] = "string"
        elif row[f"{c}__l"] == 0:
            out[c] = "long"
        elif row[f"{c}__d"] == 0:
            out[c] = "double"
        else:
            out[c] = "string"
    return out
