"""Accumulate the distinct ids seen over time in a versioned table.

Every run adds a version with its new ids. Whole-number ids of versions that
are ``COMPACT_AFTER`` or more runs old are also kept as a bitmap (``compact``):
a run then reads the lines of the bitmap within the range of its own ids and
the rows of the few versions after it, however many versions there are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.errors import ConcurrentWriteError
from dropgate.functions.names import col as named
from dropgate.operators import joins, membership
from dropgate.sources.csvscan import escape_glob
from dropgate.sources.publish import Publication

COMPACT_AFTER = 8  # versions read as rows, at most, before they are merged into the bitmap


def new_ids(ids: DataFrame, existing: DataFrame | None, id_col: str, out_col: str = "id",
            max_broadcast_rows: int = joins.BROADCAST_MAX_ROWS) -> DataFrame:
    """Distinct non-null ids of ``ids`` not yet in ``existing``.

    ``distinct`` runs map-side first, so a hot id costs one row per task; the
    known ids are de-duplicated too and broadcast only under a proven bound;
    beyond it a bit filter of ``ids`` leaves out those that nobody asks for.
    """
    d = ids.select(named(id_col).alias(out_col)).filter(named(out_col).isNotNull()).distinct()
    if existing is None:
        return d
    known = joins.distinct_for(existing.select(named(existing.columns[0]).alias(out_col)), d, [out_col], max_broadcast_rows)
    return d.join(known, out_col, "left_anti")


def snapshot_union(ids: DataFrame, existing: DataFrame | None, id_col: str, out_col: str = "id") -> DataFrame:
    """The snapshot after adding ``ids``: existing ids ∪ new ids (distinct)."""
    d = ids.select(named(id_col).alias(out_col)).filter(named(out_col).isNotNull())
    if existing is not None:
        d = d.unionByName(existing.select(named(existing.columns[0]).alias(out_col)))
    return d.distinct()


@dataclass
class Known:
    """What a versioned table holds besides one version: lines of a bitmap for the files that were
    compacted, with their number of rows, and the rows of the other files."""
    lines: DataFrame | None
    n_compacted: int
    rest: DataFrame | None
    rest_versions: set[str]


def _bitmap(catalog, table: str) -> Publication:
    return Publication(catalog.spark, f"{catalog.spec(table).path.rstrip('/')}/_known")


def _version_of(file: str) -> str:
    return re.search(r"/version=([^/]+)/", unquote(file)).group(1)


def _rows(catalog, spec, df: DataFrame, files: list[str]) -> DataFrame | None:
    """The ids in some of a table's files; no other file is read."""
    if not files:
        return None
    id_field = T.StructType([df.schema.fields[0]])
    return catalog.spark.read.schema(id_field).options(**spec.options).format(spec.format).load([escape_glob(unquote(f)) for f in files])


def known(catalog, table: str, version: str | None = None) -> Known | None:
    """What ``table`` holds besides ``version``; None where a bitmap doesn't apply (ids that are no
    whole numbers, CSV tables), or ``version`` is itself compacted, as when a run is repeated."""
    spec = catalog.spec(table)
    if not spec.versioned or spec.format == "csv":
        return None
    df = catalog._load(spec)
    if not isinstance(df.schema.fields[0].dataType, membership.WHOLE):
        return None
    files = set(df.inputFiles())
    folders = _bitmap(catalog, table).folders()
    lines, n, done = None, 0, set()
    if folders:
        read = catalog.spark.read
        covered = read.parquet(f"{folders[0]}/files").collect()  # a row per file of the table, as Spark's own file index
        done = {r["file"] for r in covered}
        if done <= files:  # else a compacted file was replaced, and the bitmap is of no use
            lines, n = read.parquet(f"{folders[0]}/lines"), sum(r["n_rows"] for r in covered)
        else:
            done = set()
    if any(_version_of(f) == version for f in done):
        return None
    rest = sorted(f for f in files - done if _version_of(f) != version)
    return Known(lines, n, _rows(catalog, spec, df, rest), {_version_of(f) for f in rest})


def compact(catalog, table: str) -> bool:
    """Merge all versions of ``table`` into its bitmap: one bit per id, lines of 512 sorted by number.

    The versions stay as they are. The bitmap is published whole, with the
    names of the files it stands for; whoever replaces one of these makes it
    void. False if someone else compacted in the meantime, or nothing can be.
    """
    state, spec = known(catalog, table), catalog.spec(table)
    if state is None or state.rest is None:
        return False
    bitmap, df = _bitmap(catalog, table), catalog._load(spec)
    seen, _ = bitmap.current()
    ids = named(df.columns[0])
    lines = membership.lines_of(state.rest.filter(ids.isNotNull()), ids.cast("long"))
    if state.lines is not None:
        lines = membership.merged_lines(state.lines.unionByName(lines))
    folder = bitmap.folder()
    lines.repartitionByRange(membership.LINE_NO).sortWithinPartitions(membership.LINE_NO).write.parquet(f"{folder}/lines")
    # rows are counted where they are named: the compacted ones as a whole, with the first of their files
    files = sorted(df.inputFiles())
    n = state.n_compacted + state.rest.count()
    catalog.spark.createDataFrame([(f, n if i == 0 else 0) for i, f in enumerate(files)], "file string, n_rows long").write.parquet(f"{folder}/files")
    try:
        bitmap.publish(seen, [folder])
    except ConcurrentWriteError:
        return False
    return True


def unknown(ids: DataFrame, id_col: str, lines: DataFrame) -> DataFrame:
    """The rows of ``ids`` (whole numbers, no nulls) whose bit isn't set; only lines within their range are read."""
    bit = named(id_col).cast("long")
    lo, hi = ids.agg(F.min(bit), F.max(bit)).first()
    if lo is None:
        return ids
    touched = lines.filter(F.col(membership.LINE_NO).between(lo >> 9, hi >> 9))
    rows = ids.withColumn(membership.LINE_NO, F.shiftright(bit, 9))
    return rows.join(touched, membership.LINE_NO, "left").filter(~membership.bit_set(bit, F.col(membership.WORDS))).select(named(id_col))


def append_new_ids(catalog, table: str, df: DataFrame, id_col: str, version: str | None = None) -> dict:
    """Write the ids of ``df`` missing from ``table`` as a new version.

    Only the delta is written (no read-then-overwrite of the same path), so
    a failure can never lose the existing snapshot, and re-running the same
    version replaces just that version. A version is written once: ids of
    several frames go in together (``append_all``).
    Returns table, version, and the number of new and of all known ids.
    """
    return append_all(catalog, table, [(df, id_col)], version)


def append_all(catalog, table: str, frames: list[tuple[DataFrame, str]], version: str | None = None) -> dict:
    """``append_new_ids`` for the ids of several frames (frame, id column) in one version."""
    import datetime as _dt

    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    spec = catalog.spec(table)
    out_col = frames[0][1]
    ids = None
    for df, col in frames:
        one = df.select(named(col).alias(out_col))
        ids = one if ids is None else ids.unionByName(one)
    there = catalog.exists(table)
    state = known(catalog, table, version) if there and isinstance(ids.schema[out_col].dataType, membership.WHOLE) else None
    if state is not None:
        fresh = new_ids(ids, state.rest, out_col, out_col=out_col)
        delta = fresh if state.lines is None else unknown(fresh, out_col, state.lines)
        catalog.write_version(table, delta, version)
        held = known(catalog, table)  # with this version
        n_rest = 0 if state.rest is None else state.rest.count()
        n_new = (held.rest.count() if held.rest is not None else 0) - n_rest
        if len(held.rest_versions) > COMPACT_AFTER:
            compact(catalog, table)
        return {"table": table, "version": version, "n_new": n_new, "n_total": held.n_compacted + n_rest + n_new}
    existing = None
    if there:
        existing = catalog.read(table)
        if spec.versioned:
            # ids written by an earlier attempt of this same version do not count
            existing = (catalog._resolve(spec)
                        .filter(F.col("version") != F.lit(version)).drop("version"))
    delta = new_ids(ids, existing, out_col, out_col=out_col)
    catalog.write_version(table, delta, version)
    counts = {r["version"]: r["n_rows"] for r in catalog.versions(table).collect()}
    return {"table": table, "version": version, "n_new": counts.get(version, 0), "n_total": sum(counts.values())}
