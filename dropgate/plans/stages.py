"""The preboarding run: backup → validate → dispatch → transform → validate →
cross-validate → deliver, all files of a step in one Spark plan per pattern.

Data work is Spark: every rule of a pattern runs over the rows of all its
files at once (one fused aggregation for row-level checks, distinct-first
plans for key-level checks, broadcast or salted joins for enrichment).

File-level bookkeeping (which file matches which pattern, which columns a
file has, which files passed) is a few bytes per file and is kept on the
driver, like Spark's own file index; Spark only sees it as small local
relations in joins, so no job is spent scanning one-row-per-file tables.

Data is written where it changes: once at landing (CSV parsed once), after
transforms (values change; also cuts lineage before re-validation) and at
delivery. Validation and intermediate routing change no values, so their
outputs are lazy views (a filter / rename over the last written table):
no copy of the data, and a short narrow lineage to recompute after an
executor loss. Findings of every step are written. Every write replaces a
path owned by (run, step, group), so a re-run step is idempotent.
"""

from __future__ import annotations

import datetime as _dt
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.errors import AllFilesFailedError, NoInputFilesError, RegistryError, UndeliveredRowsError
from dropgate.functions.globs import glob_regex
from dropgate.functions.names import col as named, quoted
from dropgate.operators import checks as C
from dropgate.operators.aggregate import aggregate
from dropgate.operators.routing import routing_findings
from dropgate.operators.joins import HIDDEN
from dropgate.operators.messages import msg
from dropgate.operators.snapshot import append_all
from dropgate.operators.transforms import TransformContext, apply_chain, keeps_rows
from dropgate.plans.findings import FINDINGS_SCHEMA, conform, union_all, write_reports
from dropgate.plans.registry import Registry
from dropgate.sources.catalog import Catalog, resolve_run
from dropgate.sources.files import CORRUPT, CSV_WRITE, SOURCE, Dataset, FileInfo, files_frame, read_drop, typed, union_by_name
from dropgate.sources.publish import unsorted_partitions

# Partition columns of the library's own tables; user columns cannot have the prefix.
PATTERN = f"{HIDDEN}pattern"
GROUP = "group"
SAFE_GROUP = f"{HIDDEN}group"  # where the data has a column of the name above
RENAMED = f"{HIDDEN}new"
FILES = "_dropgate_files"  # file table of a backup, below its run folder

# Passing-file lists up to this size are broadcast in the delivery semi-join
# (the size is known exactly on the driver).
MAX_BROADCAST_FILES = 200_000


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


# ---------------------------------------------------------------- backup

def backup(df: DataFrame, root: str, run_id: str) -> str:
    """(R5) write the raw dataset (all columns + ``_source_file``) as run ``run_id``."""
    path = f"{root.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def restore(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """(R6) the rows of a backed-up run; unknown run → error listing runs."""
    from dropgate.sources.catalog import list_runs
    path = f"{root.rstrip('/')}/run_id={run_id}"
    try:
        return spark.read.parquet(path).drop(PATTERN)
    except Exception as e:  # noqa: BLE001 - reported with the available runs
        try:
            runs = [r["run_id"] for r in list_runs(spark, root).collect()]
        except Exception:  # noqa: BLE001
            runs = []
        raise FileNotFoundError(f"backup '{run_id}' not found; available: {runs}") from e


def keep_files(spark: SparkSession, infos: list[FileInfo], path: str) -> None:
    """Write the file table beside a run's rows, so files without rows can be restored too."""
    spark.createDataFrame([(f.source, f.path, f.size, f.columns, f.format, f.error) for f in infos],
                          "source string, path string, size long, columns array<string>, format string, error string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/{FILES}")


def restore_dataset(spark: SparkSession, root: str, run_id: str) -> Dataset:
    """(R6) a backed-up run as the input of another run: its rows and all its files."""
    rows = restore(spark, root, run_id)
    stored = spark.read.parquet(f"{root.rstrip('/')}/run_id={run_id}/{FILES}").collect()
    infos = sorted((FileInfo(**r.asDict()) for r in stored), key=lambda f: f.source)

    def rows_of(sources: list[str]) -> DataFrame:
        return keep_sources(spark, rows, sources, len(infos))

    return Dataset(df=rows, files=files_frame(spark, infos), reader=rows_of, infos=infos)


# ---------------------------------------------------------------- helpers

def keep_sources(spark: SparkSession, df: DataFrame, sources: list[str], all_sources: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``_source_file`` is in ``sources``.

    The list's size is known exactly, so it is broadcast when it is at most
    MAX_BROADCAST_FILES entries; larger lists use a shuffled semi-join.
    """
    sources = sorted(set(sources))
    if all_sources is not None and len(sources) == all_sources:
        return df
    keys = spark.createDataFrame([(s,) for s in sources], f"{SOURCE} string")
    if len(sources) <= MAX_BROADCAST_FILES:
        keys = F.broadcast(keys)
    return df.join(keys, SOURCE, "left_semi")


def own_columns(df: DataFrame, infos: list[FileInfo]) -> DataFrame:
    """Keep only the columns the files in ``infos`` actually have.

    The rows of a step are one union over files of several layouts; before
    a pattern's rules run, its rows are narrowed back to its files' columns
    (plus ``_source_file`` and hidden report columns). The union holds columns
    that differ only in case as one; here they get their files' spelling back
    (the first one, if these files differ among themselves).
    """
    names: dict[str, str] = {}
    for f in infos:
        for c in f.columns or []:
            names.setdefault(c.lower(), c)
    return df.select(*[named(c).alias(names.get(c.lower(), c)) for c in df.columns if c.lower() in names or c == SOURCE or c.startswith(HIDDEN)])


def _by_layout(infos: list[FileInfo], any_case: bool = False) -> list[list[FileInfo]]:
    """Files grouped by their set of columns (order ignored, with ``any_case`` the case too), in first-seen order."""
    groups: dict[frozenset, list[FileInfo]] = {}
    for f in infos:
        groups.setdefault(frozenset(c.lower() if any_case else c for c in f.columns or []), []).append(f)
    return list(groups.values())


def _new_names(moving: list[tuple[FileInfo, str]]) -> dict[str, str]:
    """source -> ``target/file name``; files that would share a name keep their whole
    path below the target, and a number where even those collide."""
    flat = {f.source: f"{t.rstrip('/')}/{f.source.rsplit('/', 1)[-1]}" for f, t in moving}
    uses: dict[str, int] = {}
    for n in flat.values():
        uses[n] = uses.get(n, 0) + 1
    taken = {n for n, k in uses.items() if k == 1}
    out = {}
    for f, t in sorted(moving, key=lambda m: m[0].source):
        name = flat[f.source]
        if uses[name] > 1:
            base = name = f"{t.rstrip('/')}/{f.source}"
            k = 1
            while name in taken:
                k += 1
                name = f"{base}~{k}"
            taken.add(name)
        out[f.source] = name
    return out


def _safe(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", name).strip("_") or "x"


@dataclass
class StepOutput:
    step: str
    findings: DataFrame
    path: str | None = None
    summary: dict = field(default_factory=dict)
    passed: list[str] = field(default_factory=list)


class Preboarding:
    """Runs registries over a drop of files (see ``plans.registry`` for kinds)."""

    def __init__(self, spark: SparkSession, root: str, catalog: Catalog | None = None,
                 run_id: str | None = None, case_sensitive: bool = False, sep: str = ";",
                 delivery_format: str = "parquet", multiline: bool = True):
        self.spark = spark
        # see session.DEFAULT_CONF: constraint inference over registry plans
        # grows combinatorially and is not needed by them
        spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
        # malformed CSV rows are only detected when every token is parsed
        spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
        self.root = root.rstrip("/")
        self.catalog = catalog or Catalog(spark)
        self.run_id = run_id or new_run_id()
        self.case_sensitive = case_sensitive
        self.sep = sep
        self.multiline = multiline  # CSV values may hold line breaks (large files are then read by one task each)
        if delivery_format not in ("parquet", "csv"):
            raise RegistryError(f"unsupported delivery format '{delivery_format}'")
        self.delivery_format = delivery_format  # format of the last step's output
        self._final_step: str | None = None
        self.outputs: list[StepOutput] = []
        self.timings: dict[str, float] = {}
        self._input_paths: list[str] = []
        self._written: dict[str, dict[str, tuple[list[str], list[str]]]] = {}
        self._views: dict[str, Dataset] = {}
        self._folders: dict[str, dict[str, str]] = {}
        self._cleared: set[str] = set()
        self._group_column: dict[str, str] = {}
        self._observed: dict[str, list[Observation]] = {}

    # ------------------------------------------------------------ paths / io
    def staging(self, step: str) -> str:
        return f"{self.root}/staging/run_id={self.run_id}/{step}"

    def _folder(self, step: str, group: str) -> str:
        """Folder name of a group: readable, and unique within the step
        (two patterns may reduce to the same safe name)."""
        names = self._folders.setdefault(step, {})
        if group not in names:
            base, n = _safe(group), 1
            name = base
            while name in names.values():
                n += 1
                name = f"{base}_{n}"
            names[group] = name
        return names[group]

    def _group_path(self, step: str, group: str) -> str:
        return f"{self.staging(step)}/{self._group_column.get(step, GROUP)}={self._folder(step, group)}"

    @property
    def _csv_options(self) -> dict[str, str]:
        """Values are written as they are: quotes doubled, blanks at the ends kept."""
        return {**CSV_WRITE, "sep": self.sep}

    def _counted(self, step: str, df: DataFrame) -> DataFrame:
        """``df``, with its rows counted while the step writes them (no pass of its own)."""
        seen = Observation()
        self._observed.setdefault(step, []).append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def rows_written(self, step: str) -> int:
        return sum(o.get["n"] for o in self._observed.get(step, []))

    def _fresh(self, step: str) -> None:
        """Empty the step's folder once, so nothing of an earlier attempt stays beside its output."""
        if step in self._cleared:
            return
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.staging(step))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._cleared.add(step)

    def _write_group(self, step: str, group: str, df: DataFrame, sources: list[str],
                     keep_hidden: bool = False) -> None:
        self._fresh(step)
        if not keep_hidden:
            df = df.drop(*[c for c in df.columns if c.startswith(HIDDEN)])
        w = self._counted(step, df).write.mode("overwrite")
        if step == self._final_step and self.delivery_format == "csv":
            w.options(**self._csv_options).csv(self._group_path(step, group))
        else:
            w.parquet(self._group_path(step, group))
        cols = [c for c in df.columns if c != SOURCE and not c.startswith(HIDDEN)]
        self._written.setdefault(step, {})[self._folder(step, group)] = (sorted(sources), cols)

    def read_step(self, step: str, only: list[str] | None = None) -> Dataset:
        """The written output of ``step`` (restricted to ``only`` files) as a Dataset.

        ``rows_of`` reads only the group folders that hold the requested files.
        """
        if step in self._views:
            view = self._views[step]
            if only is None:
                return view
            keep = set(only)
            infos = [f for f in view.infos if f.source in keep]
            return Dataset(df=view.rows_of([f.source for f in infos]), files=files_frame(self.spark, infos),
                           reader=view.reader, infos=infos)
        groups = self._written.get(step, {})
        wanted = set(only) if only is not None else None
        members: dict[str, str] = {}
        infos: list[FileInfo] = []
        for g, (sources, cols) in sorted(groups.items()):
            for s in sources:
                if wanted is None or s in wanted:
                    members[s] = g
                    infos.append(FileInfo(source=s, columns=cols, format="parquet"))
        if not infos:
            raise NoInputFilesError(step, self.staging(step))
        tables = {g: self.spark.read.parquet(f"{self.staging(step)}/{self._group_column.get(step, GROUP)}={g}") for g in sorted(set(members.values()))}
        spark = self.spark

        def rows_of(sources: list[str]) -> DataFrame:
            mine = [s for s in sources if s in members]
            gs = sorted({members[s] for s in mine})
            if not gs:
                return spark.createDataFrame([], f"{SOURCE} string")
            df = union_by_name([tables[g] for g in gs], spark)
            held = sum(len(groups[g][0]) for g in gs)
            return keep_sources(spark, df, mine, held)

        all_rows = rows_of([f.source for f in infos])
        return Dataset(df=all_rows, files=files_frame(spark, infos), reader=rows_of, infos=infos)

    # ------------------------------------------------------------ matching
    def _match(self, infos: list[FileInfo], patterns: list[str]) -> dict[str, int]:
        """source -> index of its single matching pattern (-1: none or several)."""
        regs = [re.compile(glob_regex(p, self.case_sensitive)) for p in patterns]
        out = {}
        for f in infos:
            hits = [i for i, rx in enumerate(regs) if rx.match(f.source)]
            out[f.source] = hits[0] if len(hits) == 1 else -1
        return out

    def _routing(self, ds: Dataset, patterns: list[str]) -> DataFrame:
        """Pattern findings per file, plus a failing ``read_file`` finding for
        files that could not be read (S5); the run goes on with the others."""
        out = routing_findings(ds.files.select(SOURCE), patterns, SOURCE, self.case_sensitive)
        errors = [(f.source, f.error) for f in (ds.infos or []) if f.error]
        if errors:
            bad = self.spark.createDataFrame(errors, f"{SOURCE} string, message string").select(
                SOURCE, F.lit("read_file").alias("check"), F.lit(None).cast("string").alias("column"),
                F.lit("fatal").alias("severity"), F.lit(False).alias("passed"), F.lit(1).cast("long").alias("n_bad"),
                "message", F.lit(None).cast("array<string>").alias("samples"))
            out = out.unionByName(bad)
        return out

    def _pattern_files(self, ds: Dataset, match: dict[str, int], i: int) -> list[FileInfo]:
        return [f for f in ds.infos if match[f.source] == i]

    # ------------------------------------------------------------ steps
    def validate(self, ds: Dataset, registry: Registry, step: str, materialize: bool = False) -> StepOutput:
        """Run a validation registry; passing files go on.

        Without ``materialize`` the step's output is a lazy view (rows of the
        passing files of the previous table, typed by the pattern's schema):
        validation changes no values, so copying the data would only cost I/O.
        """
        patterns = registry.patterns
        match = self._match(ds.infos, patterns)
        frames = [self._routing(ds, patterns)]
        outputs = []
        for i, p in enumerate(patterns):
            infos = self._pattern_files(ds, match, i)
            if not infos:
                continue
            rules = registry.rules(p)
            rows = own_columns(ds.rows_of([f.source for f in infos]), infos)
            spec = dict(rules.get("validators") or {})
            if CORRUPT in rows.columns and "malformed_rows" not in spec:
                spec["malformed_rows"] = None  # CSV rows that did not parse fail their file
            # a value that typing would turn into null fails its file first
            types = {c: t for c, t in (rules.get("schema") or {}).items() if c in rows.columns}
            if types:
                spec["column_types"] = {**types, **(spec.get("column_types") or {})}
            keys = files_frame(self.spark, infos)
            frames.append(C.run_checks(rows, spec, key=SOURCE, keys_df=keys, catalog=self.catalog))
            outputs.append((p, rows, rules.get("schema"), infos))
        findings, passed = self._record(frames, step)
        if not materialize:
            self._views[step] = self._validated_view(ds, outputs, passed)
        else:
            for p, rows, schema, infos in outputs:
                ok = [f.source for f in infos if f.source in passed]
                if ok:
                    good = keep_sources(self.spark, rows, ok, len(infos))
                    self._write_group(step, p, typed(good, schema) if schema else good, ok)
        return self._finish(step, findings, ds, passed)

    def _validated_view(self, ds: Dataset, outputs: list, passed: set[str]) -> Dataset:
        spark = self.spark
        part_of, schema_of, infos_of, out_infos = {}, {}, {}, []
        for p, _, schema, infos in outputs:
            ok = [f for f in infos if f.source in passed]
            schema_of[p], infos_of[p] = schema, ok
            for f in ok:
                part_of[f.source] = p
                out_infos.append(f)

        def rows_of(sources: list[str]) -> DataFrame:
            by_p: dict[str, list[str]] = {}
            for s_ in sources:
                if s_ in part_of:
                    by_p.setdefault(part_of[s_], []).append(s_)
            parts = []
            for p, srcs in by_p.items():
                rows = own_columns(ds.rows_of(srcs), infos_of[p])
                parts.append(typed(rows, schema_of[p]) if schema_of[p] else rows)
            return union_by_name(parts, spark)

        return Dataset(df=rows_of([f.source for f in out_infos]), files=files_frame(spark, out_infos),
                       reader=rows_of, infos=out_infos)

    def dispatch(self, ds: Dataset, mapping: dict[str, str], step: str, materialize: bool = True) -> StepOutput:
        """Route files to target folders (flattened to ``target/file name``).

        ``materialize`` writes the routed rows (delivery); otherwise the step
        is a zero-copy view that renames ``_source_file`` on read.
        """
        patterns = list(mapping)
        match = self._match(ds.infos, patterns)
        # the verdicts follow from the file table; only the findings are written
        good = {f.source for f in ds.infos if match[f.source] >= 0 and not f.error}
        findings, passed = self._record([self._routing(ds, patterns)], step, passed=good)
        if not materialize:
            self._views[step] = self._routed_view(ds, mapping, match, passed)
            return self._finish(step, findings, ds, passed)
        targets = list(mapping.values())
        moving = [f for f in ds.infos if match[f.source] >= 0 and f.source in passed]
        new_of = _new_names([(f, targets[match[f.source]]) for f in moving])
        self._fresh(step)
        clash = any(c.lower() == GROUP for f in moving for c in f.columns or [])
        group_col = self._group_column.setdefault(step, SAFE_GROUP if clash else GROUP)
        # one scan and one partitioned write per column layout (not one per
        # target): each row looks up its target folder and new name in a
        # small broadcast table keyed by its file. A target that gets files of
        # several layouts has a folder for each, so no write replaces another.
        layouts: dict[str, int] = {}
        for infos in _by_layout(moving, any_case=True):  # one folder must be readable as one table
            mine = {targets[match[f.source]] for f in infos}
            for t in mine:
                layouts[t] = layouts.get(t, 0) + 1
            moves = []
            for f in infos:
                t = targets[match[f.source]]
                moves.append((f.source, self._folder(step, t if layouts[t] == 1 else f"{t}#{layouts[t]}"), new_of[f.source]))
            keymap = self.spark.createDataFrame(moves, f"{SOURCE} string, {group_col} string, {RENAMED} string")
            if len(moves) <= MAX_BROADCAST_FILES:
                keymap = F.broadcast(keymap)
            rows = own_columns(ds.rows_of([f.source for f in infos]), infos)
            rows = rows.drop(*[c for c in rows.columns if c.startswith(HIDDEN)])
            out = (rows.join(keymap, SOURCE).withColumn(SOURCE, F.col(RENAMED)).drop(RENAMED))
            w = self._counted(step, out).write.mode("append").partitionBy(group_col)
            with unsorted_partitions(self.spark, len({m[1] for m in moves})):
                if step == self._final_step and self.delivery_format == "csv":
                    w.options(**self._csv_options).csv(self.staging(step))
                else:
                    w.parquet(self.staging(step))
            cols = [c for c in rows.columns if c != SOURCE]
            for folder in sorted({m[1] for m in moves}):
                self._written.setdefault(step, {})[folder] = (sorted(m[2] for m in moves if m[1] == folder), cols)
        return self._finish(step, findings, ds, passed)

    def _routed_view(self, ds: Dataset, mapping: dict[str, str], match: dict[str, int],
                     passed: set[str]) -> Dataset:
        spark = self.spark
        targets = list(mapping.values())
        moving = [(f, targets[match[f.source]]) for f in ds.infos if match[f.source] >= 0 and f.source in passed]
        new_of = _new_names(moving)
        old_of = {n: o for o, n in new_of.items()}
        out_infos = [FileInfo(source=new_of[f.source], size=f.size, columns=f.columns, format=f.format) for f, _ in moving]
        infos_by_old = {f.source: f for f in ds.infos}

        def rows_of(sources: list[str]) -> DataFrame:
            olds = sorted({old_of[s_] for s_ in sources if s_ in old_of})
            parts = []
            for infos in _by_layout([infos_by_old[o] for o in olds]):
                names = spark.createDataFrame([(f.source, new_of[f.source]) for f in infos], f"{SOURCE} string, {RENAMED} string")
                if len(infos) <= MAX_BROADCAST_FILES:
                    names = F.broadcast(names)
                rows = own_columns(ds.rows_of([f.source for f in infos]), infos)
                parts.append(rows.join(names, SOURCE).withColumn(SOURCE, F.col(RENAMED)).drop(RENAMED))
            return union_by_name(parts, spark)

        return Dataset(df=rows_of([f.source for f in out_infos]), files=files_frame(spark, out_infos),
                       reader=rows_of, infos=out_infos)

    def transform(self, ds: Dataset, registry: Registry, step: str) -> StepOutput:
        patterns = registry.patterns
        match = self._match(ds.infos, patterns)
        frames = [self._routing(ds, patterns)]
        pending = []
        for i, p in enumerate(patterns):
            spec = registry.rules(p).get("transforms", [])
            # A transform's success depends only on the columns it sees, so
            # the chain runs once per distinct column set of the pattern's
            # files: a file lacking a needed column fails on its own, as if
            # it were read alone (usually there is a single layout).
            layouts = _by_layout(self._pattern_files(ds, match, i))
            for j, infos in enumerate(layouts):
                group = p if len(layouts) == 1 else f"{p}#{j + 1}"
                rows = own_columns(ds.rows_of([f.source for f in infos]), infos)
                report = C.CheckContext(df=rows, key=SOURCE, catalog=self.catalog)
                ctx = TransformContext(catalog=self.catalog, key=SOURCE, run_id=self.run_id, report=report)
                out, log = apply_chain(rows, spec, ctx)
                ctx.all_rows = keeps_rows(spec)
                keys = files_frame(self.spark, infos)
                # chain status: one finding per transform and file
                status = [F.struct(F.lit(n).alias("check"), F.lit(None).cast("string").alias("column"),
                                   F.lit("info" if ok else "fail").alias("severity"), F.lit(ok).alias("passed"),
                                   F.lit(0 if ok else 1).cast("long").alias("n_bad"),
                                   F.lit(err).cast("string").alias("message"),
                                   F.lit(None).cast("array<string>").alias("samples"))
                          for n, ok, err in log] or [F.struct(
                              F.lit("transforms").alias("check"), F.lit(None).cast("string").alias("column"),
                              F.lit("info").alias("severity"), F.lit(True).alias("passed"),
                              F.lit(0).cast("long").alias("n_bad"), F.lit(None).cast("string").alias("message"),
                              F.lit(None).cast("array<string>").alias("samples"))]
                frames.append(keys.select(SOURCE, F.inline(F.array(*status))))
                if all(ok for _, ok, _ in log):
                    pending.append((group, out, ctx, report, keys, infos))
        # write transformed rows first (hidden report columns included), then
        # evaluate the transform reports on the written table
        staged = {}
        for p, out, ctx, report, keys, infos in pending:
            self._write_group(step, p, out, [f.source for f in infos], keep_hidden=True)
            staged[p] = self.spark.read.parquet(self._group_path(step, p))
            if not ctx.enrichments:
                continue
            if ctx.all_rows:
                report.df = staged[p]
                frames.append(C.evaluate(report, keys_df=keys))
            else:  # later steps drop rows: count where the join was
                frames.extend(C.evaluate(r, keys_df=keys) for r in ctx.enrichments)
        findings, passed = self._record(frames, step)
        snapshots: dict[str, list] = {}
        files: dict[str, list[str]] = {}
        for p, out, ctx, report, keys, infos in pending:
            ok = [f.source for f in infos if f.source in passed]
            rows = keep_sources(self.spark, staged[p], ok, len(infos))
            for action in ctx.actions:
                action(rows)
            for table, id_col, copy, at in ctx.snapshots:
                # later steps drop rows: the ids are those where the snapshot was
                saved = rows if ctx.all_rows else keep_sources(self.spark, at, ok, len(infos))
                snapshots.setdefault(table, []).append((saved.select(F.col(copy).alias(id_col)), id_col))
                files.setdefault(table, []).extend(ok)
        # one version per table and run: the ids of all patterns go in together
        for table, parts in snapshots.items():
            got = append_all(self.catalog, table, parts, version=self.run_id)
            self._note(step, sorted(set(files[table])), "save_inventory_snapshot", parts[0][1],
                       msg("snapshot", table=table) % (got["n_new"], got["n_total"]))
        return self._finish(step, findings, ds, passed)

    def _note(self, step: str, sources: list[str], check: str, column: str, message: str) -> None:
        """Add an informative finding for each of ``sources`` to a recorded step."""
        rows = self.spark.createDataFrame([(s,) for s in sources], f"{SOURCE} string").select(
            SOURCE, F.lit(check).alias("check"), F.lit(column).alias("column"), F.lit("info").alias("severity"),
            F.lit(True).alias("passed"), F.lit(0).cast("long").alias("n_bad"), F.lit(message).alias("message"))
        (conform(rows, self.run_id, step, key=SOURCE).drop("run_id", "step")
         .write.mode("append").parquet(f"{self.root}/findings/run_id={self.run_id}/step={step}"))

    def aggregate(self, ds: Dataset, registry: Registry, step: str) -> StepOutput:
        """(X6) per pattern: ``groupBy(group_by).agg(...)`` over the pattern's files.

        With ``_source_file`` in ``group_by`` there is one result per file;
        otherwise all files of the pattern are combined (partial aggregation
        runs map-side either way).
        """
        patterns = registry.patterns
        match = self._match(ds.infos, patterns)
        frames = [self._routing(ds, patterns)]
        outs = []
        for i, p in enumerate(patterns):
            rules = registry.rules(p)
            needed = list(dict.fromkeys([*rules["group_by"], *rules["aggregations"]]))
            parts, members = [], []
            for infos in _by_layout(self._pattern_files(ds, match, i)):  # as in transform()
                rows = own_columns(ds.rows_of([f.source for f in infos]), infos)
                try:
                    aggregate(rows, list(rules["group_by"]), dict(rules["aggregations"]))
                    # all layouts that have the columns are one group-by
                    parts.append(rows.select(*map(quoted, needed)))
                    members += infos
                    ok, err = True, None
                except RegistryError as e:
                    ok, err = False, str(e)
                frames.append(files_frame(self.spark, infos).select(
                    SOURCE, F.lit("aggregate").alias("check"), F.lit(None).cast("string").alias("column"),
                    F.lit("fail").alias("severity"), F.lit(ok).alias("passed"),
                    F.lit(0 if ok else 1).cast("long").alias("n_bad"), F.lit(err).cast("string").alias("message"),
                    F.lit(None).cast("array<string>").alias("samples")))
            if parts:
                outs.append((p, aggregate(union_by_name(parts, self.spark), list(rules["group_by"]), dict(rules["aggregations"])), members))
        findings, passed = self._record(frames, step)
        for p, out, infos in outs:
            ok = [f.source for f in infos if f.source in passed]
            if SOURCE in out.columns:
                out = keep_sources(self.spark, out, ok, len(infos))
                self._write_group(step, p, out, ok)
            elif ok:
                name = self._folder(step, p)  # two patterns may reduce to the same readable name
                self._write_group(step, p, out.withColumn(SOURCE, F.lit(name)), [name])
        return self._finish(step, findings, ds, passed)

    # ------------------------------------------------------------ bookkeeping
    def _record(self, frames: list[DataFrame], step: str, passed: set[str] | None = None) -> tuple[DataFrame, set[str]]:
        """Write the step's findings; return them and the set of passing files.

        The verdicts (one row per file) are the only thing collected, unless
        the caller knows them.
        """
        cols = [SOURCE, "check", "column", "severity", "passed", "n_bad", "message", "samples"]
        findings = conform(union_all([f.select(*cols) for f in frames]), self.run_id, step, key=SOURCE)
        path = f"{self.root}/findings/run_id={self.run_id}/step={step}"
        findings.drop("run_id", "step").write.mode("overwrite").parquet(path)
        stored = (self.spark.read.parquet(path)
                  .select(F.lit(self.run_id).alias("run_id"), F.lit(step).alias("step"), "*")
                  .select(*[f.name for f in FINDINGS_SCHEMA.fields]))
        if passed is not None:
            return stored, passed
        verdict = (stored.groupBy("source_file")
                   .agg(F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("ok")).collect())
        return stored, {r["source_file"] for r in verdict if r["ok"]}

    def _finish(self, step: str, findings: DataFrame, ds: Dataset, passed: set[str]) -> StepOutput:
        n = len(ds.infos)
        ok = sorted(f.source for f in ds.infos if f.source in passed)
        out = StepOutput(step=step, findings=findings, path=self.staging(step),
                         summary={"files": n, "passed": len(ok), "failed": n - len(ok)}, passed=ok)
        self.outputs.append(out)
        if n == 0:
            raise NoInputFilesError(step, self.staging(step))
        if not ok:
            raise AllFilesFailedError(f"[{step}] all {n} file(s) failed")
        return out

    def findings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/findings/run_id={self.run_id}") \
            .withColumn("run_id", F.lit(self.run_id))

    def land(self, ds: Dataset, patterns: list[str], path: str) -> Dataset:
        """Write the raw rows once as Parquet, partitioned by first-step pattern.

        CSV text is parsed exactly once here; every later check of the first
        step reads the columnar copy (only the columns it needs, only the
        partition of its pattern). The landing doubles as the run's backup.
        """
        match = self._match(ds.infos, patterns)
        keymap = self.spark.createDataFrame(sorted(match.items()), f"{SOURCE} string, {PATTERN} int")
        if len(match) <= MAX_BROADCAST_FILES:
            keymap = F.broadcast(keymap)
        with unsorted_partitions(self.spark, len(set(match.values()))):
            ds.df.join(keymap, SOURCE, "left").write.mode("overwrite").partitionBy(PATTERN).parquet(path)
        self._close_landing(ds, path)
        keep_files(self.spark, ds.infos, path)
        # declared schema: a landing without any row has no file to read one from
        kinds = T.StructType([*ds.df.schema.fields, T.StructField(PATTERN, T.IntegerType())])
        landed = self.spark.read.schema(kinds).parquet(path)
        count_p: dict[int, int] = {}
        for i in match.values():
            count_p[i] = count_p.get(i, 0) + 1
        spark = self.spark

        def rows_of(sources: list[str]) -> DataFrame:
            mine = [s for s in sources if s in match]
            parts = sorted({match[s] for s in mine})
            if not parts:
                return spark.createDataFrame([], f"{SOURCE} string")
            df = landed.filter(F.col(PATTERN).isin(parts))  # partition pruning
            return keep_sources(spark, df, mine, sum(count_p[i] for i in parts)).drop(PATTERN)

        return Dataset(df=landed.drop(PATTERN), files=ds.files, reader=rows_of, infos=ds.infos)

    def _close_landing(self, ds: Dataset, path: str) -> None:
        """A file whose landed rows are not the records that were counted in it fails as unreadable."""
        counted = {f.source: f.rows for f in ds.infos if f.rows is not None and not f.error}
        if not any(counted.values()):
            return
        landed = {r[SOURCE]: r["n"] for r in self.spark.read.schema(f"{SOURCE} string").parquet(path)
                  .groupBy(SOURCE).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per file, as the file table
        for f in ds.infos:
            if f.source in counted and landed.get(f.source, 0) != counted[f.source]:
                f.error = msg("not_landed", n=landed.get(f.source, 0), all=counted[f.source])

    def _delivered(self, ds: Dataset, out: StepOutput, regs: list) -> bool:
        """Whether the last step wrote as many rows as came in with its passing files.

        Steps that drop or merge rows by design (row filters, aggregations) have no such count.
        """
        name, kind, reg = regs[-1]
        if kind == "aggregate" or kind == "transform" and not all(keeps_rows(reg.rules(p).get("transforms", [])) for p in reg.patterns):
            return True
        return self.rows_written(name) >= ds.rows_of(out.passed).count()

    def clear_input(self, input_root: str) -> int:
        """(R4, R7) remove the input files once the run is delivered; returns count.

        Only files of the listing taken at the start of the run are removed,
        so files that arrived during the run stay for the next one.
        """
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        n = 0
        for path in self._input_paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            if p.getFileSystem(conf).delete(p, False):
                n += 1
        return n

    def run(self, input_root: str | None, steps: list[tuple[str, str, object]], backup_root: str | None = None,
            clear_input: bool = False, restore_from: str | int | None = None) -> list[StepOutput]:
        """Run ``steps`` = [(step name, kind, registry)] over the files in ``input_root``.

        ``clear_input`` removes the input files after the last step
        delivered (not when a step failed for all files). Files that could not
        be read stay, and nothing is removed (``UndeliveredRowsError``) when the
        last step wrote fewer rows than its files brought. ``restore_from`` (a
        run id or negative index) takes the input from that run's backup below
        ``backup_root`` instead of ``input_root``, files without rows included.
        Each file's report is written below ``reports`` at the end.
        """
        regs = [(name, kind, reg if isinstance(reg, Registry) else Registry(reg, kind=kind))
                for name, kind, reg in steps]  # every registry compiles before any read
        if restore_from is not None:
            if not backup_root:
                raise RegistryError("restore_from needs backup_root")
            ds = restore_dataset(self.spark, backup_root, resolve_run(self.spark, backup_root, restore_from))
        else:
            ds = read_drop(self.spark, input_root, sep=self.sep, multiline=self.multiline)
            self._input_paths = [f.path for f in ds.infos if f.path]
        ds_in = ds
        has_csv = any(f.format == "csv" for f in ds.infos)
        if (has_csv or backup_root) and regs and restore_from is None:
            # land once: CSV is parsed a single time; the landing is the backup
            path = (f"{backup_root.rstrip('/')}/run_id={self.run_id}" if backup_root
                    else f"{self.root}/staging/run_id={self.run_id}/_landing")
            ds = self.land(ds, regs[0][2].patterns, path)
        completed, source_ds = True, ds
        last = len(regs) - 1
        self._final_step = regs[-1][0] if regs else None
        for k, (name, kind, reg) in enumerate(regs):
            t0 = time.perf_counter()
            # the last step's output is the delivery and is written; earlier
            # validation / routing steps change no values and stay lazy views
            final = k == last
            source_ds = ds
            try:
                if kind == "validate":
                    out = self.validate(ds, reg, name, materialize=final)
                elif kind == "transform":
                    out = self.transform(ds, reg, name)
                elif kind == "dispatch":
                    out = self.dispatch(ds, reg.targets, name, materialize=final)
                elif kind == "aggregate":
                    out = self.aggregate(ds, reg, name)
                else:
                    raise RegistryError(f"unknown step kind '{kind}'")
            except AllFilesFailedError:
                completed = False
                break
            finally:
                self.timings[name] = round(time.perf_counter() - t0, 3)
            if k < last:
                # transformed rows of failing files were written for their report
                ds = self.read_step(name, only=out.passed if kind == "transform" else None)
        write_reports(self.findings(), self.reports_path)
        if clear_input and completed and regs:
            if not self._delivered(source_ds, out, regs):
                raise UndeliveredRowsError(msg("not_cleared"))
            # files that could not be read hold rows that went nowhere
            unread = {f.path for f in ds_in.infos if f.error}
            self._input_paths = [p for p in self._input_paths if p not in unread]
            self.clear_input(input_root)
        return self.outputs

    @property
    def reports_path(self) -> str:
        return f"{self.root}/reports/run_id={self.run_id}"

    def clear_reports(self) -> bool:
        """(K6) remove the text reports of this run (the findings table stays)."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.reports_path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
