"""Named tables (mapping files, master data, snapshots) and run partitions.

A catalog maps dotted names (``static.mappings.product_mapping``; a leading
``D.`` is accepted) to a path and a format. Reads are plain lazy
``spark.read`` calls, so column pruning and filters reach the scan.

Versioned tables are folders of ``version=<id>`` partitions. Each version
holds only what it added, so "append" never rewrites (or reads while
overwriting) existing data, and re-running one version overwrites just that
partition: retries are idempotent.

Tables with ``published=True`` are written aside and shown by a manifest
(``sources/publish.py``): readers see the state before a write or the one after
it, also while a write runs or after it died.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from dropgate.errors import TableNotFoundError
from dropgate.functions.names import col as named
from dropgate.sources.files import CSV_READ, CSV_WRITE
from dropgate.sources.publish import Publication


@dataclass
class TableSpec:
    path: str
    format: str = "parquet"
    required: bool = False
    versioned: bool = False
    published: bool = False
    options: dict = field(default_factory=dict)
    schema: dict | None = None


def _norm(name: str) -> str:
    return name[2:] if name.startswith("D.") else name


class Catalog:
    def __init__(self, spark: SparkSession, tables: dict[str, TableSpec | dict] | None = None):
        self.spark = spark
        self.tables: dict[str, TableSpec] = {}
        # resolved readers (file listing + schema) per table; dropped on write
        self._loaded: dict[str, DataFrame] = {}
        for n, t in (tables or {}).items():
            self.register(n, t)

    def register(self, name: str, spec: TableSpec | dict | str) -> None:
        if isinstance(spec, str):
            spec = TableSpec(path=spec)
        elif isinstance(spec, dict):
            spec = TableSpec(**spec)
        self.tables[_norm(name)] = spec

    def spec(self, name: str) -> TableSpec:
        n = _norm(name)
        if n not in self.tables:
            raise TableNotFoundError(f"unknown table '{name}'")
        return self.tables[n]

    # -- reads -------------------------------------------------------------
    def _load(self, spec: TableSpec) -> DataFrame:
        if spec.published:  # others may have published since
            return self._resolve(spec)
        if spec.path in self._loaded:
            return self._loaded[spec.path]
        df = self._resolve(spec)
        self._loaded[spec.path] = df
        return df

    def _forget(self, spec: TableSpec) -> None:
        self._loaded.pop(spec.path, None)

    def _resolve(self, spec: TableSpec) -> DataFrame:
        r, paths = self.spark.read, [spec.path]
        if spec.published:
            paths = Publication(self.spark, spec.path).folders()
            if not paths:
                raise TableNotFoundError(f"nothing is published at {spec.path}")
            if spec.versioned:
                r = r.option("basePath", f"{spec.path.rstrip('/')}/_data")
        if spec.format == "csv":
            opts = {**CSV_READ, "sep": ";", **spec.options}
            df = r.options(**opts).csv(paths)
        else:
            df = r.options(**spec.options).format(spec.format).load(paths)
            if spec.versioned and "version" in df.columns and not isinstance(df.schema["version"].dataType, T.StringType):
                # version ids are text: partition type inference would turn 001 into 1
                as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "version" else f.dataType)
                                        for f in df.schema.fields])
                df = r.schema(as_text).options(**spec.options).format(spec.format).load(paths)
        if spec.schema:
            df = df.withColumns({c: named(c).try_cast(t) for c, t in spec.schema.items() if c in df.columns})
        return df

    def read(self, name: str, version: str | None = None) -> DataFrame:
        """The table (for versioned tables: all versions up to ``version``)."""
        spec = self.spec(name)
        try:
            df = self._load(spec)
        except AnalysisException as e:
            raise TableNotFoundError(f"table '{name}' not found at {spec.path}") from e
        if spec.versioned:
            if version is not None:
                df = df.filter(F.col("version") <= F.lit(version))
            df = df.drop("version")
        return df

    def exists(self, name: str) -> bool:
        try:
            spec = self.spec(name)
        except TableNotFoundError:
            return False
        try:
            self._load(spec)
            return True
        except (AnalysisException, TableNotFoundError):
            return False

    def required_tables(self) -> DataFrame:
        """(S8) one row per table marked required: ``table, present``."""
        rows = [(n, self.exists(n)) for n, s in sorted(self.tables.items()) if s.required]
        return self.spark.createDataFrame(rows, "table string, present boolean")

    # -- writes ------------------------------------------------------------
    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        """(K2) overwrite or append; append adds files, never re-reads."""
        spec = self.spec(name)
        self._forget(spec)
        if spec.published:
            table = Publication(self.spark, spec.path)
            seen, manifest = table.current()
            before = [f"{table.path}/{f}" for f in manifest["folders"]] if manifest and mode == "append" else []
            folder = table.folder()
            self._save(spec, df, folder, "errorifexists")
            table.publish(seen, [*before, folder])
        else:
            self._save(spec, df, spec.path, mode)

    def _save(self, spec: TableSpec, df: DataFrame, path: str, mode: str) -> None:
        w = df.write.mode(mode)
        if spec.format == "csv":
            w.options(**{**CSV_WRITE, "sep": ";", **spec.options}).csv(path)
        else:
            w.format(spec.format).save(path)

    def write_version(self, name: str, df: DataFrame, version: str) -> None:
        """(K3) write ``df`` as version ``version`` (replaces only that version)."""
        spec = self.spec(name)
        self._forget(spec)
        if spec.published:
            table = Publication(self.spark, spec.path)
            seen, manifest = table.current()
            others = [f"{table.path}/{f}" for f in (manifest or {"folders": []})["folders"] if f"/version={version}/" not in f]
            folder = table.folder(f"version={version}")
            self._save(spec, df, folder, "errorifexists")
            table.publish(seen, sorted([*others, folder]))
            return
        (df.write.mode("overwrite").format(spec.format)
         .save(f"{spec.path.rstrip('/')}/version={version}"))

    def versions(self, name: str) -> DataFrame:
        """``version, n_rows`` of a versioned table (rows each version added).

        Versions come from the folder listing, so a version that added
        nothing is listed with 0 rows.
        """
        from dropgate.sources.files import list_files

        spec = self.spec(name)
        if spec.published:
            folders = Publication(self.spark, spec.path).folders() or []
            paths = self.spark.createDataFrame([(f + "/",) for f in folders], "path string")
        else:
            paths = list_files(self.spark, spec.path)
        listed = (paths
                  .select(F.regexp_extract("path", r"/version=([^/]+)/", 1).alias("version"))
                  .filter(F.col("version") != "").distinct())
        counts = self._load(spec).groupBy("version") \
            .agg(F.count(F.lit(1)).alias("n_rows"))
        return listed.join(counts, "version", "left").select(
            "version", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))

    def delete(self, name: str) -> None:
        """(K4) explicit drop of a table's data; never called from a check."""
        spec = self.spec(name)
        self._forget(spec)
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(spec.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(p, True)


def list_runs(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """(S9) distinct ``run_id=`` partitions under ``root``, newest first.

    Found from the file listing alone (no data is read, no job runs);
    ``run_index`` is -1 for the latest run, -2 for the one before, and so on.
    """
    from dropgate.sources.files import list_file_infos

    runs = sorted({m.group(1) for f in list_file_infos(spark, root)
                   if (m := re.search(r"/run_id=([^/]+)/", f.path or ""))}, reverse=True)
    if limit is not None:
        runs = runs[:limit]
    return spark.createDataFrame([(r, -(i + 1)) for i, r in enumerate(runs)], "run_id string, run_index int")


def resolve_run(spark: SparkSession, root: str, run: str | int) -> str:
    """A run's id from an id or a negative index (-1 is the latest)."""
    from dropgate.errors import TableNotFoundError as Missing

    runs = [r["run_id"] for r in list_runs(spark, root).collect()]
    if isinstance(run, int) or re.fullmatch(r"-[0-9]+", str(run)):
        i = -int(run)
        if not 1 <= i <= len(runs):
            raise Missing(f"run index {run} is out of range; there are {len(runs)} run(s)")
        return runs[i - 1]
    if run not in runs:
        raise Missing(f"unknown run '{run}'; available: {runs}")
    return run


def read_run(spark: SparkSession, root: str, run: str | int = -1) -> DataFrame:
    """(S9) the rows of an earlier run below ``root`` (``run_id=`` folders), by id or negative index."""
    return spark.read.parquet(f"{root.rstrip('/')}/run_id={resolve_run(spark, root, run)}")
