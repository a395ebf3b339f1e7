"""(R5, R6) Incremental backups: file contents are stored once, runs refer to them.

A file's content address is made of order-independent sums over its rows: the
number of rows and the sums of two row hashes, which take in the names of
the columns. It does not depend on how Spark splits or orders the file. A run
writes the rows of contents that no earlier run stored, and a list of its
files with their addresses; a drop that did not change writes no rows.

Layout: ``contents/stored=<run>`` holds rows with their address, ``files`` the
runs' file lists and ``index`` the stored addresses; both lists are published
atomically (``sources/publish.py``), the index after the rows it names, so a
run that dies leaves nothing that is referred to. A run that is repeated
replaces what it stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.functions.names import col as named
from dropgate.operators.joins import BROADCAST_MAX_ROWS, HIDDEN
from dropgate.sources.catalog import Catalog, TableSpec
from dropgate.sources.files import SOURCE, Dataset, union_by_name

ADDRESS = f"{HIDDEN}address"
RUN = "run"


def addresses(df: DataFrame) -> DataFrame:
    """_source_file, address and n_rows of every file with rows in ``df``.

    One partial aggregation: a file that holds a third of all rows is reduced
    in every task. Columns that only other files have are null in a file's
    rows and do not count.
    """
    data = sorted(c for c in df.columns if c != SOURCE and not c.startswith(HIDDEN))
    # name by name, so a null in a column that the file lacks counts as nothing
    parts = [F.when(named(c).isNotNull(), F.struct(F.lit(c), named(c).cast("string") if "map" in df.schema[c].dataType.simpleString() else named(c))) for c in data]
    one, two = F.xxhash64(*parts), F.xxhash64(F.lit(7919), *parts)  # nulls leave a hash as it is
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    sums = df.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("n_rows"), wide(one).alias("a"), wide(two).alias("b"))
    return sums.select(SOURCE, F.sha2(F.concat_ws("/", "n_rows", "a", "b"), 256).alias(ADDRESS), "n_rows")


class Backups:
    """The backups below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.lists = Catalog(spark, {n: TableSpec(path=f"{self.root}/{n}", published=True, versioned=True) for n in ("files", "index")})

    def _list(self, name: str, without: str | None = None) -> DataFrame | None:
        if not self.lists.exists(name):
            return None
        rows = self.lists._resolve(self.lists.spec(name))
        return rows.filter(F.col("version") != without) if without else rows

    def store(self, ds: Dataset, run: str) -> dict[str, int]:
        """Back up a dataset as ``run``; returns the numbers of files and of rows stored for it."""
        found = addresses(ds.df)
        files = ds.files.select(SOURCE, "size", "__columns").join(found, SOURCE, "left").withColumn(RUN, F.lit(run))
        self.lists.write_version("files", files, run)
        files = self.lists._resolve(self.lists.spec("files")).filter(F.col("version") == run)
        stored = self._list("index", without=run)
        new = files.filter(F.col(ADDRESS).isNotNull())
        if stored is not None:
            new = new.join(stored.select(ADDRESS), ADDRESS, "left_anti")
        # of files with one content the first is stored
        new = new.groupBy(ADDRESS).agg(F.min(SOURCE).alias(SOURCE))
        path = f"{self.root}/contents/stored={run}"
        n_files = len(ds.infos) if ds.infos is not None else files.count()
        side = F.broadcast(new) if n_files <= BROADCAST_MAX_ROWS else new
        rows = ds.df.drop(*[c for c in ds.df.columns if c.startswith(HIDDEN)]).join(side, SOURCE).drop(SOURCE)
        rows.write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(f"{ADDRESS} string").parquet(path).groupBy(ADDRESS).agg(F.count(F.lit(1)).alias("n_rows"))
        self.lists.write_version("index", kept, run)
        row = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
        return {"files": row[0], "rows": row[1]}

    def runs(self) -> list[str]:
        files = self._list("files")
        return [] if files is None else [r[0] for r in files.select("version").distinct().orderBy(F.desc("version")).collect()]

    def restore(self, run: str) -> DataFrame:
        """The rows of ``run`` with their source files, wherever they were stored."""
        if run not in self.runs():
            raise FileNotFoundError(f"backup '{run}' not found; available: {self.runs()}")
        files = self._list("files").filter(F.col("version") == run).select(SOURCE, ADDRESS)
        where = self._list("index").select(ADDRESS, F.col("version").alias("stored"))
        needed = files.join(where, ADDRESS)
        n_files = files.count()
        parts = []
        for (at,) in needed.select("stored").distinct().orderBy("stored").collect():  # runs that hold some of its contents
            mine = needed.filter(F.col("stored") == at).select(SOURCE, ADDRESS)
            rows = self.spark.read.parquet(f"{self.root}/contents/stored={at}")
            parts.append(rows.join(F.broadcast(mine) if n_files <= BROADCAST_MAX_ROWS else mine, ADDRESS).drop(ADDRESS))
        return union_by_name(parts, self.spark)
