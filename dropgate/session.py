"""Session helpers: one place for the Spark settings the library relies on.

Nothing here is needed on a managed cluster (the cluster's own defaults win);
``get_spark`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are designed around. AQE re-plans joins at runtime
# (broadcast when a side turns out small, splits skewed partitions of
# sort-merge joins) and coalesces the many small shuffle partitions that
# per-file aggregates produce.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Registry plans carry many aliased expressions over the same columns
    # (glob matches, per-check aggregates); inferring constraints over all of
    # them grows combinatorially in the optimizer. Filters are pushed
    # explicitly by the library, so this inference is not needed.
    "spark.sql.constraintPropagation.enabled": "false",
    # A CSV row with too many / too few fields is only flagged as malformed
    # when the parser sees every token; with parser-level column pruning a
    # query touching a few columns silently accepts such rows.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # The two passes over quoted CSV files need ranges that follow from one
    # setting alone (see sources/csvscan.py); CSV is slow to parse, so they
    # are smaller than Spark's default.
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.files.openCostInBytes": "8m",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "dropgate", extra: dict | None = None) -> SparkSession:
    """Get or create a session; set a checkpoint dir only where none is set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> bool:
    """Send the package to the workers, unless they find it by PYTHONPATH (or, locally, in the working folder).

    Spark hands the archive to every executor itself; the driver's copy is not read again.
    """
    import dropgate

    root = os.path.dirname(os.path.dirname(os.path.realpath(dropgate.__file__)))
    found = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if spark.sparkContext.master.startswith("local"):
        found.add(os.path.realpath(os.getcwd()))
    sc = spark.sparkContext
    if root in found or getattr(sc, "_dropgate_shipped", False):
        return False
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "dropgate-package"), "zip", root, "dropgate"))
    sc._dropgate_shipped = True
    return True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or ``DROPGATE_CHECKPOINT_DIR``) is used as is. Only
    a local master, where driver and tasks share one disk, gets a folder of
    its own choice; elsewhere an unset folder is an error, as intermediate
    tables on a node's own disk are lost to the other nodes.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("DROPGATE_CHECKPOINT_DIR")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "/tmp/dropgate-checkpoints"
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's folder of intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/dropgate/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for derived tables."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables; frames that read them end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
