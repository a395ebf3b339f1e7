"""Incremental validation of drops that keep arriving in a folder.

The original tool re-runs a batch over the input folder. Here the same
validation step runs per micro-batch of NEW files: the file stream source
remembers which files it has processed (in the checkpoint), and gives each
file whole to one micro-batch, so per-file verdicts are exact. No new
operator is involved: ``foreachBatch`` calls the batch checks. Empty files bring no rows
into a stream, so they get no verdict here; a batch run reports them.

Exactly-once: findings and passing rows are written per batch id with
``overwrite`` of that batch's partition, so a replayed batch (after a
failure) replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dropgate.operators import checks as C
from dropgate.operators import joins
from dropgate.plans.findings import conform, verdicts
from dropgate.sources.files import SOURCE, relative_path


def validate_stream(spark: SparkSession, input_dir: str, schema, validators: dict, out_dir: str,
                    checkpoint: str, fmt: str = "parquet", options: dict | None = None,
                    catalog=None, max_files_per_trigger: int | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Start a stream that validates every new file of ``input_dir``.

    Writes ``{out_dir}/findings/batch=<id>`` and ``{out_dir}/passed/batch=<id>``.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(input_dir).withColumn(SOURCE, relative_path(F.col("_metadata.file_path"), input_dir))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for the findings and the passing rows
        try:
            validate(batch, batch_id)
        finally:
            batch.unpersist()

    def validate(batch: DataFrame, batch_id: int) -> None:
        findings = conform(C.run_checks(batch, validators, key=SOURCE, catalog=catalog),
                           run_id=None, step=f"stream_{batch_id}", key=SOURCE)
        fpath = f"{out_dir}/findings/batch={batch_id}"
        findings.drop("run_id").write.mode("overwrite").parquet(fpath)
        v = verdicts(spark.read.parquet(fpath).withColumn("run_id", F.lit(None).cast("string")))
        ok = v.filter(F.col("passed")).select(F.col("source_file").alias(SOURCE))
        joins.semi_join_small(batch, ok, [SOURCE]).write.mode("overwrite").parquet(
            f"{out_dir}/passed/batch={batch_id}")

    w = rows.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
