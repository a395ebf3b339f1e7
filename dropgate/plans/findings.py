"""The findings table: every check / transform / routing outcome as a row.

Schema (one row per group key × check × column):
  run_id, step, source_file, check, column, severity, passed, n_bad, message, samples
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDINGS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("samples", T.ArrayType(T.StringType())),
])

# The per-key part of a finding (run_id / step / source_file are added around it).
FINDING_FIELDS = ["check", "column", "severity", "passed", "n_bad", "message", "samples"]


def finding_struct(check: str, column: str | None, severity: str, passed: Column,
                   n_bad: Column, message: Column, samples: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        F.lit(severity).alias("severity"),
        passed.cast("boolean").alias("passed"),
        n_bad.cast("long").alias("n_bad"),
        message.cast("string").alias("message"),
        (samples if samples is not None else F.lit(None).cast("array<string>")).alias("samples"),
    )


def conform(df: DataFrame, run_id: str | None, step: str | None, key: str = "source_file") -> DataFrame:
    """Project a per-key findings frame onto FINDINGS_SCHEMA."""
    cols = []
    for f in FINDINGS_SCHEMA.fields:
        if f.name == "run_id":
            cols.append(F.lit(run_id).cast("string").alias("run_id"))
        elif f.name == "step":
            cols.append(F.lit(step).cast("string").alias("step"))
        elif f.name == "source_file":
            cols.append(F.col(key).cast("string").alias("source_file"))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty_findings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FINDINGS_SCHEMA)


def union_all(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def verdicts(findings: DataFrame) -> DataFrame:
    """One row per (run_id, step, source_file): passed iff no finding failed."""
    return (findings.groupBy("run_id", "step", "source_file")
            .agg(F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("passed"),
                 F.count_if(~F.col("passed")).alias("n_failed_checks")))


def run_summary(findings: DataFrame) -> DataFrame:
    """Passed / failed file counts per step."""
    v = verdicts(findings)
    return (v.groupBy("run_id", "step")
            .agg(F.count("*").alias("n_files"),
                 F.count_if(F.col("passed")).alias("n_passed"),
                 F.count_if(~F.col("passed")).alias("n_failed")))


def report_lines(findings: DataFrame) -> DataFrame:
    """(K5) one line of text per failing finding: run_id, step, source_file, line."""
    line = F.concat_ws(": ", F.col("check"), F.coalesce(F.col("message"), F.lit("")))
    return findings.filter(~F.col("passed")).select("run_id", "step", "source_file", "column", "message", "check", line.alias("line"))


def text_report(findings: DataFrame, max_lines: int | None = None) -> DataFrame:
    """Readable per-file report (K5): failing findings' messages, in order.

    Files whose findings all passed get no report. Every line is in the text;
    ``max_lines`` is for callers that want a digest, which then ends with the
    number of further findings.
    """
    from pyspark.sql import Window

    bad = findings.filter(~F.col("passed"))
    keys = ["run_id", "step", "source_file"]
    w = Window.partitionBy(*keys).orderBy("check", "column", "message")
    top = bad.withColumn("rn", F.row_number().over(w))
    if max_lines is not None:
        top = top.filter(F.col("rn") <= max_lines)
    line = F.concat_ws(": ", F.col("check"), F.coalesce(F.col("message"), F.lit("")))
    text = (top.groupBy(*keys)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", line.alias("l")))),
                             lambda x: x["l"]).alias("_lines")))
    if max_lines is None:
        return text.select(*keys, F.concat_ws("\n", F.col("_lines")).alias("report"))
    counts = bad.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    more = F.when(F.col("_n") > max_lines,
                  F.format_string("(+%d more failing findings in the findings table)", F.col("_n") - max_lines))
    return (text.join(counts, keys)
            .select(*keys, F.concat_ws("\n", F.col("_lines"), more).alias("report")))


def write_reports(findings: DataFrame, path: str) -> None:
    """(K5) the failing findings as text files: a folder per step and source file,
    one line per finding, all of them. Rows are written as they are, so a file
    with very many findings is no group in one task's memory."""
    lines = report_lines(findings)
    # the folder name is a path, so separators in file names are escaped by Spark;
    # ranges of lines, so the lines of one file are no single task's work
    order = ["step", "source_file", "check", "column", "message"]
    (lines.repartitionByRange(*order).sortWithinPartitions(*order)
     .select("step", "source_file", "line").write.mode("overwrite").partitionBy("step", "source_file").text(path))
