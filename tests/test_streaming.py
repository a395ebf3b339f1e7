"""Incremental validation: each new file is validated exactly once."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.streaming.incremental import validate_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())])


def _csv(path, rows):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("id;price\n" + "".join(f"{a};{b}\n" for a, b in rows))


def test_new_files_only(spark, tmp_root):
    inp, out = f"{tmp_root}/in", f"{tmp_root}/out"
    os.makedirs(inp)
    rules = {"value_range": {"price": {"min": 0, "max": 100}}, "is_empty_dataframe": None}
    opts = {"header": "true", "sep": ";"}
    _csv(f"{inp}/a_sales.csv", [(1, 5.0), (2, 7.0)])
    validate_stream(spark, inp, SCHEMA, rules, out, f"{out}/_cp", fmt="csv", options=opts).awaitTermination()
    _csv(f"{inp}/b_sales.csv", [(3, 500.0)])
    validate_stream(spark, inp, SCHEMA, rules, out, f"{out}/_cp", fmt="csv", options=opts).awaitTermination()
    f = spark.read.parquet(f"{out}/findings")
    per_batch = {(r["batch"], r["source_file"]) for r in f.select("batch", "source_file").distinct().collect()}
    assert per_batch == {(0, "a_sales.csv"), (1, "b_sales.csv")}
    bad = {r["source_file"] for r in f.filter(~F.col("passed")).collect()}
    assert bad == {"b_sales.csv"}
    passed = spark.read.parquet(f"{out}/passed")
    assert sorted(r["id"] for r in passed.collect()) == [1, 2]
