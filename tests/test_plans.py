"""The physical plans keep their scale properties (see docs/PLANS.md)."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from dropgate.operators import joins
from dropgate.plans.table_queries import QUERIES

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return re.sub(r"#\d+L?", "", buf.getvalue())  # expression ids removed


def test_chain_broadcasts_and_cleans_mapping_side(spark):
    p = _plan(QUERIES["transform_sales_chain"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # the regex runs under the broadcast (mapping side), not after the join
    head, _, build = p.partition("BroadcastExchange")
    assert "regexp_replace" in build and "regexp_replace" not in head
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double," \
           "l_extendedprice:double>" in p


def test_checks_aggregate_map_side(spark):
    p = _plan(QUERIES["value_range"](spark, SF))
    assert p.index("partial_count") > p.index("Exchange")  # partial aggregate below the exchange
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in p


def test_samples_limited_before_shuffle(spark):
    p = _plan(QUERIES["null_samples"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    lines = p.splitlines()
    partial = max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(dataset, check, column" in line)
    assert partial > exchange  # printed below = runs before the exchange


def test_salted_join_when_not_provably_small(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey")
    skewed = li.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")))
    part = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(joins.left_join(skewed, part, ["l_partkey"], ["p_partkey"], max_broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "__salt" in p and "xxhash64" in p


def test_place_of_the_first_malformed_row_needs_no_sort(spark):
    from dropgate.operators.checks import run_checks
    rows = spark.createDataFrame([("f", 1, 9 << 40, (9 << 40) + 7, "x"), ("f", 2, 5, 1 << 50, "y"), ("f", 3, 5, 1 << 49, "z"), ("f", 4, 1, 0, None),
                                  ("g", 5, 1, 2, None), ("h", 6, (1 << 63) - 1, (1 << 63) - 1, "w")],
                                 "_source_file string, a int, __dg__record long, __dg__offset long, __dg__corrupt string")
    from dropgate.operators.joins import HIDDEN
    rows = rows.toDF(*[c.replace("__dg__", HIDDEN) for c in rows.columns])
    got = run_checks(rows, {"malformed_rows": None})
    assert "SortAggregate" not in _plan(got)
    said = {r["_source_file"]: r["message"] for r in got.collect()}
    assert said["g"] is None
    assert re.findall(r"\d+", said["f"])[-2:] == ["5", str(1 << 49)]
    assert re.findall(r"\d+", said["h"])[-2:] == [str((1 << 63) - 1)] * 2


def test_folders_are_written_unsorted(spark):
    from dropgate.sources.publish import unsorted_partitions
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    for n, kept in ((0, "1"), (3, "3"), (100, "8")):
        with unsorted_partitions(spark, n):
            assert spark.conf.get(key) == kept
    assert spark.conf.get(key) == before
