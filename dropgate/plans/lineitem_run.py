"""A full preboarding run over a CSV drop derived from the lineitem table.

Used by the benchmark and the tests: lineitem is written as CSV files (one
folder per return flag, whatever flags there are, several part files each),
then validated, routed, enriched from ``part``, re-validated and delivered by
flag. Files of other flags than A and N have no routing pattern and are
rejected, so the delivered rows are exactly the A and N lineitems, enriched.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dropgate.plans.stages import Preboarding
from dropgate.session import scratch_path
from dropgate.sources.catalog import Catalog, TableSpec

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

STEPS = [
    ("0_validator", "validate", {"*sales*": {
        "validators": {
            "is_empty_dataframe": None,
            "required_columns": ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"],
            "additional_columns": LINEITEM_COLS,
            "column_types": {"l_orderkey": "long", "l_partkey": "long", "l_quantity": "double",
                             "l_extendedprice": "double", "l_discount": "double"},
            "validate_product_ids": {"product_id_column": "l_partkey", "product_id_master_column": "p_partkey",
                                     "master_table": "static.mappings.part"},
        },
        "schema": {"l_orderkey": "long", "l_partkey": "long", "l_suppkey": "long", "l_linenumber": "int",
                   "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double"},
    }}),
    # files of flag R match no pattern: they are rejected at routing
    ("1_dispatcher", "dispatch", {"*_sales_A/*": "SALES/A", "*_sales_N/*": "SALES/N"}),
    ("2_transform", "transform", {"SALES/*": {"transforms": [
        {"name": "enrich", "function": "enrich_with_mapping", "order": 1,
         "params": {"mapping_file": "D.static.mappings.part", "df_join_column": ["l_partkey"],
                    "mapping_key_column": ["p_partkey"], "columns_to_add": ["p_name", "p_brand"]}},
        {"name": "strip", "function": "strings_strip_whitespace", "order": 2, "params": {"columns": ["p_name"]}},
        {"name": "upper", "function": "case_transform", "order": 3,
         "params": {"columns": ["p_name", "p_brand"], "to_uppercase": True}},
        {"name": "total", "function": "multiply_columns", "order": 4,
         "params": {"columns_to_multiply": ["l_extendedprice", "l_quantity"], "output_column": "total_sales"}},
    ]}}),
    ("3_validation", "validate", {"SALES/*": {"validators": {
        "value_range": {"l_quantity": {"min": 1, "max": 50}, "l_discount": {"min": 0, "max": 0.1}},
        "check_null_values": {"columns": ["p_name", "l_quantity"], "custom_null_values": ["", "NA", "NULL"]},
    }}}),
    ("4_dispatcher", "dispatch", {"SALES/A/*": "DELIVERY/A", "SALES/N/*": "DELIVERY/N"}),
]


def write_drop(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """lineitem as a CSV drop: ``folder=lineitem_sales_<flag>/part-*.csv``."""
    root = root or scratch_path(spark, "lineitem_drop")
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*LINEITEM_COLS)
    # the flag stays a column of the files; a copy names the folder
    flag = F.concat(F.lit("lineitem_sales_"), F.coalesce("l_returnflag", F.lit("none")))
    (li.withColumn("folder", flag).repartition(8).write.mode("overwrite").partitionBy("folder")
     .option("header", "true").option("sep", ";").csv(root))
    return root


def run(spark: SparkSession, sf_dir: str, drop: str, out_root: str | None = None,
        run_id: str = "bench") -> Preboarding:
    cat = Catalog(spark, {"static.mappings.part": TableSpec(path=f"{sf_dir.rstrip('/')}/part.parquet", required=True)})
    pb = Preboarding(spark, out_root or scratch_path(spark, "lineitem_run"), catalog=cat, run_id=run_id)
    pb.run(drop, STEPS)
    return pb


def delivered(spark: SparkSession, pb: Preboarding, step: str = "4_dispatcher"):
    """Delivered rows with their target folder instead of the part-file name."""
    out = spark.read.parquet(f"{pb.staging(step)}/*")
    return out.withColumn("target", F.regexp_extract("_source_file", r"^(.*)/[^/]+$", 1)).drop("_source_file")


def preboarding_run(spark: SparkSession, sf_dir: str):
    drop = write_drop(spark, sf_dir)
    pb = run(spark, sf_dir, drop, run_id="q")
    return delivered(spark, pb)
