"""The library's operators bound to the driver's tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` built with the library's own
API (checks, transforms, joins, routing, snapshots, sources) over whole
tables; ``ORACLE_SQL`` holds the equivalent DuckDB SQL with the same column
names. Checks are bound with a table column playing the role of the source
file (``dataset``), so per-file semantics are exercised on real data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.functions.strings import DEFAULT_NULL_MARKERS
from dropgate.operators import checks as C
from dropgate.operators import routing, snapshot
from dropgate.operators.aggregate import aggregate
from dropgate.operators.transforms import TransformContext, apply_chain, distinct_examples, enrich, transform
from dropgate.plans.findings import run_summary, text_report, verdicts, conform
from dropgate.session import scratch_path
from dropgate.sources.catalog import Catalog, TableSpec
from dropgate.sources.files import list_files, read_drop, typed
from dropgate.sources.publish import unsorted_partitions

FINDING_OUT = ["dataset", "check", "column", "passed", "n_bad"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _catalog(spark: SparkSession, sf: str) -> Catalog:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
    return Catalog(spark, {f"static.mappings.{n}": TableSpec(path=f"{sf.rstrip('/')}/{n}.parquet", required=True)
                           for n in names})


def _chain(spark, sf, df, spec):
    out, log = apply_chain(df, spec, TransformContext(catalog=_catalog(spark, sf)))
    failed = [e for _, ok, e in log if not ok]
    if failed:
        raise ValueError("; ".join(failed))
    return out


def _checks(df: DataFrame, spec, **kw) -> DataFrame:
    return C.run_checks(df, spec, key="dataset", **kw).select(*FINDING_OUT)


# ---------------------------------------------------------------- sources

def scan_parquet(spark, sf):
    return (_catalog(spark, sf).read("D.static.mappings.orders")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))


def scan_csv_roundtrip(spark, sf):
    """Orders written as a CSV drop with two header layouts, read back typed."""
    root = scratch_path(spark, "csv_drop")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    (o.filter(F.col("o_orderstatus") == "F").write.option("header", "true").option("sep", ";")
     .csv(f"{root}/FR/orders_F"))
    (o.filter(F.col("o_orderstatus") != "F")
     .select("o_orderpriority", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
     .write.option("header", "true").option("sep", ";").csv(f"{root}/US/orders_other"))
    ds = read_drop(spark, root, sep=";")
    schema = {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double"}
    return typed(ds.df, schema).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def corrupt_rows(spark, sf):
    """(S5) Orders as a CSV drop in which status-P rows carry the separator in
    a text value, written unquoted: those rows have one field too many."""
    root = scratch_path(spark, "corrupt_drop")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderstatus") == "P",
                                               F.concat("o_orderpriority", F.lit(";"), "o_orderstatus"))
                     .otherwise(F.col("o_orderpriority")))
    w = lambda df, path: df.write.option("header", "true").option("sep", ";").option("quote", "").csv(path)
    w(o.filter(F.col("o_orderstatus") == "F"), f"{root}/orders_F")
    w(o.filter(F.col("o_orderstatus") != "F"), f"{root}/orders_other")
    ds = read_drop(spark, root, sep=";")
    rows = ds.df.withColumn("dataset", F.regexp_extract("_source_file", r"^([^/]+)/", 1))
    return _checks(rows, {"malformed_rows": None})


def list_runs_query(spark, sf):
    """(S9) Orders backed up as one run per order status; runs listed newest
    first with their row counts."""
    from dropgate.sources.catalog import list_runs
    root = scratch_path(spark, "runs")
    (_t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
     .withColumn("run_id", F.concat(F.lit("run_"), "o_orderstatus"))
     .write.partitionBy("run_id").parquet(root))
    counts = spark.read.parquet(root).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return list_runs(spark, root).join(counts, "run_id")


def csv_quoting(spark, sf):
    """Documents as a CSV drop, with their real quotes and line breaks in the
    text, a separator and a quote in a header and doubled quotes in values."""
    root = scratch_path(spark, "quoting_drop")
    d = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit('"'), "lang", F.lit('"; ')).alias('la"n;g'), "text")
    (d.repartition(4).write.option("header", "true").option("sep", ";").option("escape", '"')
     .option("ignoreTrailingWhiteSpace", "false").csv(root))
    rows = read_drop(spark, root, sep=";").df
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col('la"n;g').alias("lang"),
                       F.sha2(F.col("text"), 256).alias("text_sha"))


# ---------------------------------------------------------------- routing

def pattern_match(spark, sf):
    c = _t(spark, sf, "customer")
    paths = (c.select(F.concat(F.lit("FR_sales_"), "c_name").alias("p"))
             .union(c.select(F.concat("c_name", F.lit("_inventory_sales")).alias("p"))))
    return routing.match_patterns(paths, ["*sales*", "*inventory*"], path_col="p").select("p", "n_matches")


def dispatch_by_pattern(spark, sf):
    o = _t(spark, sf, "orders")
    r = routing.route(o, {"1-*": "URGENT", "5-*": "LOW"}, path_col="o_orderpriority")
    return r.select("o_orderkey", F.coalesce("target", F.lit("REJECT")).alias("target"))


def dispatch_rejects(spark, sf):
    o = _t(spark, sf, "orders")
    paths = o.select(F.concat("o_orderpriority", F.lit("/"), "o_orderstatus", F.lit("_orders.csv")).alias("p")).distinct()
    f = routing.routing_findings(paths, ["1-*", "*URGENT*", "5-*"], path_col="p")
    return f.select("p", "passed", "n_bad")


# ---------------------------------------------------------------- transforms

def strip_whitespace(spark, sf):
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit("\t "), ).alias("c_name"))
    return _chain(spark, sf, c, [{"function": "strings_strip_whitespace", "params": {"columns": ["c_name"]}}])


def case_upper(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return _chain(spark, sf, p, [{"function": "case_transform",
                                  "params": {"columns": ["p_name", "p_brand", "not_there"], "to_uppercase": True}}])


def case_lower(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return _chain(spark, sf, c, [{"function": "case_transform",
                                  "params": {"columns": ["c_mktsegment"], "to_lowercase": True}}])


def _li_keys(spark, sf, *cols):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)


def multiply_columns(spark, sf):
    df = _chain(spark, sf, _li_keys(spark, sf, "l_extendedprice", "l_quantity"),
                [{"function": "multiply_columns",
                  "params": {"columns_to_multiply": ["l_extendedprice", "l_quantity"], "output_column": "total_sales"}}])
    return df.select("l_orderkey", "l_linenumber", "total_sales")


def sum_columns(spark, sf):
    df = _chain(spark, sf, _li_keys(spark, sf, "l_discount", "l_tax"),
                [{"function": "sum_columns", "params": {"columns_to_sum": ["l_discount", "l_tax"], "output_column": "adj"}}])
    return df.select("l_orderkey", "l_linenumber", "adj")


def subtract_columns(spark, sf):
    df = _chain(spark, sf, _li_keys(spark, sf, "l_extendedprice", "l_discount", "l_tax"),
                [{"function": "subtract_columns",
                  "params": {"minuend_column": "l_extendedprice", "subtrahend_columns": ["l_discount", "l_tax"],
                             "output_column": "net"}}])
    return df.select("l_orderkey", "l_linenumber", "net")


def divide_columns(spark, sf):
    df = _chain(spark, sf, _li_keys(spark, sf, "l_extendedprice", "l_discount"),
                [{"function": "divide_columns",
                  "params": {"numerator_column": "l_extendedprice", "denominator_column": "l_discount",
                             "output_column": "ratio"}}])
    return df.select("l_orderkey", "l_linenumber", "ratio")


def drop_columns(spark, sf):
    return _chain(spark, sf, _t(spark, sf, "orders"),
                  [{"function": "drop_columns", "params": {"columns": ["o_totalprice", "o_orderdate"]}}])


def rename_columns(spark, sf):
    return _chain(spark, sf, _t(spark, sf, "supplier"),
                  [{"function": "rename_columns",
                    "params": {"column_mapping": {"s_suppkey": "supplier_id", "s_name": "supplier_name"}}}])


def filter_rows(spark, sf):
    return _chain(spark, sf, _t(spark, sf, "orders"),
                  [{"function": "filter_rows", "params": {"column": "o_totalprice", "operator": ">", "value": 200000}}])


def drop_nulls(spark, sf):
    e = _t(spark, sf, "events").select("event_id", F.expr("nullif(event_type, 'click')").alias("et"))
    return _chain(spark, sf, e, [{"function": "drop_nulls", "params": {"subset": ["et"]}}])


def blank(spark, sf):
    return _chain(spark, sf, _t(spark, sf, "supplier"), [{"function": "blank"}])


def transform_sales_chain(spark, sf):
    """The shipped sales chain, re-bound: enrich → strip → upper → multiply."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    spec = [
        {"name": "enrich_with_mapping", "function": "enrich_with_mapping", "order": 1,
         "params": {"mapping_file": "D.static.mappings.part", "df_join_column": ["l_partkey"],
                    "mapping_key_column": ["p_partkey"], "columns_to_add": ["p_name", "p_brand"]}},
        {"name": "strings_strip_whitespace", "function": "strings_strip_whitespace", "order": 2,
         "params": {"columns": ["p_name", "p_brand"], "strip_whitespace": True}},
        {"name": "case_transform", "function": "case_transform", "order": 3,
         "params": {"columns": ["p_name", "p_brand"], "to_uppercase": True}},
        {"name": "total_sales_calculation", "function": "multiply_columns", "order": 4,
         "params": {"columns_to_multiply": ["l_extendedprice", "l_quantity"], "output_column": "total_sales"}},
    ]
    out = _chain(spark, sf, li, spec)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand", "total_sales")


@transform("net_price")
def _net_price(df, ctx, price_column: str, discount_column: str, output_column: str):
    """Example of a user transform registered with the decorator."""
    return df.withColumn(output_column, F.col(price_column) * (F.lit(1) - F.col(discount_column)))


def custom_transform(spark, sf):
    df = _chain(spark, sf, _li_keys(spark, sf, "l_extendedprice", "l_discount"),
                [{"function": "net_price", "params": {"price_column": "l_extendedprice",
                                                      "discount_column": "l_discount", "output_column": "net"}}])
    return df.select("l_orderkey", "l_linenumber", "net")


# ---------------------------------------------------------------- joins

def enrich_mapping(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return enrich(li, _t(spark, sf, "part"), "l_partkey", "p_partkey", ["p_name", "p_brand"])


def enrich_mapping_multikey(spark, sf):
    c = _t(spark, sf, "customer")
    seg = (c.groupBy(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
           .agg(F.count(F.lit(1)).alias("n_customers")))
    out = enrich(c.select("c_custkey", "c_nationkey", "c_mktsegment"), seg,
                 ["c_nationkey", "c_mktsegment"], ["nationkey", "segment"], ["n_customers"])
    return out.select("c_custkey", "n_customers")


def _shifted_part(spark, sf):
    """All parts, those of sizes above 25 under negative keys that no lineitem has."""
    p = _t(spark, sf, "part")
    return p.withColumn("p_partkey", F.when(F.col("p_size") <= 25, F.col("p_partkey")).otherwise(-F.col("p_partkey") - 1))


def enrich_unmatched(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_partkey")
    out = enrich(li, _shifted_part(spark, sf), "l_partkey", "p_partkey", ["p_name"], hit_column="__hit")
    return out.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("__hit").isNull()).alias("unmatched"))


def enrich_examples(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_partkey")
    out = enrich(li, _shifted_part(spark, sf), "l_partkey", "p_partkey", ["p_name"], hit_column="__hit")
    return distinct_examples(out, "l_returnflag", ["l_partkey"], F.col("__hit").isNull(), k=3)


def referential_missing_ids(spark, sf):
    return C.missing_ids(_t(spark, sf, "lineitem"), "l_partkey", _shifted_part(spark, sf), "p_partkey")


def cross_consistency(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return C.key_overlap(c, o, ["c_custkey"])


def referential_large_master(spark, sf):
    """The master is not broadcast: a bit filter of the ids goes over it before the shuffle."""
    return C.missing_ids(_t(spark, sf, "part"), "p_partkey", _t(spark, sf, "orders"), "o_custkey", max_broadcast_rows=0)


def cross_large_right(spark, sf):
    li = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("s"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("s"))
    return C.key_overlap(c, li, ["k", "s"], max_broadcast_rows=0)


def snapshot_compacted(spark, sf):
    """Twelve runs over the orders, by month; the first ones are merged into a bitmap on the way. The month's ids
    that are new, and all ids known after it."""
    cat = Catalog(spark, {"snap": TableSpec(path=scratch_path(spark, "snapshot-bitmap"), versioned=True)})
    orders = _t(spark, sf, "orders").withColumn("month", F.coalesce(F.month("o_orderdate"), F.lit(12)))
    got = [snapshot.append_new_ids(cat, "snap", orders.filter(F.col("month") == m), "o_custkey", version=f"{m:02d}") for m in range(1, 13)]
    return spark.createDataFrame([(g["version"], g["n_new"], g["n_total"]) for g in got], "version string, n_new long, n_total long")


def snapshot_union(spark, sf):
    ids = _t(spark, sf, "lineitem")
    old = _shifted_part(spark, sf).select("p_partkey")
    return snapshot.snapshot_union(ids, old, "l_partkey", "id")


def snapshot_new_ids(spark, sf):
    ids = _t(spark, sf, "lineitem")
    old = _shifted_part(spark, sf).select("p_partkey")
    return snapshot.new_ids(ids, old, "l_partkey", "id")


def snapshot_versions(spark, sf):
    """Three runs append the part keys they see, by line number; each version stores
    only its new ids. Version ids that look like numbers stay text."""
    cat = Catalog(spark, {"snap": TableSpec(path=scratch_path(spark, "snapshot"), versioned=True)})
    li = _t(spark, sf, "lineitem")
    third = F.coalesce(F.col("l_linenumber") % 3, F.lit(0))
    for k, v in enumerate(("001", "002", "010")):
        snapshot.append_new_ids(cat, "snap", li.filter(third == k), "l_partkey", version=v)
    return cat.versions("snap")


def _written_runs(spark, sf, root):
    """Orders as CSV files: equal base names in two folders, three column layouts."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    layouts = {"F": ["o_orderkey", "o_totalprice"], "O": ["o_orderkey", "o_custkey"], "P": ["o_custkey", "o_orderkey", "o_totalprice"]}
    other = ~F.col("o_orderstatus").isin(list(layouts)) | F.col("o_orderstatus").isNull()
    for status, cols in layouts.items():
        mine = (F.col("o_orderstatus") == status) | other if status == "P" else F.col("o_orderstatus") == status
        for half in (0, 1):
            part = o.filter(mine & (F.col("o_orderkey") % 2 == half)).select(*cols)
            target = f"{root}/half{half}/{status}"
            part.coalesce(1).write.option("header", "true").option("sep", ";").csv(target)
    _same_names(spark, root)
    return root


def _same_names(spark, root):
    """Give the part files of each folder one name, so base names are equal across folders."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in list_files(spark, root).collect():
        p = jvm.org.apache.hadoop.fs.Path(f["path"])
        p.getFileSystem(conf).rename(p, jvm.org.apache.hadoop.fs.Path(p.getParent(), "orders.csv"))


def dispatch_multi_layout(spark, sf):
    """Every file to one target, whatever its columns and name: no row is lost."""
    from dropgate.plans.stages import Preboarding
    root = _written_runs(spark, sf, scratch_path(spark, "layouts"))
    pb = Preboarding(spark, scratch_path(spark, "layouts_run"), run_id="q")
    pb.run(root, [("check", "validate", {"*": {"validators": {"is_empty_dataframe": None}}}),
                  ("route", "dispatch", {"*": "ALL"}), ("deliver", "dispatch", {"ALL/*": "OUT"})])
    out = spark.read.option("mergeSchema", "true").parquet(f"{pb.staging('deliver')}/*")
    return out.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"),
                      F.col("o_totalprice").cast("double").alias("o_totalprice"))


def enrich_salted_multikey(spark, sf):
    """The salted join over keys of unlike types (text with leading zeros against numbers)."""
    from dropgate.operators import joins
    c = _t(spark, sf, "customer")
    left = c.select("c_custkey", F.format_string("%05d", "c_nationkey").alias("nation"), "c_mktsegment")
    seg = (c.groupBy(F.col("c_nationkey").cast("int").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
           .agg(F.count(F.lit(1)).alias("n_customers")))
    out = joins.left_join(left, seg, ["nation", "c_mktsegment"], ["nationkey", "segment"], max_broadcast_rows=0)
    return out.select("c_custkey", "n_customers")


def value_range_text(spark, sf):
    """A numeric range over text: values that are no number fail."""
    d = _t(spark, sf, "documents").select(
        F.col("lang").alias("dataset"), F.when(F.col("doc_id") % 7 == 0, F.col("source")).otherwise(F.col("n_chars").cast("string")).alias("size"))
    return _checks(d, {"value_range": {"size": {"min": 100, "max": 5000}}})


def schema_fails_bad_values(spark, sf):
    """A declared type is a rule: files with values that typing would erase are not delivered."""
    from dropgate.plans.stages import Preboarding
    root = scratch_path(spark, "typed_drop")
    o = _t(spark, sf, "orders").select("o_orderkey", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0), F.lit("test"))
                                       .otherwise(F.col("o_totalprice").cast("string")).alias("price"), "o_orderstatus")
    with unsorted_partitions(spark):  # a file a status, its rows written as they come
        o.withColumn("status", F.col("o_orderstatus")).repartition("status").write.partitionBy("status").option("header", "true").option("sep", ";").csv(root)
    pb = Preboarding(spark, scratch_path(spark, "typed_run"), run_id="q")
    pb.run(root, [("check", "validate", {"*": {"validators": {"value_range": {"price": {"min": 0}}}, "schema": {"price": "double", "o_orderkey": "long"}}}),
                  ("deliver", "dispatch", {"*": "OUT"})])
    return spark.read.parquet(f"{pb.staging('deliver')}/*").select("o_orderkey", "price", "o_orderstatus")


def snapshot_two_patterns(spark, sf):
    """Two patterns of a run save ids to one table: one version with the union."""
    from dropgate.plans.stages import Preboarding
    root = scratch_path(spark, "ids_drop")
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_linenumber") % 2).alias("half"))
    for half, keep in ((0, ["l_partkey"]), (1, ["l_partkey", "l_suppkey"])):
        li.filter(F.coalesce("half", F.lit(0)) == half).select(*keep).write.option("header", "true").option("sep", ";").csv(f"{root}/kind{half}")
    cat = Catalog(spark, {"ids": TableSpec(path=scratch_path(spark, "ids"), versioned=True)})
    pb = Preboarding(spark, scratch_path(spark, "ids_run"), catalog=cat, run_id="q")
    save = [{"function": "save_inventory_snapshot", "params": {"snapshot_file": "ids", "product_id_column": "l_partkey"}}]
    pb.run(root, [("keep", "transform", {"kind0/*": {"transforms": save}, "kind1/*": {"transforms": save}})])
    return cat.read("ids").select(F.col("l_partkey").cast("long").alias("id"))


def restored_run(spark, sf):
    """A run over the backup of an earlier one delivers the same rows."""
    from dropgate.plans.stages import Preboarding
    root, back = _written_runs(spark, sf, scratch_path(spark, "first")), scratch_path(spark, "first_backup")
    steps = [("deliver", "dispatch", {"*": "OUT"})]
    Preboarding(spark, scratch_path(spark, "first_run"), run_id="one").run(root, steps, backup_root=back)
    pb = Preboarding(spark, scratch_path(spark, "second_run"), run_id="two")
    pb.run(None, steps, backup_root=back, restore_from=-1)
    out = spark.read.option("mergeSchema", "true").parquet(f"{pb.staging('deliver')}/*")
    return out.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"),
                      F.col("o_totalprice").cast("double").alias("o_totalprice"))


def enrich_report_counts(spark, sf):
    """The unmatched count of an enrichment, although later steps drop its rows and columns."""
    from dropgate.plans.stages import Preboarding
    root = scratch_path(spark, "report_drop")
    _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey").write.option("header", "true").option("sep", ";").csv(f"{root}/sales")
    part = scratch_path(spark, "report_part")
    _shifted_part(spark, sf).select("p_partkey", "p_name").write.parquet(part)
    cat = Catalog(spark, {"part": TableSpec(path=part)})
    pb = Preboarding(spark, scratch_path(spark, "report_run"), catalog=cat, run_id="q")
    pb.run(root, [("t", "transform", {"*": {"transforms": [
        {"name": "enrich", "order": 1, "function": "enrich_with_mapping",
         "params": {"mapping_file": "part", "df_join_column": ["l_partkey"], "mapping_key_column": ["p_partkey"], "columns_to_add": ["p_name"]}},
        {"name": "rename", "order": 2, "function": "rename_columns", "params": {"column_mapping": {"p_name": "name"}}},
        {"name": "full", "order": 3, "function": "drop_nulls", "params": {"subset": ["name"]}},
        {"name": "drop", "order": 4, "function": "drop_columns", "params": {"columns": ["name", "l_partkey"]}}]}})])
    kept = spark.read.parquet(f"{pb.staging('t')}/*").agg(F.count(F.lit(1)).alias("kept"))
    bad = pb.findings().filter(F.col("check") == "enrich").agg(F.sum("n_bad").alias("unmatched"))
    return kept.join(bad, F.lit(True)).select("kept", "unmatched")


def missing_id_findings(spark, sf):
    """Every missing id is a finding, beside one verdict per dataset."""
    path = scratch_path(spark, "master_part")
    _shifted_part(spark, sf).select("p_partkey").write.parquet(path)
    cat = Catalog(spark, {"m": TableSpec(path=path)})
    d = _li_dataset(spark, sf).select("dataset", "l_partkey")
    return _checks(d, {"validate_product_ids": {"product_id_column": "l_partkey", "product_id_master_column": "p_partkey", "master_table": "m"}},
                   catalog=cat)


def table_append(spark, sf):
    cat = Catalog(spark, {"t": TableSpec(path=scratch_path(spark, "append"))})
    p = _t(spark, sf, "part")
    cat.write("t", p.filter(F.col("p_size") <= 25), mode="overwrite")
    cat.write("t", p.filter(F.col("p_size") > 25), mode="append")
    return cat.read("t")


def backup_restore(spark, sf):
    from dropgate.plans.stages import backup, restore
    root = scratch_path(spark, "backup")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    backup(o.withColumn("_source_file", F.concat(F.lit("orders_"), "o_orderstatus", F.lit(".csv"))),
           root, run_id="20250101_000000")
    return restore(spark, root, "20250101_000000").drop("_source_file")


# ---------------------------------------------------------------- checks

def _li_dataset(spark, sf):
    return _t(spark, sf, "lineitem").withColumn("dataset", F.col("l_returnflag"))


def always_true(spark, sf):
    return _checks(_t(spark, sf, "orders").withColumn("dataset", F.col("o_orderstatus")),
                   {"always_true_validator": None})


def always_false(spark, sf):
    return _checks(_t(spark, sf, "orders").withColumn("dataset", F.col("o_orderstatus")),
                   {"always_false_validator": None})


def required_columns(spark, sf):
    return _checks(_li_dataset(spark, sf), {"required_columns": ["l_orderkey", "l_partkey", "price"]})


def additional_columns(spark, sf):
    return _checks(_t(spark, sf, "orders").withColumn("dataset", F.col("o_orderstatus")),
                   {"additional_columns": ["o_orderkey", "o_custkey"]})


def empty_check(spark, sf):
    """Every customer segment is a 'file'; segments whose rows are all
    filtered away must still get a (failing) verdict."""
    c = _t(spark, sf, "customer")
    keys = c.select(F.col("c_mktsegment").alias("dataset")).distinct()
    rows = (c.filter((F.col("c_acctbal") > 5000) & F.col("c_mktsegment").like("%U%"))
            .select(F.col("c_mktsegment").alias("dataset"), "c_custkey"))
    return _checks(rows, {"is_empty_dataframe": None}, keys_df=keys)


def value_range(spark, sf):
    return _checks(_li_dataset(spark, sf).select("dataset", "l_quantity"),
                   {"value_range": {"l_quantity": {"min": 5, "max": 45}}})


def null_check(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("dataset"), F.expr("nullif(lang, 'de')").alias("lang"))
    return _checks(d, {"check_null_values": ["lang"]})


CUSTOM_MARKERS = DEFAULT_NULL_MARKERS + ["en"]


def null_check_custom(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("dataset"), "lang")
    return _checks(d, {"check_null_values": {"columns": ["lang"], "custom_null_values": CUSTOM_MARKERS}})


def null_samples(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("dataset"), "doc_id", "lang")
    f = C.run_checks(d, {"check_null_values": {"columns": ["lang"], "custom_null_values": CUSTOM_MARKERS}},
                     key="dataset", sample_cols=["doc_id"])
    return f.select("dataset", F.posexplode("samples").alias("sample_rank", "sample")) \
        .select("dataset", (F.col("sample_rank") + 1).alias("sample_rank"), "sample")


def column_types(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("dataset"),
                                          F.col("n_chars").cast("string").alias("n_chars"), "lang")
    return _checks(d, {"column_types": {"n_chars": "long", "lang": "long"}})


def hierarchy_violations(spark, sf):
    return C.hierarchy_violations(_t(spark, sf, "part"), ["p_type"], ["p_brand"])


def hierarchy_ok(spark, sf):
    v = C.hierarchy_violations(_t(spark, sf, "customer"), ["c_nationkey"], ["c_custkey"])
    return v.agg(F.count(F.lit(1)).alias("n_violations"))


def hierarchy_check(spark, sf):
    d = _t(spark, sf, "part").withColumn("dataset", F.col("p_size") % 5 == 0)
    d = d.withColumn("dataset", F.when(F.col("dataset"), "size5").otherwise("other"))
    f = C.run_checks(d, {"check_hierarchy": {"higher_level_columns": ["p_type"], "lower_level_columns": ["p_brand"]}},
                     key="dataset")
    return f.filter(F.col("check") == "check_hierarchy.violation").select("dataset", "column", "n_bad")


def duplicate_rows(spark, sf):
    e = _t(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts"))
    return C.duplicate_row_count(e, ["user_id", "event_type", "day"])


@C.check("positive_quantity")
def _positive_quantity(ctx, params=None):
    """Example of a user check registered with the decorator."""
    col = (params or {}).get("column", "l_quantity")
    n = F.coalesce(ctx.agg(F.count_if(F.col(col) <= 0)), F.lit(0))
    ctx.finding(col, passed=n == 0, n_bad=n, message=F.when(n > 0, F.lit("non-positive values")))


def custom_check(spark, sf):
    d = _li_dataset(spark, sf).withColumn("q", F.col("l_quantity") - 10)
    return _checks(d, {"positive_quantity": {"column": "q"}})


def _verdict_registry():
    return {
        "is_empty_dataframe": None,
        "required_columns": ["l_orderkey", "l_quantity", "l_discount"],
        "value_range": {"l_quantity": {"min": 1, "max": 50}, "l_discount": {"max": 0.09}},
        "check_null_values": {"columns": ["l_shipdate"], "custom_null_values": DEFAULT_NULL_MARKERS},
    }


def _verdict_input(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.withColumn("_source_file", F.concat(F.lit("lineitem_"), "l_returnflag", "l_linestatus", F.lit(".csv")))


def file_verdict(spark, sf):
    f = C.run_checks(_verdict_input(spark, sf), _verdict_registry())
    v = verdicts(conform(f, "r", "3_validation", key="_source_file"))
    return v.select("source_file", "passed")


def run_summary_query(spark, sf):
    f = C.run_checks(_verdict_input(spark, sf), _verdict_registry())
    return run_summary(conform(f, "r", "3_validation", key="_source_file")).select("n_files", "n_passed", "n_failed")


def findings_report(spark, sf):
    f = C.run_checks(_verdict_input(spark, sf), _verdict_registry())
    return text_report(conform(f, "r", "3_validation", key="_source_file"))


def aggregate_by_registry(spark, sf):
    return aggregate(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                     {"l_quantity": "sum", "l_extendedprice": "mean", "l_tax": "count"}, round_to=2)


def preboarding_run(spark, sf):
    """The full run (land → validate → route → enrich → validate → deliver) over
    lineitem written as a CSV drop; returns the delivered rows."""
    from dropgate.plans import lineitem_run
    return lineitem_run.preboarding_run(spark, sf)


def stream_validate(spark, sf):
    """lineitem arriving as a file stream, validated per micro-batch."""
    from dropgate.streaming.incremental import validate_stream
    out = scratch_path(spark, "stream")
    schema = _t(spark, sf, "lineitem").schema
    q = validate_stream(spark, sf, schema, {"value_range": {"l_quantity": {"min": 5, "max": 45}},
                                            "check_null_values": ["l_shipdate"]},
                        out_dir=out, checkpoint=f"{out}/_checkpoint", options={"pathGlobFilter": "lineitem.parquet"})
    q.awaitTermination()
    return (spark.read.parquet(f"{out}/findings")
            .select("source_file", "check", "column", "passed", "n_bad"))


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "csv_quoting": csv_quoting,
    "dispatch_multi_layout": dispatch_multi_layout,
    "enrich_salted_multikey": enrich_salted_multikey,
    "value_range_text": value_range_text,
    "schema_fails_bad_values": schema_fails_bad_values,
    "snapshot_two_patterns": snapshot_two_patterns,
    "restored_run": restored_run,
    "enrich_report_counts": enrich_report_counts,
    "missing_id_findings": missing_id_findings,
    "corrupt_rows": corrupt_rows,
    "list_runs": list_runs_query,
    "pattern_match": pattern_match,
    "dispatch_by_pattern": dispatch_by_pattern,
    "dispatch_rejects": dispatch_rejects,
    "strip_whitespace": strip_whitespace,
    "case_upper": case_upper,
    "case_lower": case_lower,
    "blank": blank,
    "multiply_columns": multiply_columns,
    "sum_columns": sum_columns,
    "subtract_columns": subtract_columns,
    "divide_columns": divide_columns,
    "drop_columns": drop_columns,
    "rename_columns": rename_columns,
    "filter_rows": filter_rows,
    "drop_nulls": drop_nulls,
    "transform_sales_chain": transform_sales_chain,
    "custom_transform": custom_transform,
    "enrich_mapping": enrich_mapping,
    "enrich_mapping_multikey": enrich_mapping_multikey,
    "enrich_unmatched": enrich_unmatched,
    "enrich_examples": enrich_examples,
    "referential_missing_ids": referential_missing_ids,
    "cross_consistency": cross_consistency,
    "referential_large_master": referential_large_master,
    "cross_large_right": cross_large_right,
    "snapshot_compacted": snapshot_compacted,
    "snapshot_union": snapshot_union,
    "snapshot_new_ids": snapshot_new_ids,
    "snapshot_versions": snapshot_versions,
    "table_append": table_append,
    "backup_restore": backup_restore,
    "always_true": always_true,
    "always_false": always_false,
    "required_columns": required_columns,
    "additional_columns": additional_columns,
    "empty_check": empty_check,
    "value_range": value_range,
    "null_check": null_check,
    "null_check_custom": null_check_custom,
    "null_samples": null_samples,
    "column_types": column_types,
    "hierarchy_violations": hierarchy_violations,
    "hierarchy_ok": hierarchy_ok,
    "hierarchy_check": hierarchy_check,
    "duplicate_rows": duplicate_rows,
    "custom_check": custom_check,
    "file_verdict": file_verdict,
    "run_summary": run_summary_query,
    "findings_report": findings_report,
    "aggregate_by_registry": aggregate_by_registry,
    "stream_validate": stream_validate,
    "preboarding_run": preboarding_run,
}


_MARKERS_SQL = "'', ' ', 'NA', 'N/A', 'NULL', 'en'"

_LAYOUTS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS o_custkey,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders"""

ORACLE_SQL = {
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "scan_csv_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "pattern_match": """
        SELECT p, CAST((CASE WHEN p ILIKE '%sales%' THEN 1 ELSE 0 END)
                     + (CASE WHEN p ILIKE '%inventory%' THEN 1 ELSE 0 END) AS INTEGER) AS n_matches
        FROM (SELECT 'FR_sales_' || c_name AS p FROM customer
              UNION ALL SELECT c_name || '_inventory_sales' AS p FROM customer)""",
    "dispatch_by_pattern": """
        SELECT o_orderkey, CASE WHEN o_orderpriority ILIKE '1-%' THEN 'URGENT'
                                WHEN o_orderpriority ILIKE '5-%' THEN 'LOW' ELSE 'REJECT' END AS target
        FROM orders""",
    "dispatch_rejects": """
        SELECT p, n = 1 AS passed, CAST(CASE WHEN n = 1 THEN 0 ELSE 1 END AS BIGINT) AS n_bad FROM (
          SELECT p, (CASE WHEN p ILIKE '1-%' THEN 1 ELSE 0 END) + (CASE WHEN p ILIKE '%URGENT%' THEN 1 ELSE 0 END)
                  + (CASE WHEN p ILIKE '5-%' THEN 1 ELSE 0 END) AS n
          FROM (SELECT DISTINCT o_orderpriority || '/' || o_orderstatus || '_orders.csv' AS p FROM orders))""",
    "strip_whitespace": r"SELECT c_custkey, regexp_replace('  ' || c_name || chr(9) || ' ', '^\s+|\s+$', '', 'g') AS c_name FROM customer",
    "case_upper": "SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand FROM part",
    "case_lower": "SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer",
    "blank": "SELECT * FROM supplier",
    "multiply_columns": "SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS total_sales FROM lineitem",
    "sum_columns": "SELECT l_orderkey, l_linenumber, l_discount + l_tax AS adj FROM lineitem",
    "subtract_columns": "SELECT l_orderkey, l_linenumber, l_extendedprice - l_discount - l_tax AS net FROM lineitem",
    "divide_columns": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS ratio FROM lineitem""",
    "drop_columns": "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders",
    "rename_columns": "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier",
    "filter_rows": "SELECT * FROM orders WHERE o_totalprice > 200000",
    "drop_nulls": "SELECT event_id, et FROM (SELECT event_id, nullif(event_type, 'click') AS et FROM events) WHERE et IS NOT NULL",
    "transform_sales_chain": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, upper(trim(p.p_name)) AS p_name,
               upper(trim(p.p_brand)) AS p_brand, l.l_extendedprice * l.l_quantity AS total_sales
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "custom_transform": "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
    "enrich_mapping": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "enrich_mapping_multikey": """
        SELECT c.c_custkey, s.n_customers FROM customer c LEFT JOIN
          (SELECT c_nationkey AS nationkey, c_mktsegment AS segment, count(*) AS n_customers
           FROM customer GROUP BY 1, 2) s
          ON c.c_nationkey = s.nationkey AND c.c_mktsegment = s.segment""",
    "enrich_unmatched": """
        SELECT count(*) AS total, count(*) FILTER (WHERE p.p_partkey IS NULL) AS unmatched
        FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l.l_partkey = p.p_partkey""",
    "enrich_examples": """
        SELECT l_returnflag, l_partkey FROM (
          SELECT l_returnflag, l_partkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_partkey) AS rn
          FROM (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem l
                WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25)))
        WHERE rn <= 3""",
    "referential_missing_ids": """
        SELECT DISTINCT l_partkey AS missing_id FROM lineitem l
        WHERE l_partkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25)""",
    "cross_consistency": """
        SELECT count(*) AS n_keys, count(o.k) AS n_matched, count(*) - count(o.k) AS n_unmatched
        FROM (SELECT DISTINCT c_custkey FROM customer) c
        LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON o.k = c.c_custkey""",
    "referential_large_master": """
        SELECT DISTINCT p_partkey AS missing_id FROM part p
        WHERE p_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = p.p_partkey)""",
    "cross_large_right": """
        SELECT count(*) AS n_keys, count(l.h) AS n_matched, count(*) - count(l.h) AS n_unmatched
        FROM (SELECT DISTINCT c_custkey AS k, c_nationkey AS s FROM customer) c
        LEFT JOIN (SELECT DISTINCT l_partkey AS k, l_suppkey AS s, 1 AS h FROM lineitem) l ON l.k = c.k AND l.s = c.s""",
    "snapshot_compacted": """
        WITH m AS (SELECT unnest(range(1, 13)) AS m),
        f AS (SELECT o_custkey, min(coalesce(month(o_orderdate), 12)) AS m FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
        n AS (SELECT m.m, count(o_custkey) AS n FROM m LEFT JOIN f ON f.m = m.m GROUP BY 1)
        SELECT lpad(m::VARCHAR, 2, '0') AS version, n AS n_new, (sum(n) OVER (ORDER BY m))::BIGINT AS n_total FROM n""",
    "snapshot_union": """
        SELECT DISTINCT id FROM (SELECT l_partkey AS id FROM lineitem
                                 UNION ALL SELECT CASE WHEN p_size <= 25 THEN p_partkey ELSE -p_partkey - 1 END FROM part)
        WHERE id IS NOT NULL""",
    "snapshot_new_ids": """
        SELECT DISTINCT l_partkey AS id FROM lineitem l WHERE l_partkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25)""",
    "snapshot_versions": """
        WITH f AS (SELECT l_partkey AS id, min(coalesce(l_linenumber % 3, 0)) AS k FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1)
        SELECT v AS version, count(id) AS n_rows FROM (VALUES ('001', 0), ('002', 1), ('010', 2)) x(v, k) LEFT JOIN f USING (k) GROUP BY v""",
    "csv_quoting": """SELECT doc_id, '"' || lang || '"; ' AS lang, sha256(text) AS text_sha FROM documents""",
    "dispatch_multi_layout": _LAYOUTS_SQL,
    "restored_run": _LAYOUTS_SQL,
    "enrich_salted_multikey": """
        SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n_customers FROM customer""",
    "value_range_text": """
        WITH d AS (SELECT lang, CASE WHEN doc_id % 7 = 0 THEN source ELSE CAST(n_chars AS VARCHAR) END AS size FROM documents),
             n AS (SELECT lang, size, TRY_CAST(size AS DOUBLE) AS x FROM d),
             c AS (SELECT lang, count(*) FILTER (x < 100) AS lo, count(*) FILTER (x > 5000) AS hi,
                          count(*) FILTER (size IS NOT NULL AND x IS NULL) AS no FROM n GROUP BY lang)
        SELECT lang AS dataset, 'value_range.min' AS "check", 'size' AS "column", lo = 0 AS passed, lo AS n_bad FROM c
        UNION ALL SELECT lang, 'value_range.max', 'size', hi = 0, hi FROM c
        UNION ALL SELECT lang, 'value_range.number', 'size', no = 0, no FROM c""",
    "schema_fails_bad_values": """
        SELECT o_orderkey, o_totalprice AS price, o_orderstatus FROM orders WHERE o_orderstatus NOT IN
          (SELECT o_orderstatus FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0)""",
    "snapshot_two_patterns": "SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey IS NOT NULL",
    "enrich_report_counts": """
        SELECT count(p.p_partkey) AS kept, count(*) - count(p.p_partkey) AS unmatched
        FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l.l_partkey = p.p_partkey""",
    "missing_id_findings": """
        WITH m AS (SELECT DISTINCT l_returnflag AS f, l_partkey FROM lineitem l WHERE l_partkey IS NOT NULL
                   AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25))
        SELECT f AS dataset, 'validate_product_ids.id' AS "check", 'l_partkey' AS "column", false AS passed, CAST(1 AS BIGINT) AS n_bad FROM m
        UNION ALL
        SELECT l_returnflag, 'validate_product_ids', 'l_partkey', count(k) = 0, count(k)
        FROM (SELECT DISTINCT l_returnflag FROM lineitem) LEFT JOIN (SELECT f, l_partkey AS k FROM m) ON f = l_returnflag GROUP BY 1""",
    "table_append": "SELECT * FROM part",
    "backup_restore": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "always_true": """SELECT DISTINCT o_orderstatus AS dataset, 'always_true_validator' AS "check",
        CAST(NULL AS VARCHAR) AS "column", true AS passed, CAST(0 AS BIGINT) AS n_bad FROM orders""",
    "always_false": """SELECT DISTINCT o_orderstatus AS dataset, 'always_false_validator' AS "check",
        CAST(NULL AS VARCHAR) AS "column", false AS passed, CAST(0 AS BIGINT) AS n_bad FROM orders""",
    "required_columns": """
        SELECT DISTINCT l_returnflag AS dataset, 'required_columns' AS "check", CAST(NULL AS VARCHAR) AS "column",
               m.n = 0 AS passed, CAST(m.n AS BIGINT) AS n_bad
        FROM lineitem, (SELECT count(*) AS n FROM (VALUES ('l_orderkey'), ('l_partkey'), ('price')) x(c)
                        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE lineitem))) m""",
    "additional_columns": """
        SELECT DISTINCT o_orderstatus AS dataset, 'additional_columns' AS "check", CAST(NULL AS VARCHAR) AS "column",
               m.n = 0 AS passed, CAST(m.n AS BIGINT) AS n_bad
        FROM orders, (SELECT count(*) AS n FROM (DESCRIBE orders)
                      WHERE column_name NOT IN ('o_orderkey', 'o_custkey')) m""",
    "empty_check": """
        SELECT s.seg AS dataset, 'is_empty_dataframe' AS "check", CAST(NULL AS VARCHAR) AS "column",
               count(c.c_custkey) > 0 AS passed,
               CAST(CASE WHEN count(c.c_custkey) = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_bad
        FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer) s
        LEFT JOIN customer c ON c.c_mktsegment = s.seg AND c.c_acctbal > 5000 AND c.c_mktsegment LIKE '%U%'
        GROUP BY s.seg""",
    "value_range": """
        SELECT l_returnflag AS dataset, 'value_range.min' AS "check", 'l_quantity' AS "column",
               count(*) FILTER (WHERE l_quantity < 5) = 0 AS passed, count(*) FILTER (WHERE l_quantity < 5) AS n_bad
        FROM lineitem GROUP BY l_returnflag
        UNION ALL
        SELECT l_returnflag, 'value_range.max', 'l_quantity',
               count(*) FILTER (WHERE l_quantity > 45) = 0, count(*) FILTER (WHERE l_quantity > 45)
        FROM lineitem GROUP BY l_returnflag""",
    "null_check": """
        SELECT source AS dataset, 'check_null_values' AS "check", 'lang' AS "column",
               count(*) FILTER (WHERE nullif(lang, 'de') IS NULL) = 0 AS passed,
               count(*) FILTER (WHERE nullif(lang, 'de') IS NULL) AS n_bad
        FROM documents GROUP BY source""",
    "null_check_custom": f"""
        SELECT source AS dataset, 'check_null_values' AS "check", 'lang' AS "column",
               count(*) FILTER (WHERE lang IS NULL OR lang IN ({_MARKERS_SQL})) = 0 AS passed,
               count(*) FILTER (WHERE lang IS NULL OR lang IN ({_MARKERS_SQL})) AS n_bad
        FROM documents GROUP BY source""",
    "null_samples": f"""
        SELECT dataset, CAST(rn AS INTEGER) AS sample_rank, CAST(doc_id AS VARCHAR) AS sample FROM (
          SELECT source AS dataset, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
          FROM documents WHERE lang IS NULL OR lang IN ({_MARKERS_SQL}))
        WHERE rn <= 5""",
    "column_types": """
        SELECT source AS dataset, 'column_types' AS "check", 'n_chars' AS "column", true AS passed,
               CAST(0 AS BIGINT) AS n_bad FROM documents GROUP BY source
        UNION ALL
        SELECT source, 'column_types', 'lang',
               count(*) FILTER (WHERE lang IS NOT NULL AND TRY_CAST(lang AS BIGINT) IS NULL) = 0,
               count(*) FILTER (WHERE lang IS NOT NULL AND TRY_CAST(lang AS BIGINT) IS NULL)
        FROM documents GROUP BY source""",
    "hierarchy_violations": """
        SELECT p_brand, count(*) AS n_higher FROM (SELECT DISTINCT p_brand, p_type FROM part)
        GROUP BY p_brand HAVING count(*) > 1""",
    "hierarchy_ok": """
        SELECT count(*) AS n_violations FROM (SELECT c_custkey FROM (SELECT DISTINCT c_custkey, c_nationkey FROM customer)
        GROUP BY c_custkey HAVING count(*) > 1)""",
    "hierarchy_check": """
        SELECT dataset, 'p_brand' AS "column", count(*) AS n_bad FROM (
          SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN 'size5' ELSE 'other' END AS dataset, p_brand, p_type FROM part)
        GROUP BY dataset, p_brand HAVING count(*) > 1""",
    "duplicate_rows": """
        SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS dup_count FROM (
          SELECT count(*) AS c FROM events GROUP BY user_id, event_type, date_trunc('day', ts) HAVING count(*) > 1)""",
    "custom_check": """
        SELECT l_returnflag AS dataset, 'positive_quantity' AS "check", 'q' AS "column",
               count(*) FILTER (WHERE l_quantity - 10 <= 0) = 0 AS passed,
               count(*) FILTER (WHERE l_quantity - 10 <= 0) AS n_bad
        FROM lineitem GROUP BY l_returnflag""",
    "file_verdict": """
        SELECT 'lineitem_' || l_returnflag || l_linestatus || '.csv' AS source_file,
               count(*) > 0 AND count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50 OR l_discount > 0.09
                                                  OR l_shipdate IS NULL) = 0 AS passed
        FROM lineitem GROUP BY 1""",
    "run_summary": """
        SELECT count(*) AS n_files, count(*) FILTER (WHERE passed) AS n_passed,
               count(*) FILTER (WHERE NOT passed) AS n_failed FROM (
          SELECT count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50 OR l_discount > 0.09
                                  OR l_shipdate IS NULL) = 0 AS passed
          FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
    "stream_validate": """
        SELECT 'lineitem.parquet' AS source_file, 'value_range.min' AS "check", 'l_quantity' AS "column",
               count(*) FILTER (WHERE l_quantity < 5) = 0 AS passed, count(*) FILTER (WHERE l_quantity < 5) AS n_bad
        FROM lineitem
        UNION ALL SELECT 'lineitem.parquet', 'value_range.max', 'l_quantity',
               count(*) FILTER (WHERE l_quantity > 45) = 0, count(*) FILTER (WHERE l_quantity > 45) FROM lineitem
        UNION ALL SELECT 'lineitem.parquet', 'check_null_values', 'l_shipdate',
               count(*) FILTER (WHERE l_shipdate IS NULL) = 0, count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem""",
    "preboarding_run": """
        SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
               l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
               upper(trim(p.p_name)) AS p_name, upper(p.p_brand) AS p_brand,
               l.l_extendedprice * l.l_quantity AS total_sales, 'DELIVERY/' || l.l_returnflag AS target
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
        WHERE l.l_returnflag IN ('A', 'N')""",
    "findings_report": """
        SELECT 'r' AS run_id, '3_validation' AS step,
               'lineitem_' || l_returnflag || l_linestatus || '.csv' AS source_file,
               'value_range.max: l_discount: ' || count(*) FILTER (WHERE l_discount > 0.09)
                 || ' value(s) above 0.09' AS report
        FROM lineitem GROUP BY l_returnflag, l_linestatus
        HAVING count(*) FILTER (WHERE l_discount > 0.09) > 0""",
    "corrupt_rows": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'orders_F' ELSE 'orders_other' END AS dataset,
               'malformed_rows' AS "check", CAST(NULL AS VARCHAR) AS "column",
               count(*) FILTER (WHERE o_orderstatus = 'P') = 0 AS passed,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS n_bad
        FROM orders GROUP BY 1""",
    "list_runs": """
        SELECT 'run_' || o_orderstatus AS run_id,
               CAST(-row_number() OVER (ORDER BY 'run_' || o_orderstatus DESC) AS INTEGER) AS run_index,
               count(*) AS n_rows
        FROM orders GROUP BY o_orderstatus""",
    "aggregate_by_registry": """
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity,
               round(avg(l_extendedprice), 2) AS l_extendedprice, count(l_tax) AS l_tax
        FROM lineitem GROUP BY ALL""",
}
